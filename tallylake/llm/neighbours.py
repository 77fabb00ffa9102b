"""Approximate nearest neighbours by inner product with vantage-point trees, one per shard.

Inner products become distances by one more coordinate, sqrt(M^2 - |x|^2) with M the largest norm of all rows (0 for a
query): the nearer two vectors then lie, the larger is their product. Rows are dealt out over shards of about
`shard_rows` rows. A task builds the tree of its shard: each inner node has a vantage point and the radius that halves
its rows, each leaf at most `leaf_rows` rows. A query learns its distance to every vantage point once; the triangle
inequality then bounds from below how near each leaf can be. The best leaf of each query is searched first, then, some
leaves at a time, all queries whose bound, times `relax`, does not exceed the distance of their k-th neighbour so far. A factor
of one makes the search exact; a larger one trades recall for time.

Every row is indexed, and every query meets every shard, in blocks of `query_rows`. Copies of one vector: no query
returns more than k of them, those with the smallest ids, so k + 1 are enough (the query's own row is no neighbour);
they are limited before the shuffle. Scores are exact: the products of the original numbers, in double precision.

Vectors that are null, empty, zero or hold nulls or non-finite numbers take no part, as rows or as queries; vectors
of different lengths never meet. Rows with one id are rows of their own, but ask once. Ties go to the smaller vec_id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallylake.llm.staging import staged

SLACK = 1e-9  # bounds give way by this much of the scale, so that rounding prunes nothing


@dataclass
class Tree:
    """A vantage-point tree over the rows of `points`; leaves are lists of rows."""

    points: np.ndarray
    leaf_rows: int
    vantages: list[int] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)
    # For each leaf the way to it: (vantage point, least and largest distance of the leaf's side from it).
    ways: list[list[tuple[int, float, float]]] = field(default_factory=list)

    def __post_init__(self):
        waiting: list[tuple[np.ndarray, list]] = [(np.arange(len(self.points)), [])]
        while waiting:
            rows, way = waiting.pop()
            if len(rows) <= self.leaf_rows:
                self.leaves.append(rows)
                self.ways.append(way)
                continue
            center = self.points[rows].mean(axis=0)
            vantage = rows[np.argmax(((self.points[rows] - center) ** 2).sum(axis=1))]
            number = len(self.vantages)
            self.vantages.append(int(vantage))
            far = np.sqrt(((self.points[rows] - self.points[vantage]) ** 2).sum(axis=1))
            order = np.argsort(far, kind="stable")
            rows, far, half = rows[order], far[order], len(rows) // 2
            waiting.append((rows[:half], [*way, (number, far[0], far[half - 1])]))
            waiting.append((rows[half:], [*way, (number, far[half], far[-1])]))

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Least possible distance of each query to each leaf."""
        squares = (queries**2).sum(axis=1)[:, None]
        least = np.zeros((len(queries), len(self.leaves)))
        if self.vantages:
            spots = self.points[self.vantages]
            far = np.sqrt(np.maximum(squares + (spots**2).sum(axis=1) - 2 * queries @ spots.T, 0))
            for leaf, way in enumerate(self.ways):
                for number, low, high in way:
                    np.maximum(least[:, leaf], np.maximum(low - far[:, number], far[:, number] - high), out=least[:, leaf])
        return least


def _best(who: np.ndarray, at: np.ndarray, product: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best pairs of each query, query by query, best first."""
    order = np.lexsort((ids[at], -product, who))
    first = np.flatnonzero(np.concatenate(([True], np.diff(who[order]) != 0))) if len(order) else np.empty(0, np.int64)
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    return order[rank < k]


def search(
    ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, largest: float, relax: float,
    leaf_rows: int, known: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query index, row index and product of up to k neighbours of each query; `known` is a product for each query
    that k neighbours reach in any case (minus infinity if none is known)."""
    extra = np.sqrt(np.maximum(largest**2 - (rows**2).sum(axis=1), 0))
    tree = Tree(np.column_stack((rows, extra)), leaf_rows)
    least = tree.bounds(np.column_stack((queries, np.zeros(len(queries)))))
    norms = (queries**2).sum(axis=1)
    kth = known.copy()
    scale = SLACK * (largest**2 + norms.max(initial=0))
    who, at, product = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)

    def visit(pairs: list[tuple[int, np.ndarray]]) -> None:
        """Compares the rows of leaves with queries and keeps the k best of each query."""
        nonlocal who, at, product
        near = [(who, at, product)]
        for leaf, some in pairs:
            members = tree.leaves[leaf]
            reached = queries[some] @ rows[members].T >= (kth[some] - scale)[:, None]
            q, m = np.nonzero(reached & (ids[members] != query_ids[some][:, None]))
            q, m = some[q], members[m]
            near.append((q, m, np.einsum("ij,ij->i", queries[q], rows[m])))
        who, at, product = (np.concatenate(c) for c in zip(*near))
        best = _best(who, at, product, ids, k)
        who, at, product = who[best], at[best], product[best]
        last = np.flatnonzero(np.bincount(who, minlength=len(queries)) == k)
        end = np.searchsorted(who, last, side="right") - 1
        kth[last] = np.maximum(kth[last], product[end])

    best = least.argmin(axis=1)
    visit([(leaf, np.flatnonzero(best == leaf)) for leaf in range(len(tree.leaves))])
    for first in range(0, len(tree.leaves), 8):
        reach = np.sqrt(np.maximum(norms + largest**2 - 2 * np.maximum(kth, -1e300) + scale, 0))
        visit([(leaf, np.flatnonzero((best != leaf) & (least[:, leaf] * relax <= reach)))
               for leaf in range(first, min(first + 8, len(tree.leaves)))])
    return who, at, product


def _reached(sample, queries: np.ndarray, query_ids: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest product of each query with the rows of the sample."""
    if sample is None or len(sample[0]) <= k:
        return np.full(len(queries), -np.inf)
    product = np.where(sample[0] == query_ids[:, None], -np.inf, queries @ sample[1].T)
    return np.partition(product, -k, axis=1)[:, -k]


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, vector): rows that take part, as doubles."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (
        rows.where("vec_id is not null").select("vec_id", vector.alias("vector"))
        .where((F.size("vector") > 0) & finite & F.exists("vector", lambda v: v != 0))
    )


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, relax: float = 2.0, shard_rows: int = 4096,
    query_rows: int = 4096, leaf_rows: int = 128, probe_rows: int = 1024,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of `vectors` for each row of `queries`."""
    copies = Window.partitionBy("vector").orderBy("vec_id")
    rows = staged(
        usable(vectors).withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).drop("copy"), "vectors")
    asked = usable(queries).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    norm = F.aggregate("vector", F.lit(0.0), lambda a, v: a + v * v)
    count, largest = rows.agg(F.count("*"), F.max(norm)).first()
    blocks = max(1, -(-asked.count() // query_rows))
    shards = max(1, -(-count // shard_rows))
    # A bounded number of rows from anywhere tells each query a product that k neighbours reach in any case.
    some = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(probe_rows).collect()
    by_size = {n: [r for r in some if len(r["vector"]) == n] for n in {len(r["vector"]) for r in some}}
    sample = vectors.sparkSession.sparkContext.broadcast(
        {n: (np.array([r["vec_id"] for r in rs]), np.array([r["vector"] for r in rs])) for n, rs in by_size.items()})
    largest = float(np.sqrt(largest or 0.0) * (1 + 1e-12))

    grid = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    held = rows.select("vec_id", "vector", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"), grid(blocks).alias("block"))
    looking = asked.select("vec_id", "vector", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), grid(shards).alias("shard"))

    def work(own: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        made = []
        own = own.assign(size=own["vector"].map(len))
        wanted = wanted.assign(size=wanted["vector"].map(len))
        for size, part in own.groupby("size"):
            ask = wanted[wanted["size"] == size]
            if not len(ask):
                continue
            ids, query_ids = part["vec_id"].to_numpy(), ask["vec_id"].to_numpy()
            asking = np.stack(ask["vector"])
            known = _reached(sample.value.get(size), asking, query_ids, k)
            q, r, product = search(ids, np.stack(part["vector"]), query_ids, asking, k, largest, relax, leaf_rows, known)
            made.append(pd.DataFrame({"query_id": query_ids[q], "vec_id": ids[r], "score": product}))
        return pd.concat(made) if made else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    near = held.groupBy("shard", "block").cogroup(looking.groupBy("shard", "block")).applyInPandas(
        work, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
