"""Edited copies: texts whose sets of `SHINGLE`-word shingles have a Jaccard similarity of at least `SIMILARITY`.

Words are lower-cased (ASCII) and split at ASCII white space; a text of fewer words is one shingle. Each text gets
BANDS x ROWS minima of hashes of its shingles (MinHash); texts with an equal band meet. A pair of similarity s meets with
probability 1 - (1 - s^ROWS)^BANDS: all but 6 in 10^9 at 0.8, the lowest that counts. Pairs that meet are verified on
their whole sets of shingles, which are hashed once for each text, so nothing below the threshold links.

Texts that meet in a band are compared with one of them first, the one that shares most bands with others, and after
that with the most central of those that are still apart. What then lies in different components of the same band is
compared in pairs, if no more than CROWD texts of a band lie apart from its main component. Of a larger band, such as that of
different texts around one long passage, those pairs are compared whose rarest shingles meet: put in any one order, two sets
of that similarity have a shingle in common among the first fifth of each (and one more), so no such pair is lost. The order is
by how often shingles occur, as counted in BUCKETS counters over one text in SAMPLE; it decides the work, not the result.
Of a shingle that more than FEW texts have among these, no pairs are made, as they would grow with its square: the texts that such
shingles connect are dealt into blocks, by similar sizes, and a task that gets two blocks links what is similar in them.

A component is what links connect. The text of its smallest doc_id stays, null last, ties by the hash of the text; rows
with that text stay together, as equal texts are the business of `exact_dedup`. Texts without words are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylake.llm.graph import smallest_reachable
from tallylake.llm.staging import byte_slices, shuffle_width, staged

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 36, 4
STARS = 2
CROWD = 8
BUCKETS, SAMPLE = 1 << 16, 8
FEW = 16
BLOCK_SHINGLES, BLOCK_TEXTS = 1 << 17, 1024
_RANDOM = np.random.default_rng(42).integers(0, 1 << 64, (2, BANDS * ROWS), np.uint64, endpoint=False) | np.uint64(1)


def shingles(text: str | None) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles of a text, sorted."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[: max(0, len(words) - SHINGLE)] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b]) for a, b in zip(starts, ends[min(SHINGLE, len(words)) - 1 :].tolist())]
    return np.unique(np.array(hashes, np.uint64))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two sets is at least `SIMILARITY`, in whole numbers."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 10 * common >= round(10 * SIMILARITY) * (len(a) + len(b) - common)


def bands(hashes: np.ndarray) -> np.ndarray:
    """One key for each band."""
    least = np.full(BANDS * ROWS, ~np.uint64(0), np.uint64)
    for at in range(0, len(hashes), 1024):
        mixed = (hashes[at : at + 1024, None] ^ _RANDOM[0]) * _RANDOM[1]
        mixed ^= mixed >> np.uint64(32)
        mixed *= _RANDOM[0]
        np.minimum(least, mixed.min(axis=0), out=least)
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), i) for i, row in enumerate(least.reshape(BANDS, ROWS))], np.uint64)


def _node() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _make_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column("text")
        for rows in byte_slices(text):
            sets = [shingles(t) for t in text[rows].to_pylist()]
            spoken = np.array([len(s) > 0 for s in sets], bool)
            made = [bands(s) for s in sets if len(s)]
            if made:
                nodes = np.repeat(batch.column("node")[rows].to_numpy()[spoken], BANDS)
                sizes = np.repeat([len(s) for s in sets if len(s)], BANDS)
                yield pa.record_batch({"key": np.concatenate(made).view(np.int64), "node": nodes, "size": sizes})


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct rows whose key another node has; rows are sorted by key and node."""
    names = ("key", "node", "size")
    held = [np.empty(0, np.int64) for _ in names]

    def runs(done: int) -> pa.RecordBatch:
        keys, nodes = held[0][:done], held[1][:done]
        first = np.concatenate(([True], (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])))[:done]
        same = keys[first][1:] == keys[first][:-1]
        keep = (np.concatenate(([False], same)) | np.concatenate((same, [False])))[: int(first.sum())]
        return pa.record_batch({n: h[:done][first][keep] for n, h in zip(names, held)})

    for batch in batches:
        held = [np.concatenate((h, batch.column(n).to_numpy())) for n, h in zip(names, held)]
        # The last run waits for what follows.
        done = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
        if done:
            yield runs(done)
            held = [h[done:] for h in held]
    if len(held[0]):
        yield runs(len(held[0]))


def _make_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column("text")
        for rows in byte_slices(text):
            sets = [shingles(t).tobytes() for t in text[rows].to_pylist()]
            yield pa.record_batch({"node": batch.column("node")[rows], "shingles": pa.array(sets, pa.binary())})


def _make_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many shingles of the task's texts fall into each counter."""
    counts = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for one in batch.column("shingles"):
            counts += np.bincount((np.frombuffer(one.as_py(), np.uint64) % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
    used = np.flatnonzero(counts)
    yield pa.record_batch({"bucket": used, "n": counts[used]})


def rarest(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first of a set's shingles in the common order: any similar set has one of them among its own."""
    order = np.lexsort((hashes, counts[(hashes % np.uint64(BUCKETS)).astype(np.int64)]))
    least = -(-round(10 * SIMILARITY) * len(hashes) // 10)
    return hashes[order[: len(hashes) - least + 1]]


def _make_rarest(counts: np.ndarray):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stored = batch.column("shingles")
            for rows in byte_slices(stored):
                sets = [np.frombuffer(x, np.uint64) for x in stored[rows].to_pylist()]
                first = [rarest(s, counts) for s in sets]
                times = [len(f) for f in first]
                if sum(times):
                    yield pa.record_batch({
                        "shingle": np.concatenate(first).view(np.int64),
                        "node": np.repeat(batch.column("node")[rows].to_numpy(), times),
                        "root": np.repeat(batch.column("root")[rows].to_numpy(), times),
                        "size": np.repeat(np.array([len(s) for s in sets], np.int64), times),
                        "place": np.concatenate([np.arange(n, dtype=np.int64) for n in times]),
                    })

    return make


def _rare_shared(sets: DataFrame) -> DataFrame:
    """The rarest shingles of `sets` (node, root, shingles) that texts of several roots have among theirs; `texts`: how many."""
    sample = sets.where(F.pmod("node", F.lit(SAMPLE)) == 0).select("shingles")
    counted = sample.mapInArrow(_make_counts, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(BUCKETS, np.int64)
    for bucket, n in counted.collect():  # at most BUCKETS
        counts[bucket] = n
    first = staged(sets.mapInArrow(_make_rarest(counts), "shingle long, node long, root long, size long, place long"), "edited-rarest")
    # Most shingles are those of one component only.
    several = first.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("texts"))
    return staged(first.join(several.where("low != high").select("shingle", "texts"), "shingle"), "edited-rarest-shared")


def _rare_pairs(sets: DataFrame, shared: DataFrame | None = None) -> DataFrame:
    """(a, b): of `sets` (node, root, shingles), the pairs of different roots that can be similar by the rarest shingles that
    few texts share."""
    first = (_rare_shared(sets) if shared is None else shared).where(F.col("texts") <= FEW)
    x = first.select("shingle", *[F.col(c).alias(f"{c}_x") for c in ("node", "root", "size", "place")])
    y = first.select("shingle", *[F.col(c).alias(f"{c}_y") for c in ("node", "root", "size", "place")])
    # What lies before this shingle in both, it, and what lies behind it in both: the most that they can have in common.
    most = F.least("place_x", "place_y") + 1 + F.least(F.expr("size_x - place_x - 1"), F.expr("size_y - place_y - 1"))
    tenths = round(10 * SIMILARITY)
    met = x.join(y, "shingle").where("node_x < node_y and root_x != root_y").where(_sizes_allow("size_x", "size_y"))
    return met.where(most * (10 + tenths) >= F.expr("size_x + size_y") * tenths).select(F.col("node_x").alias("a"), F.col("node_y").alias("b"))


def joined(nodes: np.ndarray, roots: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Similar pairs that, with the roots, connect what similar pairs connect among some texts."""
    sizes = np.array([len(s) for s in sets], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    distinct, ids = np.unique(np.concatenate(sets), return_inverse=True)
    marks, left = np.zeros(len(distinct), np.int32), np.ones(len(sets), bool)
    by_root = np.argsort(roots, kind="stable")
    found = []

    def enter(root: int) -> list[int]:
        low, high = np.searchsorted(roots, [root, root + 1], sorter=by_root)
        left[by_root[low:high]] = False
        return by_root[low:high].tolist()

    for root in np.unique(roots).tolist():
        ahead = enter(root) if left[by_root[np.searchsorted(roots, root, sorter=by_root)]] else []
        while ahead and left.any():
            one = ahead.pop()
            own = ids[starts[one] : ends[one]]
            marks[own] = 1
            common = np.add.reduceat(marks[ids], starts)
            marks[own] = 0
            near = left & (10 * common >= round(10 * SIMILARITY) * (sizes[one] + sizes - common))
            for other in np.flatnonzero(near).tolist():
                if left[other]:
                    found.append((int(nodes[one]), int(nodes[other])))
                    ahead += enter(int(roots[other]))
    return found


def _join_blocks(group: pa.Table) -> pa.Table:
    sets = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
    found = joined(group.column("node").to_numpy(), group.column("root").to_numpy(), sets)
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def _dense_links(sets: DataFrame, shared: DataFrame) -> DataFrame:
    """(a, b): similar pairs that connect those of `sets` (node, root, shingles) that are similar and whose rarest shingles meet in
    one that more than FEW texts share. No more than two blocks of texts of similar sizes come together in a task."""
    dense = shared.where(F.col("texts") > FEW)
    lead = dense.groupBy("shingle").agg(F.min("node").alias("a"))
    families = smallest_reachable(dense.join(lead, "shingle").where("node != a").select("a", F.col("node").alias("b")).distinct())
    # Sizes of similar sets differ by a quarter of the smaller at most, so they are of one class or of neighbouring ones.
    size = (F.octet_length("shingles") / 8).cast("long")
    placed = (
        sets.join(families.withColumnRenamed("root", "family"), "node").withColumn("size", size)
        .withColumn("class", F.floor(F.log("size") / F.log(F.lit(1.01 / SIMILARITY))))
        .withColumn("class", F.explode(F.array("class", F.col("class") + 1)))
    )
    blocks = F.greatest(F.ceil(F.sum("size") / BLOCK_SHINGLES), F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS))
    units = placed.groupBy("family", "class").agg(blocks.alias("blocks"), F.min("root").alias("low"), F.max("root").alias("high"))
    dealt = (
        placed.join(units.where("low != high").drop("low", "high"), ["family", "class"])
        .withColumn("own", F.expr("pmod(xxhash64(node), blocks)"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).where("own != other or blocks = 1")
        .select("family", "class", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "node", "root", "shingles")
    )
    return staged(dealt.groupBy("family", "class", "one", "two").applyInArrow(_join_blocks, "a long, b long"), "edited-dense")


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        first, second = batch.column("set_a"), batch.column("set_b")
        good = []
        for rows in byte_slices(first):
            good += [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))
                     for x, y in zip(first[rows].to_pylist(), second[rows].to_pylist())]
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


def _sizes_allow(a: str, b: str) -> Column:
    """Sets of these sizes can be that similar."""
    return F.least(a, b) * 10 >= F.greatest(a, b) * round(10 * SIMILARITY)


def links(docs: DataFrame) -> DataFrame:
    """(a, b): pairs of different texts, by the hashes of the texts, that connect what is connected."""
    texts = docs.select(_node().alias("node"), "text")
    made = texts.mapInArrow(_make_keys, "key long, node long, size long")
    met = staged(
        made.repartition(shuffle_width(docs.sparkSession), "key").sortWithinPartitions("key", "node")
        .mapInArrow(_shared, "key long, node long, size long"), "edited-met")
    members = met.select("node").distinct()
    # Equal texts have equal sets, and only sets go into the joins.
    known = staged(
        texts.join(members, "node", "left_semi").mapInArrow(_make_sets, "node long, shingles binary").dropDuplicates(["node"]),
        "edited-sets")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        first = known.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
        second = known.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
        both = pairs.join(first, "a").join(second, "b").select("a", "b", "set_a", "set_b")
        return staged(both.mapInArrow(_verify, "a long, b long"), name)

    # A text that shares many bands with many others is near the middle of its group, where most links lead.
    sizes = met.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    middle = met.join(sizes, "key").groupBy("node").agg(F.sum("n").alias("weight"))
    weighed = staged(met.join(middle, "node"), "edited-weighed")
    heaviest = F.max(F.struct("weight", "node", "size"))

    found, apart = [], weighed
    for _ in range(STARS):
        led = apart.groupBy("key").agg(heaviest.alias("lead"))
        pairs = weighed.join(led, "key").where(F.col("node") != F.col("lead.node")).where(_sizes_allow("size", "lead.size"))
        pairs = pairs.select(F.col("lead.node").alias("a"), F.col("node").alias("b")).distinct()
        found.append(verified(pairs, "edited-stars"))
        linked = found[0]
        for more in found[1:]:
            linked = linked.unionByName(more)
        roots = staged(smallest_reachable(linked), "edited-star-roots")
        named = weighed.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        main = named.groupBy("key").agg(F.max(F.struct("weight", "node", "root"))["root"].alias("main"))
        placed = staged(named.join(main, "key"), "edited-placed")
        apart = placed.where("root != main")
    # Only texts of different components need more pairs, and those of a key's main component none among themselves.
    crowded = staged(apart.groupBy("key").agg(F.count(F.lit(1)).alias("far")).where(F.col("far") > CROWD).select("key"), "edited-crowded")
    left = apart.join(crowded, "key", "left_anti").select("key", F.col("node").alias("x"), F.col("root").alias("root_x"), F.col("size").alias("size_x"))
    right = placed.select("key", F.col("node").alias("y"), F.col("root").alias("root_y"), F.col("size").alias("size_y"), (F.col("root") == F.col("main")).alias("near"))
    crossed = left.join(right, "key").where("root_x != root_y and (near or x < y)").where(_sizes_allow("size_x", "size_y")).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    if not crowded.isEmpty():
        gathered = placed.join(crowded, "key", "left_semi").select("node", "root").distinct()
        crowd = staged(known.join(gathered, "node").select("node", "root", "shingles"), "edited-crowd-sets")
        shared = _rare_shared(crowd)
        crossed = crossed.unionByName(_rare_pairs(crowd, shared))
        linked = linked.unionByName(_dense_links(crowd, shared))
    return linked.unionByName(verified(crossed.distinct(), "edited-pairs"))


def without_edited_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    roots = staged(smallest_reachable(links(docs)), "edited-roots")
    named = docs.select("doc_id", _node().alias("node")).join(roots, "node")
    best = named.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node"))["node"].alias("stays"))
    gone = roots.join(best, "root").where("node != stays").select("node")
    return docs.withColumn("__node", _node()).join(gone.withColumnRenamed("node", "__node"), "__node", "left_anti").select(*docs.columns)
