"""Near duplicates by SimHash, found with Golay-code fuzzy hashing.

A fingerprint has 64 bits: a bit is 1 if it is set in over half of the XXH64 hashes (seed 42) of the text's
`shingle`-word shingles, repeats included. Two fingerprints link when they differ in at most two bits; documents that
are linked, directly or through others, form a component, named by its smallest doc_id.

Finding links: the 64 bits are cut into segments of 23, 23 and 18 bits. Two errors leave one segment without any
(pigeonhole), so each key holds one segment exactly and the next one fuzzily: as the index of a codeword of the
binary Golay code within distance four of it. The code is perfect with radius three, so the word between two words
that differ in two bits is at most three bits from a codeword, which is then at most four bits from both: the words
share a key. A segment has one such codeword if it lies within two bits of it, else six. Distinct fingerprints with
an equal key meet and are compared. What comes out of a group is a tree over its linked members, never all pairs.

Keys that more than `most` distinct fingerprints share are found by a count first. Their members are instead joined on
the fingerprint with each pair of bits outside the exact segment masked out, where at most four can be equal.

Null and empty texts have fingerprint zero and link like any other. Rows that repeat a doc_id are documents of their
own with equal ids. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.llm.graph import smallest_reachable, tree
from tallylake.llm.staging import shuffle_width, staged

# Fixed value: the generator polynomial of the binary Golay code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
SEGMENTS = ((0, 23), (23, 23), (46, 18))
ERRORS = 2


def fingerprint(text: str | None, shingle: int = 3) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - shingle + 1)
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], 42) for a, b in zip(starts, ends[min(shingle, len(words)) - 1 :].tolist())]
    set_bits = np.zeros(64, np.int64)
    for at in range(0, n, 4096):
        part = np.array(hashes[at : at + 4096], "<u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view("<u8")[0])


def _remainder(words: np.ndarray) -> np.ndarray:
    """Syndromes: words of 23 bits modulo the generator."""
    words = words.copy()
    for bit in range(22, 10, -1):
        words ^= np.where(words >> bit & 1, GENERATOR << (bit - 11), 0)
    return words


@lru_cache(maxsize=1)
def _leaders() -> np.ndarray:
    """For each of the 2,048 syndromes the errors that lead to codewords within distance four: one or six of them,
    the rest -1."""
    leaders = np.full((2048, 6), -1, np.int64)
    filled = np.zeros(2048, np.int64)
    for weight in range(5):
        errors = np.array([sum(1 << b for b in bits) for bits in combinations(range(23), weight)], np.int64)
        for error, syndrome in zip(errors.tolist(), _remainder(errors).tolist()):
            leaders[syndrome, filled[syndrome]] = error
            filled[syndrome] += 1
    return leaders


def codewords(segment: np.ndarray) -> np.ndarray:
    """The information bits of the codewords within distance four of each 23-bit word, -1 where there are fewer."""
    errors = _leaders()[_remainder(segment)]
    return np.where(errors < 0, -1, (segment[:, None] ^ errors) >> 11)


def keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of fingerprints: the index of the fingerprint, the key (exact segment, its value, a codeword)."""
    owners, made = [], []
    parts = [(prints >> np.uint64(low) & np.uint64((1 << size) - 1)).astype(np.int64) for low, size in SEGMENTS]
    for i, part in enumerate(parts):
        fuzzy = codewords(parts[(i + 1) % len(parts)])
        at, column = np.nonzero(fuzzy >= 0)
        owners.append(at)
        made.append(i << 40 | part[at] << 12 | fuzzy[at, column])
    return np.concatenate(owners), np.concatenate(made)


def _within(prints: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what is connected among a few distinct fingerprints."""
    if len(prints) == 2:
        near = int(prints[0] ^ prints[1]).bit_count() <= ERRORS
        return [(int(prints[0]), int(prints[1]))] if near else []
    links, left = [], np.ones(len(prints), bool)
    for first in range(len(prints)):
        if not left[first]:
            continue
        left[first] = False
        members, ahead = [first], [first]
        while ahead:
            rest = np.flatnonzero(left)
            near = rest[np.bitwise_count(prints[rest] ^ prints[ahead.pop()]) <= ERRORS]
            left[near] = False
            members += near.tolist()
            ahead += near.tolist()
        links += tree(sorted(prints[members].tolist()))
    return links


_LINK = "a long, b long"


def _links_record(links: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.record_batch({"a": both[:, 0].copy(), "b": both[:, 1].copy()})


def _link_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside each run of rows with an equal key; rows are sorted by key."""
    rest_keys, rest = np.empty(0, np.int64), np.empty(0, np.uint64)

    def runs(names: np.ndarray, prints: np.ndarray, last: bool):
        bounds = np.concatenate(([0], np.flatnonzero(names[1:] != names[:-1]) + 1, [len(names)]))
        if not last:
            bounds = bounds[:-1]
        links = []
        for i in np.flatnonzero(np.diff(bounds) > 1).tolist():
            links += _within(prints[bounds[i] : bounds[i + 1]])
        return links, bounds[-1]

    for batch in batches:
        rest_keys = np.concatenate((rest_keys, batch.column("key").to_numpy()))
        rest = np.concatenate((rest, batch.column("print").to_numpy().view(np.uint64)))
        if len(rest):
            links, done = runs(rest_keys, rest, False)
            rest_keys, rest = rest_keys[done:], rest[done:]
            yield _links_record(links)
    if len(rest):
        yield _links_record(runs(rest_keys, rest, True)[0])


def _make_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column("print").to_numpy().view(np.uint64)
        owners, made = keys(prints)
        yield pa.record_batch({"key": made, "print": prints[owners].view(np.int64)})


def _mask_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each fingerprint with each pair of bits outside its exact segment cleared; the pair is part of the key."""
    for batch in batches:
        prints, exact = batch.column("print").to_numpy(), batch.column("exact").to_numpy()
        for segment, (low, size) in enumerate(SEGMENTS):
            own = prints[exact == segment]
            free = [b for b in range(64) if not low <= b < low + size]
            for a, b in combinations(free, ERRORS) if len(own) else ():
                clear = np.int64(np.uint64(~(1 << a | 1 << b) & (1 << 64) - 1).view(np.int64))
                yield pa.record_batch({
                    "pair": np.full(len(own), a << 6 | b, np.int32), "masked": own & clear, "print": own,
                })


def links(prints: DataFrame, most: int = 4096) -> DataFrame:
    """(a, b): links over distinct fingerprints (column print, signed) that connect what is connected."""
    spark = prints.sparkSession
    made = prints.mapInArrow(_make_keys, "key long, print long")
    crowded = staged(made.groupBy("key").count().where(F.col("count") > most).select("key", F.lit(True).alias("hot")),
                     "crowded-keys")
    marked = made.join(crowded, "key", "left")
    ordinary = (
        marked.where("hot is null").select("key", "print")
        .repartition(shuffle_width(spark), "key").sortWithinPartitions("key").mapInArrow(_link_runs, _LINK)
    )
    hot = marked.where("hot").selectExpr("print", "cast(key >> 40 AS INT) AS exact").distinct()
    # At most four fingerprints are equal under a mask, so each group is tiny.
    masked = (
        hot.mapInArrow(_mask_pairs, "pair int, masked long, print long")
        .groupBy("pair", "masked").agg(F.array_sort(F.collect_set("print")).alias("prints"))
        .where(F.size("prints") > 1)
        .select(F.explode(F.transform(F.slice("prints", 2, 4), lambda p: F.struct(F.col("prints")[0].alias("a"), p.alias("b")))).alias("l"))
        .select("l.a", "l.b")
    )
    return ordinary.unionByName(masked).distinct()


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, print): one row for each row of `docs`; print is the fingerprint as a signed long."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "print": made.view(np.int64)})

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, print long")


def near_duplicates(docs: DataFrame, shingle: int = 3, most: int = 4096) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row for each row of `docs`."""
    made = staged(fingerprints(docs, shingle), "fingerprints")
    distinct = staged(made.groupBy("print").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    found = staged(links(distinct.select("print"), most), "links")
    # (node, root): only fingerprints with a link appear.
    roots = smallest_reachable(found)
    named = distinct.join(roots.withColumnRenamed("node", "print"), "print", "left").withColumn(
        "root", F.coalesce("root", "print"))
    components = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_print = named.join(components, "root").select("print", "component_id")
    return made.join(by_print, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )
