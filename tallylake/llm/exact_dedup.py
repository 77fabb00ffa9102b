"""Exact duplicates through counting quotient filters.

1. Each partition puts the 64-bit fingerprints (XXH64) of its texts into a counting quotient filter: the high bits of a
   fingerprint, its quotient, name a slot run; the run holds the sorted remainders, each with a counter.
2. Filters travel in blocks, dealt out by quotient range and sorted by their first fingerprint. They merge without
   loss, as sorted lists: equal remainders of a quotient add their counters. The merge holds only blocks that overlap.
3. Fingerprints that the merged filters count once are unique. The texts of all others are grouped by fingerprint and
   by their bytes, which verifies them; the largest doc_id of a group stays.

A null text counts as empty and equals it. Rows that repeat a doc_id are copies like any other; if the largest doc_id
of a group appears several times, only one of its rows has kept = true in `deduplicated`, all have it in `groups`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.llm.staging import shuffle_width, staged


@dataclass
class QuotientFilter:
    """Sorted slot runs: quotients that occur, the lengths of their runs, remainders in order, counters."""

    remainder_bits: int
    quotients: np.ndarray
    lengths: np.ndarray
    remainders: np.ndarray
    counters: np.ndarray

    @classmethod
    def of(cls, prints: np.ndarray, counts: np.ndarray | None = None, remainder_bits: int = 44) -> QuotientFilter:
        values, index = np.unique(prints, return_inverse=True)
        weights = np.ones(len(prints), np.int64) if counts is None else counts
        counters = np.zeros(len(values), np.int64)
        np.add.at(counters, index, weights)
        quotients, lengths = np.unique(values >> np.uint64(remainder_bits), return_counts=True)
        return cls(remainder_bits, quotients, lengths, values & np.uint64((1 << remainder_bits) - 1), counters)

    def prints(self) -> np.ndarray:
        return np.repeat(self.quotients, self.lengths) << np.uint64(self.remainder_bits) | self.remainders

    def blocks(self, slots: int, parts: int) -> Iterator[tuple[int, QuotientFilter]]:
        """The filter in blocks of about `slots` remainders, each with the part of the quotient range that it lies in.
        Neither a run nor a part is cut by a block."""
        ends = np.cumsum(self.lengths)
        part = (self.quotients * np.uint64(parts) >> np.uint64(64 - self.remainder_bits)).astype(np.int64)
        first = 0
        while first < len(ends):
            base = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, base + slots, side="right")))
            last = min(last, int(np.searchsorted(part, part[first], side="right")))
            yield int(part[first]), QuotientFilter(
                self.remainder_bits, self.quotients[first:last], self.lengths[first:last],
                self.remainders[base : ends[last - 1]], self.counters[base : ends[last - 1]])
            first = last

    @staticmethod
    def merged(filters: list[QuotientFilter]) -> QuotientFilter:
        prints = np.concatenate([f.prints() for f in filters])
        return QuotientFilter.of(prints, np.concatenate([f.counters for f in filters]), filters[0].remainder_bits)

    def record(self) -> dict:
        return {
            "first": int(self.quotients[0]),
            "quotients": self.quotients.astype("<u4").tobytes(),
            "lengths": self.lengths.astype("<u2").tobytes() if self.lengths.max() < 1 << 16 else self.lengths.astype("<u8").tobytes(),
            "remainders": self.remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes(),
            "counters": self.counters.astype("<u4").tobytes() if self.counters.max() < 1 << 32 else self.counters.astype("<u8").tobytes(),
        }

    @classmethod
    def from_record(cls, row: dict, remainder_bits: int = 44) -> QuotientFilter:
        slots, runs = len(row["remainders"]) // 6, len(row["quotients"]) // 4
        remainders = np.zeros((slots, 8), np.uint8)
        remainders[:, :6] = np.frombuffer(row["remainders"], np.uint8).reshape(-1, 6)
        return cls(
            remainder_bits,
            np.frombuffer(row["quotients"], "<u4").astype(np.uint64),
            np.frombuffer(row["lengths"], "<u2" if len(row["lengths"]) == 2 * runs else "<u8").astype(np.int64),
            remainders.view("<u8").ravel().astype(np.uint64),
            np.frombuffer(row["counters"], "<u4" if len(row["counters"]) == 4 * slots else "<u8").astype(np.int64),
        )


_FILTER = "part int, first long, quotients binary, lengths binary, remainders binary, counters binary"


def repeated_prints(prints: DataFrame, most_pending: int = 1 << 18, slots: int = 256) -> DataFrame:
    """(print, n): signed 64-bit fingerprints of the column print that occur more than once."""
    parts = shuffle_width(prints.sparkSession)

    def rows(filters: Iterator[tuple[int, QuotientFilter]]) -> pa.RecordBatch:
        dealt = [(part, f.record()) for part, f in filters]
        names = ("first", "quotients", "lengths", "remainders", "counters")
        columns = {n: pa.array([r[n] for _, r in dealt], pa.int64() if n == "first" else pa.binary()) for n in names}
        return pa.record_batch({"part": pa.array([p for p, _ in dealt], pa.int32()), **columns})

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One filter for a partition, or several if its fingerprints are more than `most_pending`.
        pending: list[np.ndarray] = []
        size = 0
        for batch in batches:
            pending.append(batch.column("print").to_numpy().view(np.uint64))
            size += len(pending[-1])
            if size >= most_pending:
                yield rows(QuotientFilter.of(np.concatenate(pending)).blocks(slots, parts))
                pending, size = [], 0
        if size:
            yield rows(QuotientFilter.of(np.concatenate(pending)).blocks(slots, parts))

    def repeated(done: QuotientFilter) -> pa.RecordBatch:
        many = done.counters > 1
        return pa.record_batch({"print": done.prints()[many].view(np.int64), "n": done.counters[many]})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: QuotientFilter | None = None
        waiting: list[QuotientFilter] = []
        for batch in batches:
            for row in batch.to_pylist():
                block = QuotientFilter.from_record(row)
                waiting.append(block)
                if sum(len(w.remainders) for w in waiting) > max(4096, len(held.remainders) if held else 0):
                    held = QuotientFilter.merged([*([held] if held else []), *waiting])
                    waiting = []
                    # Blocks come in the order of their first quotient: what lies below the last one is complete.
                    split = int(np.searchsorted(held.quotients, block.quotients[0]))
                    if split:
                        slots_done = int(held.lengths[:split].sum())
                        yield repeated(QuotientFilter(held.remainder_bits, held.quotients[:split], held.lengths[:split],
                                                      held.remainders[:slots_done], held.counters[:slots_done]))
                        held = QuotientFilter(held.remainder_bits, held.quotients[split:], held.lengths[split:],
                                              held.remainders[slots_done:], held.counters[slots_done:])
        if held or waiting:
            yield repeated(QuotientFilter.merged([*([held] if held else []), *waiting]))

    # Each quotient lies in one part, so it is merged in one place.
    return (
        prints.mapInArrow(build, _FILTER)
        .repartition(parts, "part").sortWithinPartitions("part", "first")
        .mapInArrow(merge, "print long, n long")
    )


def groups(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row for each row of `docs`."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("print", F.xxhash64("text"))
    repeated = staged(repeated_prints(texts.select("print")).select("print", F.lit(True).alias("again")), "repeated-prints")
    marked = texts.join(repeated, "print", "left")
    sha = F.sha2("text", 256).alias("text_sha256")
    unique = marked.where("again is null").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), sha)
    again = marked.where("again")
    classes = staged(
        again.groupBy("print", "text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("print", sha, "keep_id", "group_size"),
        "copies",
    )
    members = again.select("doc_id", "print", sha).join(classes, ["print", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size", (F.col("doc_id") == F.col("keep_id")).alias("kept"), "text_sha256")
    return unique.unionByName(members)


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all their columns; texts that occur once are never shuffled."""
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("print", F.xxhash64("text"))
    repeated = staged(repeated_prints(rows.select("print")).select("print", F.lit(True).alias("again")), "repeated-prints")
    marked = rows.join(repeated, "print", "left")
    again = marked.where("again")
    winners = again.groupBy("print", "text").agg(F.max("doc_id").alias("doc_id"))
    one = again.join(winners, ["print", "text", "doc_id"]).dropDuplicates(["print", "text", "doc_id"])
    return marked.where("again is null").select("row.*").unionByName(one.select("row.*"))
