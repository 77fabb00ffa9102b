"""Phrases of two and three words that hold together, per language, by best-first growth with score bounds.

A phrase with count a is cut into two parts of counts l and r; its score is floor(1000000 * a * a / (l * r)) of the cut
that scores least (ties: the shorter first part). It is dropped if a longer phrase around it has at least `share` percent
of its count. Only phrases that occur `least` times count.

Growth: words first, then pairs of frequent words: a word alone bounds no score, so every word is grown. A pair (w, x)
bounds its extensions: none occurs more often, and both parts of the first cut occur at least as often as the whole, so
none scores above floor(1000000 * f(wx) / f(w)). The frontier is taken best bound first, in rounds. A round sets each
language a floor, low enough that some multiple of `top` pairs reach it, and grows all pairs whose bound reaches the
floor, and those that may head a phrase that drops a pair above the floor. Then all scores at or above the floor are
known, with what drops them; a language is settled when `top` phrases are left there (ties at the last score are above
the floor as well) or nothing is left to grow. Languages that are not settled go on with four times as many pairs.

Each round reads the texts once. Tasks count words by local numbers and look parts up in a bit filter of the phrases
that may be grown; it has up to `filter_bits` bits (64 MB), which bounds what is broadcast, and what it lets through by
mistake is counted and then left out by an exact join. Counts are combined in the tasks, so a frequent phrase is no hot key.

A null text counts as empty, a null lang is `und`. Repeated rows count as often as they occur; doc_id and extra columns
are not read. An empty table gives no rows. Texts of any length are read in slices.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallylake.llm.staging import byte_slices, shuffle_width, staged

UNKNOWN = "und"
SCALE = 1_000_000
# A-Z become small letters, tabs spaces, and what separates pieces a byte that UTF-8 never has.
BREAK = 0xFF
_TO_PLAIN = bytes(
    BREAK if chr(b) in ".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _words(k: int) -> list[str]:
    return [f"w{i + 1}" for i in range(k)]


def _hashes(parts: list[np.ndarray], language: int) -> np.ndarray:
    """64 bits for each phrase, given the hashes of its words."""
    h = np.full(len(parts[0]), language, np.uint64)
    for part in parts:
        h = (h ^ part) * _MIX
        h ^= h >> np.uint64(29)
    return h * _MIX


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


class PhraseFilter:
    """Bits at the hashes of phrases: says yes to all of them and to a few others."""

    def __init__(self, bits: int, pages: dict[int, bytes]):
        self.shift = np.uint64(64 - bits)
        self.data = np.zeros(1 << (bits - 3), np.uint8)
        for page, content in pages.items():
            self.data[page << 10 : (page + 1) << 10] = np.frombuffer(content, np.uint8)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> self.shift
        return (self.data[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def phrase_filter(phrases: DataFrame, k: int, most: int = 29) -> PhraseFilter:
    """Filter of (lang, w1 .. wk), sixteen bits for each phrase but at most 2^`most` bits in all."""
    bits = min(most, max(16, (16 * phrases.count()).bit_length()))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages = _word_hashes([t.encode() for t in batch.column("lang").to_pylist()])
            parts = [_word_hashes([t.encode() for t in batch.column(w).to_pylist()]) for w in _words(k)]
            at = (_hashes(parts, languages) if batch.num_rows else languages) >> np.uint64(64 - bits)
            at = np.unique(at).astype(np.int64)
            yield pa.record_batch({"page": pa.array(at >> 13), "at": pa.array((at & 8191).astype(np.int32))})

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pages: dict[int, np.ndarray] = {}
        for batch in batches:
            numbers, places = batch.column("page").to_numpy(), batch.column("at").to_numpy()
            order = np.argsort(numbers, kind="stable")
            for page, which in zip(*_runs(numbers[order], places[order])):
                pages.setdefault(page, np.zeros(8192, bool))[which] = True
        packed = [np.packbits(p, bitorder="little").tobytes() for p in pages.values()]
        yield pa.record_batch({"page": pa.array(list(pages), pa.int64()), "content": pa.array(packed, pa.binary())})

    placed = phrases.select("lang", *_words(k)).mapInArrow(place, "page long, at int")
    drawn = placed.repartition(shuffle_width(phrases.sparkSession), "page").mapInArrow(draw, "page long, content binary")
    table = drawn.toArrow()  # at most 2^most bits
    return PhraseFilter(bits, dict(zip(table["page"].to_pylist(), table["content"].to_pylist())))


def _runs(keys: np.ndarray, values: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    if not len(keys):
        return [], []
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[starts].tolist(), np.split(values, starts[1:])


def slices(texts: list[bytes], size: int, n: int) -> Iterator[bytes]:
    """The plain texts one after another, in slices of about `size` bytes. A slice ends between pieces; where a piece is
    longer than that, between words, and the next slice begins n - 1 words earlier, so that each phrase of n words lies
    in exactly one slice."""
    data = bytes([BREAK]).join(texts).translate(_TO_PLAIN)
    at = 0
    while at < len(data):
        end, again = len(data), len(data)
        if len(data) - at > size:
            end = data.rfind(BREAK, at, at + size)
            again = end + 1
            if end <= at:
                end = max(at, data.rfind(b" ", at, at + size))
                again = _words_before(data, at, end, n - 1)
                while again <= at:  # few long words
                    end = min((e for e in (data.find(b" ", max(end, at) + 1), data.find(BREAK, max(end, at) + 1)) if e > 0), default=len(data))
                    again = _words_before(data, at, end, n - 1) if end < len(data) else end
        yield data[at:end]
        at = again


def _words_before(data: bytes, begin: int, end: int, count: int) -> int:
    """Where the last `count` words of data[begin:end] start; never before `begin`."""
    for _ in range(count):
        while end > begin and data[end - 1] == 32:
            end -= 1
        end = max(begin, data.rfind(b" ", begin, end) + 1)
    return end


class Tally:
    """Counts of the phrases of n words of one language. A phrase is one number made of the numbers of its words; with
    filters, its first n-1 words are in `heads` and its last n-1 in `tails`."""

    WORD_BITS = 21

    def __init__(self, n: int, language: str, heads: PhraseFilter | None, tails: PhraseFilter | None):
        self.n, self.language, self.filters = n, xxhash.xxh64_intdigest(language.encode()), (heads, tails)
        self.numbers: dict[bytes, int] = {}
        self.names: list[bytes] = []
        self.hashed = np.zeros(0, np.uint64)
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.spoken = self.held = 0

    def add(self, data: bytes) -> bool:
        """False, and nothing is counted, if the numbers of words do not suffice any more."""
        mark = bytes([BREAK])
        tokens = data.replace(mark, b" " + mark + b" ").split()
        fresh = [w for w in dict.fromkeys(tokens) if w not in self.numbers and w != mark]
        if self.names and len(self.names) + len(fresh) > 1 << self.WORD_BITS:
            return False
        self.numbers.update(zip(fresh, range(len(self.names), len(self.names) + len(fresh))))
        self.numbers[mark] = -1
        self.names += fresh
        codes = np.fromiter(map(self.numbers.__getitem__, tokens), np.int64, len(tokens))
        words = codes >= 0
        self.spoken += int(words.sum())
        places = max(0, len(codes) - self.n + 1)
        here = np.flatnonzero(np.logical_and.reduce([words[i : i + places] for i in range(self.n)]))
        if self.n > 1:
            self.hashed = np.concatenate((self.hashed, _word_hashes(fresh)))
            for known, first in zip(self.filters, (0, 1)):
                here = here[known.has(_hashes([self.hashed[codes[here + first + i]] for i in range(self.n - 1)], self.language))]
        phrases = codes[here]
        for i in range(1, self.n):
            phrases = phrases << self.WORD_BITS | codes[here + i]
        self.parts.append(np.unique(phrases, return_counts=True))
        self.held += len(self.parts[-1][0])
        return True

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        phrases = np.concatenate([p for p, _ in self.parts] or [np.zeros(0, np.int64)])
        counts = np.concatenate([c for _, c in self.parts] or [np.zeros(0, np.int64)])
        order = np.argsort(phrases, kind="stable")
        phrases, counts = phrases[order], counts[order]
        starts = np.flatnonzero(np.r_[True, phrases[1:] != phrases[:-1]]) if len(phrases) else np.zeros(0, np.int64)
        self.parts = [(phrases[starts], np.add.reduceat(counts, starts) if len(starts) else counts)]
        self.held = len(starts)
        return self.parts[0]

    def rows(self, language: str, names: list[str], size: int = 50_000) -> Iterator[pa.RecordBatch]:
        """What was counted; for single words also the number of all words, with a null word."""
        phrases, counts = self.merge()
        strings = pa.array(self.names, pa.binary()).cast(pa.string())
        for i in range(0, len(phrases), size):
            here = phrases[i : i + size]
            numbers = [here >> (self.WORD_BITS * k) & ((1 << self.WORD_BITS) - 1) for k in range(self.n - 1, -1, -1)]
            yield pa.record_batch(
                [pa.array([language] * len(here), pa.string()), *(strings.take(pa.array(m)) for m in numbers),
                 pa.array(counts[i : i + size], pa.int64())], ["lang", *names, "a"])
        if self.n == 1:
            yield pa.record_batch([pa.array([language]), pa.nulls(1, pa.string()), pa.array([self.spoken], pa.int64())], ["lang", *names, "a"])


def counted(
    texts: DataFrame, n: int, least: int, heads: PhraseFilter | None = None, tails: PhraseFilter | None = None,
    slice_bytes: int = 1 << 20, most_held: int = 2_000_000,
) -> DataFrame:
    """(lang, w1 .. wn, a): phrases of n words that occur at least `least` times; for n = 1 also a row for each language
    whose word is null, with the number of all words. A task combines its counts up to `most_held` phrases."""
    filters = texts.sparkSession.sparkContext.broadcast((heads, tails))
    names = _words(n)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies: dict[str, Tally] = {}
        for batch in batches:
            for language, data in _by_language(batch, slice_bytes, n):
                tally = tallies.setdefault(language, Tally(n, language, *filters.value))
                if not tally.add(data):
                    yield from tally.rows(language, names)
                    tallies[language] = tally = Tally(n, language, *filters.value)
                    tally.add(data)
                if sum(t.held for t in tallies.values()) > 2 * most_held:
                    for t in tallies.values():
                        t.merge()
                    if sum(t.held for t in tallies.values()) > most_held:
                        for spoken in list(tallies):
                            yield from tallies.pop(spoken).rows(spoken, names)
        for spoken in list(tallies):
            yield from tallies.pop(spoken).rows(spoken, names)

    parts = texts.mapInArrow(work, f"lang string, {', '.join(f'{w} string' for w in names)}, a long")
    # Combined in the tasks already: dealt out first, so that they need no second table for it.
    frequent = parts.repartition("lang", *names).groupBy("lang", *names).agg(F.sum("a").alias("a"))
    return frequent.where((F.col("a") >= least) | F.col("w1").isNull())


def _by_language(batch: pa.RecordBatch, size: int, n: int) -> Iterator[tuple[str, bytes]]:
    """(language, slice) of a batch, of which about `size` bytes are held as texts at a time."""
    for language in pc.unique(batch.column("lang")).to_pylist():
        own = batch.filter(pc.equal(batch.column("lang"), language)).column("text").cast(pa.binary())
        for rows in byte_slices(own, size):
            for data in slices(own[rows].to_pylist(), size, n):
                yield language, data


def score(a: Column, l: Column, r: Column) -> Column:
    """floor(1000000 a a / (l r)), exact for counts below 10^15."""
    wide = [c.cast("decimal(15,0)") for c in (a, l, r)]
    return F.call_function("div", F.lit(Decimal(SCALE)) * (wide[0] * wide[0]), wide[1] * wide[2])


def _with_count(phrases: DataFrame, counts: DataFrame, of: list[str], name: str) -> DataFrame:
    """Adds the count of the part that consists of the columns `of`."""
    k = len(of)
    part = counts.select("lang", *(F.col(w).alias(o) for w, o in zip(_words(k), of)), F.col("a").alias(name))
    return phrases.join(part, ["lang", *of])


def _floors(pairs: DataFrame, wanted: int) -> DataFrame:
    """(lang, floor): at least `wanted` pairs of the language score `floor` or more; 0 if there are fewer pairs."""
    bin_ = F.floor(F.log2(F.col("score") + 1) * 16)
    bins = pairs.groupBy("lang", bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    down = Window.partitionBy("lang").orderBy(F.desc("bin"))  # some 320 bins at most
    reached = bins.withColumn("upto", F.sum("n").over(down)).groupBy("lang").agg(
        F.max(F.when(F.col("upto") >= wanted, F.col("least"))).alias("floor"))
    return reached.select("lang", F.coalesce("floor", F.lit(0)).cast("long").alias("floor"))


def collocations(
    docs: DataFrame, top: int = 2000, least: int = 10, share: int = 50, filter_bits: int = 29, first_round: int = 2,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first `top` of each language by score, count, and phrase. `first_round`
    times `top` pairs open the first round."""
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    all_words = staged(counted(texts, 1, least), "words")
    totals = all_words.where("w1 is null").select("lang", F.col("a").alias("n"))
    words = all_words.where("w1 is not null")
    word_filter = phrase_filter(words, 1, filter_bits)
    pairs = counted(texts, 2, least, word_filter, word_filter)
    pairs = _with_count(_with_count(pairs, words, ["w1"], "l"), words, ["w2"], "r")
    pairs = staged(
        pairs.withColumn("score", score(F.col("a"), F.col("l"), F.col("r")))
        .withColumn("bound", F.call_function("div", F.col("a").cast("decimal(15,0)") * F.lit(Decimal(SCALE)), F.col("l").cast("decimal(15,0)"))),
        "pairs",
    )
    pair_filter = phrase_filter(pairs, 2, filter_bits)

    settled: list[DataFrame] = []
    grown: list[DataFrame] = []
    triples: list[DataFrame] = []
    open_ = pairs.select("lang").distinct()
    wanted = first_round * top
    while True:
        mine = pairs.join(open_, "lang", "left_semi")
        floors = staged(_floors(mine, wanted), "floors")
        rated = mine.join(floors, "lang")
        # A pair (x, y) above the floor may be dropped by (w, x, y), which needs (w, x) grown though its bound be low.
        heads = rated.where("score >= floor").groupBy("lang", F.col("w1").alias("w2")).agg(F.min("a").alias("rarest"))
        dropping = rated.join(heads, ["lang", "w2"]).where(F.col("a") * 100 >= F.col("rarest") * share)
        frontier = rated.where("bound >= floor").select("lang", "w1", "w2").unionByName(dropping.select("lang", "w1", "w2")).distinct()
        for earlier in grown:
            frontier = frontier.join(earlier, ["lang", "w1", "w2"], "left_anti")
        frontier = staged(frontier, "frontier")
        grown.append(frontier)
        found = counted(
            texts.join(open_, "lang", "left_semi"), 3, least, phrase_filter(frontier, 2, filter_bits), pair_filter,
        ).join(frontier, ["lang", "w1", "w2"], "left_semi")
        for of, counts, name in (
            (["w1"], words, "l1"), (["w2", "w3"], pairs, "r1"), (["w1", "w2"], pairs, "l2"), (["w3"], words, "r2"),
        ):
            found = _with_count(found, counts, of, name)
        one = score(F.col("a"), F.col("l1"), F.col("r1"))
        two = score(F.col("a"), F.col("l2"), F.col("r2"))
        found = found.withColumn("least", F.least(F.struct(one.alias("score"), F.lit(1).alias("k"), F.col("l1").alias("l"), F.col("r1").alias("r")),
                                                  F.struct(two.alias("score"), F.lit(2).alias("k"), F.col("l2").alias("l"), F.col("r2").alias("r"))))
        triples.append(staged(found.select("lang", "w1", "w2", "w3", "a", "least.l", "least.r", "least.score"), "triples"))

        known = triples[0]
        for more in triples[1:]:
            known = known.unionByName(more)
        inside = known.select("lang", "w1", "w2", "a").unionByName(
            known.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
        around = inside.groupBy("lang", "w1", "w2").agg(F.max("a").alias("longer"))
        kept = (
            rated.where("score >= floor").join(around, ["lang", "w1", "w2"], "left")
            .where(F.coalesce(F.col("longer") * 100 < F.col("a") * share, F.lit(True)))
            .select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", "score")
        )
        kept = kept.unionByName(known.join(floors, "lang").where("score >= floor").select(
            "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", "l", "r", "score"))
        kept = staged(kept, "survivors")
        full = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("left"))
        again = staged(
            floors.where("floor > 0").join(full, "lang", "left").where(F.coalesce("left", F.lit(0)) < top).select("lang"), "open")
        settled.append(kept.join(again, "lang", "left_anti"))
        if again.isEmpty():
            break
        open_, wanted = again, wanted * 4

    result = settled[0]
    for more in settled[1:]:
        result = result.unionByName(more)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = result.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
