"""Removal of repeated byte strings: Burrows-Wheeler transforms of shards, merged by interleave refinement.

A byte is removed when a string of `length` bytes (200) that covers it also starts anywhere else, in the same
document or in another. Strings are judged on the input, never on what other removals leave.

1. `winnow` assigns each string of `length` bytes to an anchor: the `gram`-byte piece of it with the smallest hash.
   Equal strings have equal anchors, so only strings of one anchor need comparing. Consecutive strings with the same
   anchor form a stretch. A filter of bounded size keeps most anchors that occur once out of the shuffles; its errors
   only let more rows through.
2. Equal stretches collapse into one with a count; a count above one repeats all their strings. Hot passages are
   summed before they are shuffled.
3. The different stretches of an anchor meet in one task, dealt out over shards. Where more than `most` would meet,
   they are cut, step by step, by the place that the anchor has in a string: a part holds the strings of a quarter of
   the places, and parts meet by the bytes that all strings of that quarter have in common, at last the whole string.
   Equal parts collapse like stretches; what is found for a part is handed up to what it was cut from, so a stretch
   costs a few rows however many share its anchor. Each shard gets its sorted suffixes and its
   Burrows-Wheeler transform, over symbols of `symbol` bytes (a 64-bit hash stands for each). `repeated_starts`
   merges the transforms without sorting suffixes again: the interleave of the shards starts as one block and is
   refined round by round, moving each entry by its shard's last-to-first mapping, stably by symbol. Entries that
   part in round t have a common prefix of less than t symbols; those that share a block after `length` / `symbol`
   rounds form a repeated interval. Blocks of one entry, and prefixes that would cross an end, leave early.

Nulls and texts shorter than `length` have nothing to remove; a null text counts as empty. Rows that repeat a
document are further copies of it; a null doc_id is an id like any other. Texts of any length are read in slices.
An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylake.llm.staging import shuffle_width, staged

END = b"\xff"  # occurs in no UTF-8 text
PLACES = 31  # bits for a position; the other bits of a hash choose the anchor
CHUNK = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SALTS = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        size = max(n, 1 << 20)
        known = np.full(size, base, np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        _POWERS[base] = known
    return known[:n]


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A mixed 64-bit hash of each `gram`-byte piece of `data`."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_SALTS[data] * _powers(_BASE, n), out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * _powers(_INVERSE, n - gram + 1)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` consecutive values."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def winnow(texts: list[bytes], length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Stretches of strings with one anchor, for some texts at a time: index of the text, hash of the anchor, first
    start in the text, number of starts."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= CHUNK or i + 1 == len(texts):
            if i > first and len(text) > CHUNK:
                yield _winnow(texts[first:i], first, length, gram)[:4]
                first = i
            yield _winnow_long(text, i, length, gram) if i == first else _winnow(texts[first : i + 1], first, length, gram)[:4]
            first, size = i + 1, 0


def _winnow_long(text: bytes, index: int, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """One text, in slices of CHUNK starts; a stretch that runs on into the next slice is put together again."""
    slices = []
    for begin in range(0, max(1, len(text) - length + 1), CHUNK):
        _, anchor, start, n, at = _winnow([text[begin : begin + CHUNK + length - 1]], index, length, gram)
        slices.append((anchor, start + begin, n, at + begin))
    anchor, start, n, at = map(np.concatenate, zip(*slices))
    new = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))[: len(at)]
    counts = np.add.reduceat(n, new) if len(new) else n
    return np.full(len(new), index), anchor[new], start[new], counts


def _winnow(texts: list[bytes], first: int, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """As `winnow`, all texts at once; the last array has the places of the anchors in their texts."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) < length:
        none = np.empty(0, np.int64)
        return none, np.empty(0, np.uint64), none, none, none
    hashes = _gram_hashes(data, gram)
    low = np.uint64((1 << PLACES) - 1)
    least = _sliding_min((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), length - gram + 1)
    text = np.repeat(np.arange(len(texts)), np.maximum(sizes - length + 1, 0))
    starts = np.flatnonzero(np.repeat(ends, sizes)[: len(least)] - np.arange(len(least)) >= length)
    least = least[starts]
    new = np.flatnonzero(np.concatenate(([True], (least[1:] != least[:-1]) | (text[1:] != text[:-1]))))[: len(least)]
    counts = np.diff(np.append(new, len(least)))
    at = (least[new] & low).astype(np.int64)
    begin = (ends - sizes)[text[new]]
    return text[new] + first, hashes[at], starts[new] - begin, counts, at - begin


def _sorted_symbols(symbols: np.ndarray) -> np.ndarray:
    """Positions in the order of their symbols."""
    n, bits = len(symbols), np.uint64(max(1, (len(symbols) - 1).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    order = (np.sort((symbols & ~low) | np.arange(n, dtype=np.uint64)) & low).astype(np.int64)
    values = symbols[order]
    if (values[1:] < values[:-1]).any():  # two symbols differ only in the bits that gave way to the position
        order = np.argsort(symbols, kind="stable")
    return order


def _sorted_pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Positions in the order of two ranks below their number."""
    n, bits = len(first), max(1, (len(first) - 1).bit_length())
    if 3 * bits > 63:
        return np.argsort(first * n + second, kind="stable")
    return np.sort(first << 2 * bits | second << bits | np.arange(n)) & ((1 << bits) - 1)


def _ranks(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Equal keys get one rank, counted in `order`."""
    parted = np.zeros(len(order), bool)
    for key in keys:
        values = key[order]
        parted[1:] |= values[1:] != values[:-1]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(parted)
    return ranks


@dataclass
class Shard:
    """Some texts, each followed by END: sorted suffixes, transform and last-to-first mapping by symbols."""

    suffixes: np.ndarray
    transform: np.ndarray
    mapping: np.ndarray
    ranks: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, symbols: np.ndarray, length: int, symbol: int) -> Shard:
        n = len(data)
        suffixes = _sorted_symbols(symbols)
        one = rank = _ranks(suffixes, symbols)
        known = symbol
        while known < length:
            more, step = (rank, known) if 2 * known <= length else (one, symbol)
            then = np.concatenate((more[known % n :], more[: known % n]))
            suffixes = _sorted_pairs(rank, then)
            rank = _ranks(suffixes, rank, then)
            known += step
        ranks = np.empty(n, np.int64)
        ranks[suffixes] = np.arange(n)
        before = suffixes - symbol
        before[before < 0] += n
        return cls(suffixes, symbols[before], ranks[before], ranks)


def repeated_starts(texts: list[bytes], length: int = 200, symbol: int = 40, shards: int = 4) -> list[np.ndarray]:
    """For each text the starts of its `length`-byte strings that also start elsewhere in `texts`."""
    if length % symbol:
        raise ValueError("length must be a multiple of symbol")
    dealt = [s for s in (np.arange(k, len(texts), shards) for k in range(shards)) if len(s)]
    made, owners, begins, finishes, entries = [], [], [], [], []
    base = 0
    for members in dealt:
        joined = b"".join(texts[i] + END for i in members) + END * symbol
        data = np.frombuffer(joined, np.uint8)
        symbols = _gram_hashes(np.concatenate((data, data[: symbol - 1])), symbol)
        shard = Shard.of(data, symbols, length, symbol)
        sizes = np.array([len(texts[i]) for i in members])
        begin = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        owner = np.repeat(np.arange(len(members)), sizes + 1)
        # A prefix of no symbols that can still become a whole string to its left.
        starts = np.flatnonzero(np.arange(len(owner)) - begin[owner] >= length)
        entries.append(np.sort(shard.ranks[starts]) + base)
        made.append(shard)
        owners.append(np.concatenate((members[owner], np.full(symbol, -1))))
        begins.append(np.concatenate((begin[owner], np.zeros(symbol, np.int64))))
        finishes.append(np.concatenate(((begin + sizes)[owner], np.zeros(symbol, np.int64))))
        base += len(data)
    if not made:
        return []
    offsets = np.cumsum([0, *(len(s.suffixes) for s in made)])
    transform = np.concatenate([s.transform for s in made])
    mapping = np.concatenate([s.mapping + o for s, o in zip(made, offsets)])
    place = np.concatenate([s.suffixes + o for s, o in zip(made, offsets)])
    owner = np.concatenate(owners)
    begin = np.concatenate([b + o for b, o in zip(begins, offsets)])
    finish = np.concatenate([f + o for f, o in zip(finishes, offsets)])

    interleave = np.concatenate(entries)
    block = np.zeros(len(interleave), np.int64)
    rounds = length // symbol
    for t in range(1, rounds + 1):
        if not len(interleave):
            break
        letters = transform[interleave]
        order = np.argsort(letters, kind="stable")
        letters, block = letters[order], block[order]
        interleave = mapping[interleave[order]]
        parted = np.concatenate(([True], (letters[1:] != letters[:-1]) | (block[1:] != block[:-1])))
        block = np.cumsum(parted) - 1
        at = place[interleave]
        inside = (at + symbol * t <= finish[at]) & (at - symbol * (rounds - t) >= begin[at])
        interleave, block = interleave[inside], block[inside]
        shared = np.bincount(block, minlength=1)[block] > 1
        interleave, block = interleave[shared], block[shared]
    found = np.sort(place[interleave])
    texts_of, starts = owner[found], found - begin[found]
    order = np.argsort(texts_of, kind="stable")
    bounds = np.searchsorted(texts_of[order], np.arange(len(texts) + 1))
    starts = starts[order]
    return [starts[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def _stretches(spark, texts: DataFrame, length: int, gram: int, known, kind: str) -> DataFrame:
    """The stretches of all texts. `known`: bits of a filter for anchors ("anchors" counts them, without one), or
    for stretches whose bytes are wanted ("bytes")."""
    schemas = {
        "anchors": "anchor long, n long",
        "places": "anchor long, stretch binary, doc_id long, text_id long, start int, n int",
        "bytes": "anchor long, stretch binary, bytes binary",
    }
    bits = spark.sparkContext.broadcast(known) if known is not None else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, 1000) for whole in batches for at in range(0, whole.num_rows, 1000)):
            doc, text_id = batch.column("doc_id"), batch.column("text_id")
            data = batch.column("text").cast(pa.binary()).to_pylist()
            for owner, anchor, start, n in winnow(data, length, gram):
                signed = anchor.view(np.int64)
                if kind == "anchors":
                    value, count = np.unique(signed, return_counts=True)
                    yield pa.record_batch({"anchor": value, "n": count})
                    continue
                if kind == "places":
                    keep = np.flatnonzero(_among(bits.value, anchor))
                    owner, signed, start, n = owner[keep], signed[keep], start[keep], n[keep]
                spans = zip(owner.tolist(), start.tolist(), (start + n + length - 1).tolist())
                stretch = [xxhash.xxh3_128_digest(data[o][a:b]) for o, a, b in spans]
                if kind == "bytes":
                    names = np.frombuffer(b"".join(stretch), np.uint64)[::2]
                    keep = np.flatnonzero(_among(bits.value, names))
                    once = list({stretch[i]: i for i in keep.tolist()}.values())
                    owner, signed, start, n = owner[once], signed[once], start[once], n[once]
                    stretch = [stretch[i] for i in once]
                    spans = zip(owner.tolist(), start.tolist(), (start + n + length - 1).tolist())
                    columns = {"bytes": pa.array([data[o][a:b] for o, a, b in spans], pa.binary())}
                else:
                    columns = {"doc_id": doc.take(pa.array(owner)), "text_id": text_id.take(pa.array(owner)),
                               "start": start.astype(np.int32), "n": n.astype(np.int32)}
                yield pa.record_batch({"anchor": signed, "stretch": pa.array(stretch, pa.binary()), **columns})

    return texts.mapInArrow(work, schemas[kind])


BITS_PER_VALUE = 16
LEAST_WORDS, MOST_WORDS = 1 << 12, 1 << 22  # 64-bit words of a filter: 32 kilobytes to 32 megabytes
SHIFTS = (0, 17, 34)


def _among(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    found = np.ones(len(values), bool)
    for shift in SHIFTS:
        h = values >> np.uint64(shift) & np.uint64(len(bits) * 64 - 1)
        found &= (bits[(h >> np.uint64(6)).astype(np.int64)] >> (h & np.uint64(63)) & np.uint64(1)).astype(bool)
    return found


def _filter(values: DataFrame) -> np.ndarray:
    """The filter for the one long column of the table `values`, put together by Spark. It grows with the values up to
    a bound; beyond that it lets more through, which costs shuffles and changes no result."""
    needed = values.count() * BITS_PER_VALUE // 64
    size = min(MOST_WORDS, max(LEAST_WORDS, 1 << needed.bit_length()))
    at = F.explode(F.array(*(F.shiftrightunsigned("v", s).bitwiseAND(size * 64 - 1) for s in SHIFTS)))
    words = (
        values.toDF("v").select(at.alias("h"))
        .select(F.shiftright("h", 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(h % 64 AS INT))").alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits"))
    ).toArrow()
    bits = np.zeros(size, np.uint64)
    bits[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return bits


def _compare(length: int, symbol: int, shards: int, batch_bytes: int):
    """Compares the pieces of each route in one go; several routes share a merge of about `batch_bytes`. Pieces that are
    known to be repeated as a whole only serve to find the strings of others."""

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        starts = repeated_starts([r[2] for r in rows], length, symbol, shards)
        found = [(r, s) for r, s in zip(rows, starts) if len(s) and not r[3]]
        return pa.record_batch({
            "route": pa.array([r[0] for r, _ in found], pa.int64()),
            "name": pa.array([r[1] for r, _ in found], pa.binary()),
            "spans": pa.array([_spans(s, length) for _, s in found], pa.list_(pa.struct([("at", pa.int32()), ("end", pa.int32())]))),
        })

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size, route = 0, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("route", "name", "bytes", "copied"))):
                if row[0] != route and size >= batch_bytes:
                    yield flush(rows)
                    rows, size = [], 0
                route = row[0]
                rows.append(row)
                size += len(row[2])
        if rows:
            yield flush(rows)

    return work


def _widths(places: int) -> list[int]:
    """Places of an anchor that share a part, step by step, down to one."""
    widths = []
    while places > 1:
        places = -(-places // 4)
        widths.append(places)
    return widths


def cut_by_place(data: bytes, anchor: int, width: int, length: int, gram: int) -> Iterator[tuple[int, int, bytes]]:
    """(route, shift, part) for the strings of a piece, `width` places of the anchor at a time. The route is a hash of
    the bytes that all strings with these places have in common, so equal strings have equal routes."""
    # The leftmost one is the one that all strings of the piece hold.
    at = int(np.argmax(_gram_hashes(np.frombuffer(data, np.uint8), gram) == np.uint64(anchor)))
    last = len(data) - length
    for cell in range(at // width, (at - last) // width - 1, -1):
        lowest, highest = cell * width, min((cell + 1) * width - 1, length - gram)
        core = data[at - lowest : at - highest + length]
        begin, end = max(0, at - highest), min(last, at - lowest) + length
        yield xxhash.xxh64_intdigest(core, cell), begin, data[begin:end]


def _cut(width: int, length: int, gram: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (route, xxhash.xxh3_128_digest(part), anchor, of_route, of_name, of_copied, shift, part)
                for of_route, of_name, anchor, of_copied, data in zip(
                    *(batch.column(c).to_pylist() for c in ("route", "name", "anchor", "copied", "bytes")))
                for route, shift, part in cut_by_place(data, anchor & (1 << 64) - 1, width, length, gram)
            ]
            routes, names, anchors, of_routes, of_names, of_copied, shifts, parts = zip(*rows) if rows else [()] * 8
            yield pa.record_batch({
                "route": np.array(routes, np.uint64).view(np.int64), "name": pa.array(names, pa.binary()),
                "anchor": pa.array(anchors, pa.int64()), "of_route": pa.array(of_routes, pa.int64()),
                "of_name": pa.array(of_names, pa.binary()), "of_copied": pa.array(of_copied, pa.bool_()), "shift": pa.array(shifts, pa.int32()), "bytes": pa.array(parts, pa.binary()),
            })

    return work


def _spans(starts: np.ndarray, length: int) -> list[dict]:
    """Starts of repeated strings as runs of bytes."""
    if not len(starts):
        return []
    gaps = np.flatnonzero(np.diff(starts) > length)
    first, last = np.append(starts[0], starts[gaps + 1]), np.append(starts[gaps], starts[-1]) + length
    return [{"at": int(a), "end": int(b)} for a, b in zip(first, last)]


def repeated_spans(
    docs: DataFrame, length: int = 200, gram: int = 32, symbol: int = 40, shards: int = 4, most: int = 4096,
    batch_bytes: int = 1 << 19,
) -> DataFrame:
    """(doc_id, text_id, spans): runs of bytes of each document that repeated strings cover; text_id is a hash of
    the text, which tells rows with one doc_id apart."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_id"), "text").where(F.octet_length("text") >= length)

    anchors = _stretches(spark, texts, length, gram, None, "anchors").groupBy("anchor").agg(F.sum("n").alias("n"))
    known = _filter(staged(anchors.where("n > 1").select("anchor"), "anchors"))
    places = staged(_stretches(spark, texts, length, gram, known, "places"), "places")

    stretches = staged(places.groupBy("anchor", "stretch").agg(F.count("*").alias("copies"), F.max("n").alias("n")),
                       "stretches")
    several = staged(stretches.groupBy("anchor").agg(F.count("*").alias("different")).where("different > 1"), "several")
    compared = staged(stretches.join(several, "anchor").select("anchor", "stretch", "different", F.expr("copies > 1").alias("copied")),
                      "compared")
    wanted = _filter(compared.select(_name("stretch")))
    held = staged(
        _stretches(spark, texts, length, gram, wanted, "bytes")
        .groupBy("anchor", "stretch").agg(F.first("bytes").alias("bytes"))
        .join(compared, ["anchor", "stretch"])
        .select(F.col("anchor").alias("route"), F.col("stretch").alias("name"), "anchor", "bytes", "copied", "different"),
        "held")
    whole = F.array(F.struct(F.lit(0).alias("at"), F.octet_length("bytes").alias("end")))

    def meet(pieces: DataFrame) -> DataFrame:
        near = pieces.select("route", "name", "bytes", "copied").repartition(shuffle_width(spark), "route").sortWithinPartitions("route")
        return near.mapInArrow(
            _compare(length, symbol, shards, batch_bytes), "route long, name binary, spans array<struct<at:int,end:int>>")

    # Downwards: what is crowded is cut, and equal parts become one.
    level, found, members = held, [meet(held.where(F.col("different") <= most))], []
    for width in _widths(length - gram + 1):
        crowded = level.where(F.col("different") > most)
        if crowded.isEmpty():
            break
        parts = staged(
            crowded.mapInArrow(_cut(width, length, gram), "route long, name binary, anchor long, of_route long, of_name binary, "
                               "of_copied boolean, shift int, bytes binary"),
            "parts")
        # What is repeated as a whole needs to be told nothing.
        members.append(parts.where("not of_copied").select("route", "name", "of_route", "of_name", "shift"))
        once = parts.groupBy("route", "name").agg(
            F.first("anchor").alias("anchor"), F.first("bytes").alias("bytes"), F.expr("count(*) > 1").alias("copied"))
        once = staged(once, "parts-once")
        # Parts of one place meet by their whole string, so none is crowded there.
        level = staged(once.join(once.groupBy("route").agg(F.count("*").alias("different")), "route"), "parts-counted")
        copied = level.where("copied").select("route", "name", whole.alias("spans"))
        found.append(meet(level.where(F.col("different").between(2, most))).unionByName(copied))
    # Upwards: what is repeated in a part is repeated in what it was cut from.
    while members:
        below = found.pop().join(members.pop(), ["route", "name"])
        handed = below.select(F.col("of_route").alias("route"), F.col("of_name").alias("name"), _moved("shift").alias("spans"))
        merged = handed.groupBy("route", "name").agg(F.flatten(F.collect_list("spans")).alias("spans"))
        found.append(staged(found.pop().unionByName(merged), "repeated-parts"))
    copied = stretches.where("copies > 1").select(
        "anchor", "stretch", F.array(F.struct(F.lit(0).alias("at"), (F.col("n") + length - 1).cast("int").alias("end"))).alias("spans")
    )
    repeated = staged(
        found.pop().select(F.col("route").alias("anchor"), F.col("name").alias("stretch"), "spans").unionByName(copied), "repeated")
    return (
        places.join(repeated, ["anchor", "stretch"])
        .select("doc_id", "text_id", F.explode(_moved("start")).alias("span"))
        .groupBy("doc_id", "text_id").agg(F.collect_list("span").alias("spans"))
    )


def _moved(by: str) -> Column:
    """The spans, further back by a column."""
    return F.transform("spans", lambda s: F.struct((s["at"] + F.col(by)).alias("at"), (s["end"] + F.col(by)).alias("end")))


def _name(column: str):
    """The first eight bytes of a binary column, read as a little-endian long."""
    parts = (F.expr(f"shiftleft(cast(conv(hex(substring({column}, {i + 1}, 1)), 16, 10) AS LONG), {8 * i})") for i in range(8))
    total = next(parts)
    for part in parts:
        total = total.bitwiseOR(part)
    return total


def remove_repeated(docs: DataFrame, **settings) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept): one row for each row of `docs`; `kept` are the bytes
    that stay."""
    spans = repeated_spans(docs, **settings)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("text_id"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column("text").cast(pa.binary()).to_pylist()
            rows = [_without(text, spans) for text, spans in zip(data, batch.column("spans").to_pylist())]
            kept = [r[0] for r in rows]
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"),
                "n_bytes": pa.array([len(d) for d in data], pa.int64()),
                "n_removed": pa.array([len(d) - len(k) for d, k in zip(data, kept)], pa.int64()),
                "n_spans": pa.array([r[1] for r in rows], pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
                "kept": pa.array(kept, pa.binary()),
            })

    spans = spans.withColumnsRenamed({"doc_id": "of_doc", "text_id": "of_text"})
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_id") == F.col("of_text"))
    joined = texts.join(spans, same, "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(cut, schema)


def _without(text: bytes, spans: list[dict] | None) -> tuple[bytes, int]:
    """The bytes outside the spans; the number of maximal runs inside."""
    kept, upto, runs = [], 0, 0
    for at, end in sorted((s["at"], s["end"]) for s in spans or ()):
        if at > upto or not runs:
            kept.append(text[upto:at])
            runs += 1
        upto = max(upto, end)
    kept.append(text[upto:])
    return b"".join(kept), runs
