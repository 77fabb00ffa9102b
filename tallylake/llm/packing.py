"""Packing documents into training sequences by non-negative least squares over length patterns.

1. Texts are tokenised whole, with an end token; a document longer than a sequence is cut into full pieces, the first
   of which may be shorter.
2. The histogram of piece lengths, one number for each length, is all that the planner sees. It enumerates the
   patterns of one, two or three pieces that fill a sequence exactly, fits how often each pattern repeats to the
   histogram by non-negative least squares (accelerated projected gradient), and rounds down so that no length is
   overdrawn. What is left is packed best-fit, longest first, still on counts. The planner's work depends on the
   sequence length, not on the number of documents.
3. The plan lists, for each length, which ranks go to which place of which pattern. Pieces get their rank within their
   length by running totals over range partitions, and look up their sequence and offset.

A null text counts as empty and packs its end token. Rows that repeat a document are packed again. Extra columns are
ignored; no documents, no sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.llm.prefix import running_totals
from tallylake.llm.staging import staged

CACHED_WORDS = 1_000_000
CACHED_BYTES = 24 << 20  # of words, their identifiers and what Python needs to hold both, in each of two generations
_PER_WORD = 240


# Fixed value: the pattern by which byte-level vocabularies of this kind cut a text before merging.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _bytes_by_letter() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others, in order, as letters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Identifiers as the tokenizers library gives them, with a table of words.

    The pre-tokeniser never looks across a single space or line end between words, so a text without other white space
    is the tokens of its words in a row: a word has its space with it, a line end is a token of its own. Words that are
    new are merged in one go, by a faster engine with the same vocabulary; it is used only if both agree on a probe.
    Texts with other white space or with the string of an added token go to the library whole."""

    def __init__(self, path: str, entries: int = CACHED_WORDS, limit: int = CACHED_BYTES):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.entries, self.limit = entries, limit
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        letters = _bytes_by_letter()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items() if token not in self.added}
        self.engine = tiktoken.Encoding("words", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})
        self.line = self._library(["\n"])[0]
        probe = "a.\nb c It's éclair, 日本 1234!?\nTheend of-line\nx"
        self.words_hold = len(self.line) == 4 and self._library([probe])[0] == self._by_words([self._cut(probe)])[0]

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    @staticmethod
    def _cut(text: str) -> list[str]:
        """The words of a text; those that begin a line have a line end in front, the others stand for a space and
        themselves."""
        return ("\n" + text).replace("\n", " \n").split(" ")[1:]

    def _learn(self, words: list[str]) -> None:
        """One call for many words, told apart by line ends, whose identifier appears nowhere else."""
        ids = np.array(self.engine.encode_ordinary("".join(w if w[0] == "\n" else "\n " + w for w in words)), "<u4")
        data = ids.tobytes()
        at = (4 * np.flatnonzero(ids == int.from_bytes(self.line, "little"))).tolist()
        for word, a, b in zip(words, at, [*at[1:], len(data)]):
            self._keep(word, data[a if word[0] == "\n" else a + 4 : b])

    def _keep(self, word: str, ids: bytes) -> None:
        self.words[word] = ids
        self.held += len(word) + len(ids) + _PER_WORD

    def _by_words(self, cut: list[list[str]]) -> list[bytes]:
        """A full table becomes the older one; words that are met again move on to the new one, others go with it."""
        if self.held > self.limit or len(self.words) > self.entries:
            self.older, self.words, self.held = self.words, {}, 0
        missing = []
        for word in set().union(*cut).difference(self.words):
            ids = self.older.get(word)
            if ids is None:
                missing.append(word)
            else:
                self._keep(word, ids)
        if missing:
            self._learn(missing)
        get = self.words.__getitem__
        return [b"".join(map(get, words))[4:] for words in cut]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The identifiers of each text as little-endian 32-bit numbers."""
        result, chosen, cuts, whole = [b""] * len(texts), [], [], []
        for i, text in enumerate(texts):
            if not text:
                continue
            cut = self._cut(text)
            # No gap is wider than one character or at an end, and none is other white space.
            even = "" not in cut and "\n" not in cut and len("".join(text.split())) == len(text) - len(cut) + 1
            if self.words_hold and even and not any(a in text for a in self.added):
                chosen.append(i)
                cuts.append(cut)
            else:
                whole.append(i)
        for places, made in (
            (whole, self._library([texts[i] for i in whole]) if whole else []), (chosen, self._by_words(cuts))
        ):
            for i, ids in zip(places, made):
                result[i] = ids
        return result


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(docs: DataFrame, tokenizer_path: str, end_token: int = 2, capacity: int = 1024) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32)"""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    tail = np.array([end_token], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path).encode
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows = []
                for doc, ids in zip(part.column("doc_id").to_pylist(), encode(part.column("text").to_pylist())):
                    ids += tail
                    total = len(ids) // 4
                    bounds = [0, *range(total % capacity or capacity, total + 1, capacity)]
                    rows += [(doc, i, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for i, (a, b) in enumerate(zip(bounds, bounds[1:]))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(work, schema)


def exact_patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Rows of three lengths, in order and 0 for none, that add up to `capacity`."""
    present = np.zeros(capacity + 1, bool)
    present[lengths] = True
    present[0] = True
    a, b = np.meshgrid(np.flatnonzero(present), np.flatnonzero(present), indexing="ij")
    c = capacity - a - b
    keep = (a <= b) & (b <= c) & present[np.maximum(c, 0)]
    return np.stack((a[keep], b[keep], c[keep]), axis=1)


def fitted_repeats(patterns: np.ndarray, histogram: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative repeat counts that bring the lengths used close to `histogram` in least squares."""
    size = len(histogram)

    def used(x: np.ndarray) -> np.ndarray:
        total = sum(np.bincount(column, weights=x, minlength=size) for column in patterns.T)
        total[0] = 0
        return total

    goal = histogram / max(histogram.max(), 1)
    uses = np.bincount(patterns.ravel(), minlength=size)
    uses[0] = 0
    step = 1 / max(3 * uses.max(), 1)
    x = np.zeros(len(patterns))
    ahead, pace = x, 1.0
    for _ in range(rounds):
        error = used(ahead) - goal
        error[0] = 0
        then = np.maximum(ahead - step * error[patterns].sum(axis=1), 0)
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead, x, pace = then + (pace - 1) / faster * (then - x), then, faster
    return x * max(histogram.max(), 1)


@dataclass
class Plan:
    """For each place of each pattern: the length, its first rank there, how many, first sequence and offset."""

    length: np.ndarray
    rank: np.ndarray
    count: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        width = int(max(self.rank.max(), rank.max())) + 1
        at = np.searchsorted(self.length * width + self.rank, length * width + rank, side="right") - 1
        return self.sequence[at] + rank - self.rank[at], self.offset[at]


def plan_sequences(histogram: np.ndarray, capacity: int) -> Plan:
    """`histogram`: number of pieces by length, up to `capacity`."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    chosen: list[tuple[tuple[int, ...], int]] = []
    lengths = np.flatnonzero(left)
    patterns = exact_patterns(lengths, capacity) if len(lengths) else np.empty((0, 3), np.int64)
    if len(patterns):
        repeats = np.floor(fitted_repeats(patterns, left.astype(float)) + 1e-6).astype(np.int64)
        for i in np.argsort(-repeats, kind="stable"):
            parts = tuple(int(v) for v in patterns[i] if v)
            times = min([int(repeats[i]), *(int(left[v]) // parts.count(v) for v in parts)])
            if repeats[i] <= 0:
                break
            if times > 0:
                chosen.append((parts, times))
                for v in parts:
                    left[v] -= times
    chosen += _best_fit(left, capacity)
    rows, used, sequence = [], np.zeros(capacity + 1, np.int64), 0
    for parts, times in chosen:
        offset = 0
        for v in sorted(parts, reverse=True):
            rows.append((v, used[v], times, sequence, offset))
            used[v] += times
            offset += v
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return Plan(*(table[:, i].copy() for i in range(5)))


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first: open sequences are kept by free space, equal ones as a pattern with a count."""
    free: dict[int, list[list]] = {}
    for length in np.flatnonzero(left)[::-1].tolist():
        count = int(left[length])
        while count:
            space = min((s for s, held in free.items() if s >= length and held), default=None)
            if space is None:
                each = capacity // length
                full, rest = divmod(count, each)
                for parts, times in (((length,) * each, full), ((length,) * rest, int(rest > 0))):
                    if times:
                        free.setdefault(capacity - sum(parts), []).append([parts, times])
                break
            parts, times = free[space].pop()
            each = min(space // length, count)
            filled = min(times, count // each)
            if filled < times:
                free[space].append([parts, times - filled])
            free.setdefault(space - each * length, []).append([parts + (length,) * each, filled])
            count -= each * filled
    return [(tuple(parts), times) for held in free.values() for parts, times in held]


def packed(docs: DataFrame, tokenizer_path: str, end_token: int = 2, capacity: int = 1024) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): one row for each piece."""
    made = staged(pieces(docs, tokenizer_path, end_token, capacity), "pieces")
    counted = made.groupBy("length").count().toArrow()  # at most `capacity` rows
    histogram = np.zeros(capacity + 1, np.int64)
    histogram[counted["length"].to_numpy()] = counted["count"].to_numpy()
    plan = docs.sparkSession.sparkContext.broadcast(plan_sequences(histogram, capacity))
    ranked = running_totals(made.withColumn("one", F.lit(1).cast("long")), "length", ["doc_id", "piece", "ids_crc32"], "one", "ranks")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sequence, offset = plan.value.place(batch.column("length").to_numpy(), batch.column("before").to_numpy())
            yield pa.record_batch({**{c: batch.column(c) for c in columns}, "sequence_id": sequence, "offset": offset})

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.select(*columns, "before").mapInArrow(work, schema)
