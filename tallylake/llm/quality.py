"""Quality by supervised subword embeddings: learned vectors of words, word pairs and character n-grams, averaged.

Features of a text: each word (what stands between white space, as written), its character n-grams of 3 to 5 bytes with
marks for its ends, and each pair of neighbouring words (a word said twice in a row counts as one and the same pair,
whatever the word); all are hashed to one of 2^`bits` places, repeats count. Every place has a learned vector of `width` numbers. A document is the mean of its features' vectors; a linear layer and a
softmax over the two labels follow. All is learned by stochastic gradient descent in numpy.

The learner sees at most `sample` labelled documents, the first in the order of a hash, `passes` times, in another order
each time. Features are made in parallel and packed (some 5 KB for 500 words); one task holds those of the sample and
updates the vectors. Behind the mean everything is linear, so what is broadcast for scoring is one number for each place (2^`bits` numbers of four bytes). Scoring sums
them over whole texts; words of a slice are looked up once.

A text without words is scored by the share of the labels alone; without any labelled row every score is 0.5. A document
labelled several times is good only if all labels say so, and if several texts have its doc_id the one with the smallest
hash is learnt from. Labels of a null doc_id are not used. A repeated row, or one with a null doc_id, gives a row of its
own; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.llm.staging import byte_slices, staged

_MIX, _PAIR = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
SHORTEST, LONGEST = 3, 5


@dataclass
class Features:
    """Places of the features of some texts: those of each distinct word, and those of each text's pairs."""

    sizes: np.ndarray  # words of each text
    codes: np.ndarray  # the words of all texts, as numbers of distinct words
    places: np.ndarray  # features of the distinct words, one word after another
    starts: np.ndarray  # where each distinct word's features begin
    pairs: np.ndarray  # for each word but the last: the place of the pair with the next one


def features(texts: list[str | None], bits: int) -> Features:
    words = [(t or "").encode().split() for t in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    known = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(words)))}
    codes = np.fromiter(map(known.__getitem__, chain.from_iterable(words)), np.int64, sizes.sum())
    shift = np.uint64(64 - bits)
    whole = np.fromiter(map(xxhash.xxh64_intdigest, known), np.uint64, len(known))
    # All distinct words in one row of bytes, each between two marks that no word has.
    data = np.frombuffer(b"".join(b"\n" + w + b"\r" for w in known), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(known)), np.fromiter((len(w) + 2 for w in known), np.int64, len(known)))
    owners, places = [np.arange(len(known))], [(whole * _MIX) >> shift]
    for n in range(SHORTEST, LONGEST + 1):
        count = len(data) - n + 1
        if count < 1:
            break
        h = np.full(count, n, np.uint64)
        for i in range(n):
            h = (h ^ data[i : i + count]) * _MIX
            h ^= h >> np.uint64(29)
        inside = owner[:count] == owner[n - 1 :]
        owners.append(owner[:count][inside])
        places.append((h[inside] * _PAIR) >> shift)
    owners, places = np.concatenate(owners), np.concatenate(places).astype(np.int64)
    order = np.argsort(owners, kind="stable")
    starts = np.searchsorted(owners[order], np.arange(len(known)))
    mixed = whole[codes]
    pairs = np.where(codes[:-1] == codes[1:], _PAIR, (mixed[:-1] * _PAIR ^ mixed[1:]) * _MIX) >> shift
    return Features(sizes, codes, places[order], starts, pairs.astype(np.int64))


def of_each(found: Features) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct places of each text, in order, and how often they occur."""
    ends = np.append(found.starts[1:], len(found.places))
    at = 0
    for size in found.sizes.tolist():
        codes, times = np.unique(found.codes[at : at + size], return_counts=True)
        own = [found.places[found.starts[c] : ends[c]] for c in codes]
        pairs = found.pairs[at : at + size - 1] if size else found.pairs[:0]
        at += size
        places, index = np.unique(np.concatenate([*own, pairs]), return_inverse=True)
        counts = np.concatenate([np.repeat(times, [len(p) for p in own]), np.ones(len(pairs), np.int64)])
        yield places, np.bincount(index, weights=counts).astype(np.int64)


def packed(places: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending places and their counts in few bytes: steps, by significance of bytes, compressed."""
    numbers = np.concatenate((np.diff(places, prepend=0), counts)).astype("<u4")
    return zlib.compress(numbers.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1).T
    steps, counts = np.ascontiguousarray(raw).view("<u4").ravel().astype(np.int64).reshape(2, -1)
    return np.cumsum(steps), counts


class Learner:
    """Vectors of all places, a layer of two rows with biases, and plain gradient steps."""

    def __init__(self, bits: int, width: int, seed: int = 0):
        self.vectors = np.random.default_rng(seed).uniform(-1 / width, 1 / width, (1 << bits, width)).astype(np.float32)
        self.layer = np.zeros((2, width), np.float32)
        self.bias = np.zeros(2, np.float32)

    def chances(self, hidden: np.ndarray) -> np.ndarray:
        logits = self.layer @ hidden + self.bias
        raised = np.exp(logits - logits.max())
        return raised / raised.sum()

    def update(self, places: np.ndarray, shares: np.ndarray, label: int, rate: float) -> None:
        """`places` are distinct. The gradient of a place's vector is that of the mean times its share; the step is
        scaled up by the number of places, as else long texts would hardly teach."""
        hidden = shares @ self.vectors[places]
        error = self.chances(hidden)
        error[label] -= 1
        back = error @ self.layer
        self.layer -= rate * np.outer(error, hidden)
        self.bias -= rate * error
        self.vectors[places] -= (rate * len(places)) * shares[:, None] * back

    def weights(self) -> tuple[np.ndarray, float]:
        """What each place adds to the logit of label 1, and the bias."""
        return self.vectors @ (self.layer[1] - self.layer[0]), float(self.bias[1] - self.bias[0])


Model = tuple[np.ndarray, float]


def learn(
    docs: DataFrame, labels: DataFrame, sample: int = 8_000, passes: int = 3, bits: int = 18, width: int = 8,
    rate: float = 0.2,
) -> Model:
    """The weight of each place and the bias, from `labels` (doc_id, quality) and the texts of `docs`."""
    marked = (
        labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    )
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    texts = docs.groupBy("doc_id").agg(F.min(text_hash).alias("hash"))
    known = texts.join(marked, "doc_id").withColumn("place", F.xxhash64("doc_id"))
    chosen = staged(known.orderBy("place", "doc_id").limit(sample).withColumn("good", (F.col("quality") > 0).cast("int")), "quality-sample")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                rows = batch.slice(i, 64)
                made = list(of_each(features(rows.column("text").to_pylist(), bits)))
                yield pa.record_batch({
                    **{c: rows.column(c) for c in ("doc_id", "place", "good")},
                    "features": pa.array([packed(*m) for m in made], pa.binary()),
                })

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(b.column("place").to_pylist(), b.column("good").to_pylist(), b.column("features").to_pylist())]
        learner, shuffled, done = Learner(bits, width), np.random.default_rng(1), 0
        for _ in range(passes):
            for i in shuffled.permutation(len(rows)).tolist():
                places, counts = unpacked(rows[i][2])
                step = rate * max(0.05, 1 - done / (len(rows) * passes))
                learner.update(places, (counts / max(1, counts.sum())).astype(np.float32), rows[i][1], step)
                done += 1
        weights, bias = learner.weights() if done else (np.zeros(1 << bits, np.float32), 0.0)
        yield pa.record_batch({"weights": pa.array([weights.tobytes()], pa.binary()), "bias": pa.array([bias], pa.float64())})

    rows = (
        docs.select("doc_id", "text", text_hash.alias("hash"))
        .join(F.broadcast(chosen.select("doc_id", "hash", "place", "good")), ["doc_id", "hash"])
        .mapInArrow(extract, "doc_id long, place long, good int, features binary")
        .dropDuplicates(["doc_id"])
    )
    gathered = rows.repartition(1).sortWithinPartitions("place", "doc_id")
    table = gathered.mapInArrow(fit, "weights binary, bias double").toArrow()  # one row
    if not table.num_rows:
        return np.zeros(1 << bits, np.float32), 0.0
    return np.frombuffer(table["weights"][0].as_py(), np.float32), table["bias"][0].as_py()


def scores(texts: list[str | None], model: Model, bits: int) -> np.ndarray:
    """Chance of label 1 for each text."""
    weights, bias = model
    found = features(texts, bits)
    owner = np.repeat(np.arange(len(texts)), found.sizes)
    ends = np.append(found.starts[1:], len(found.places))
    by_word = np.add.reduceat(weights[found.places].astype(np.float64), found.starts) if len(found.starts) else np.zeros(0)
    n_by_word = ends - found.starts
    total = np.bincount(owner, by_word[found.codes], len(texts))
    count = np.bincount(owner, n_by_word[found.codes], len(texts))
    same = owner[:-1] == owner[1:]
    total += np.bincount(owner[:-1][same], weights[found.pairs[same]].astype(np.float64), len(texts))
    count += np.bincount(owner[:-1][same], minlength=len(texts))
    return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + bias, -30, 30)))


def score(docs: DataFrame, model: Model, bits: int = 18, threshold: float = 0.7, slice_bytes: int = 2 << 20) -> DataFrame:
    """(doc_id, score, predicted): one row for each row of `docs`."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            made = [scores(text[s].to_pylist(), held.value, bits) for s in byte_slices(text, slice_bytes)]
            made = np.concatenate(made) if made else np.zeros(0)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"),
                "score": pa.array(made, pa.float64()),
                "predicted": pa.array((made >= threshold).astype(np.int32), pa.int32()),
            })

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, score double, predicted int")
