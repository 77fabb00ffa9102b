"""Language by cross-parsing entropy: which language's labelled text explains a text in the fewest phrases.

Learning: for each language a bounded sample of labelled text (`docs_per_language` documents, the first in the order
of a hash, `bytes_per_doc` from the middle of each) is turned into a suffix automaton by one Spark task per language.

Prediction: a text is lower-cased, ASCII characters other than letters become spaces, runs of spaces one, and it is
cut into blocks of `block` bytes. In each block the automaton of a language reads on while the bytes occur in its
sample; where they do not, a phrase ends and the next begins. The phrases, times the logarithm of the sample's size
(the cost of pointing into it), are the cost of the language. The cheapest language wins, ties go to the smaller
name. All blocks of a batch are read in step, in one array operation per byte position.

The score is the winner's share when each language weighs exp(-cost). A text that is null or has no letter is `und`
with score 0. Without any labelled text every text is `und`. Only text and label are used in learning, only text in
prediction. A repeated row gives a repeated result; extra columns are ignored.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallylake.llm.staging import byte_slices, staged

UNKNOWN = "und"
_TO_SPACE = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def normalised(text: str | None) -> bytes:
    return b" ".join((text or "").lower().encode().translate(_TO_SPACE).split())


def automaton(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The suffix automaton of `data`: its transitions (state, byte, next state) and the number of states."""
    links, lengths, moves = [-1], [0], [{}]
    last = 0
    for byte in data:
        state = len(lengths)
        lengths.append(lengths[last] + 1)
        links.append(0)
        moves.append({})
        at = last
        while at >= 0 and byte not in moves[at]:
            moves[at][byte] = state
            at = links[at]
        if at >= 0:
            target = moves[at][byte]
            if lengths[target] == lengths[at] + 1:
                links[state] = target
            else:
                twin = len(lengths)
                lengths.append(lengths[at] + 1)
                links.append(links[target])
                moves.append(dict(moves[target]))
                while at >= 0 and moves[at].get(byte) == target:
                    moves[at][byte] = twin
                    at = links[at]
                links[target] = links[state] = twin
        last = state
    sizes = np.array([len(m) for m in moves])
    return (
        np.repeat(np.arange(len(moves), dtype=np.int32), sizes),
        np.fromiter((b for m in moves for b in m), np.uint8, sizes.sum()),
        np.fromiter((t for m in moves for t in m.values()), np.int32, sizes.sum()),
        len(moves),
    )


class Parser:
    """The automata of all languages as one table: next state + 1 by state and byte, negative where a phrase begins."""

    def __init__(self, rows: list[tuple[str, int, bytes]], block: int):
        rows = sorted(rows)
        self.languages = [r[0] for r in rows]
        self.weights = np.array([math.log(max(r[1], 2)) for r in rows])
        self.block = block
        automata = [pickle.loads(r[2]) for r in rows]
        known = np.unique(np.concatenate([a[1] for a in automata]))
        self.classes = np.zeros(256, np.int32)
        self.classes[known] = np.arange(1, len(known) + 1)
        self.width = len(known) + 1
        # Tables are made in place: beside the whole there is never a second copy of one.
        cells = np.cumsum([0, *(a[3] * self.width for a in automata)])
        self.bases = cells[:-1, None]
        self.table = np.zeros(cells[-1], np.int32)
        for (states, letters, targets, n), base in zip(automata, cells.tolist()):
            # State 0, the root, also stands for what follows an unknown byte: everything begins a phrase there.
            table = self.table[base : base + n * self.width].reshape(n, self.width)
            begin = np.zeros(self.width, np.int32)
            root = states == 0
            begin[self.classes[letters[root]]] = targets[root]
            begin = -(begin + 1)
            table[:] = begin
            table[states, self.classes[letters]] = targets + 1
            table[0] = begin

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Number of phrases by language and text."""
        sizes = np.array([len(t) for t in texts], np.int64)
        blocks = -(-sizes // self.block)
        owner = np.repeat(np.arange(len(texts)), blocks)
        offset = (np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * self.block
        begin = np.repeat(np.cumsum(sizes) - sizes, blocks) + offset
        length = np.minimum(sizes[owner] - offset, self.block)
        order = np.argsort(-length, kind="stable")
        begin, length = begin[order], length[order]
        data = self.classes[np.frombuffer(b"".join(texts), np.uint8)]
        counts = np.zeros((len(self.languages), len(begin)), np.int32)
        state = np.zeros((len(self.languages), len(begin)), np.int64)
        live = np.searchsorted(-length, -np.arange(self.block), side="left")
        for step, n in enumerate(live.tolist()):
            if not n:
                break
            found = self.table.take(state[:, :n] * self.width + data[begin[:n] + step] + self.bases)
            counts[:, :n] += found < 0
            state[:, :n] = np.abs(found) - 1
        total = np.zeros((len(self.languages), len(texts)), np.int64)
        for row, count in zip(total, counts):
            row += np.bincount(owner[order], weights=count, minlength=len(texts)).astype(np.int64)
        return total

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        plain = [normalised(t) for t in texts]
        cost = self.phrases(plain) * self.weights[:, None]
        best = cost.argmin(axis=0)
        share = 1 / np.exp(np.minimum(cost.min(axis=0) - cost, 0)).sum(axis=0)
        spoken = [t is not None and any(map(str.isalpha, t)) for t in texts]
        return (
            [self.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), spoken)],
            [s if ok else 0.0 for s, ok in zip(share.tolist(), spoken)],
        )


def learn(labelled: DataFrame, docs_per_language: int = 96, bytes_per_doc: int = 512) -> list[tuple[str, int, bytes]]:
    """(language, size of its sample, automaton) from rows with text and lang; both bounds are per language."""
    first = Window.partitionBy("lang").orderBy("order", "doc_id")
    wanted = "lang is not null and text is not null"
    chosen = staged(
        labelled.where(wanted).where(F.col("text").rlike("\\p{L}"))
        .select("lang", "doc_id", F.xxhash64("doc_id").alias("order"))
        .withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= docs_per_language),
        "language-sample",
    )

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for text in rows.sort_values(["place"])["text"]:
            plain = normalised(text)
            skip = max(0, len(plain) - bytes_per_doc) // 2
            parts.append(plain[skip : skip + bytes_per_doc])
        data = b" ".join(parts)
        return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "size": [len(data)], "made": [pickle.dumps(automaton(data))]})

    # The chosen ids are bounded in number for each language, so they are broadcast and only their texts are shuffled.
    ids = chosen.groupBy("lang", "doc_id").agg(F.min("place").alias("place"))
    texts = labelled.where(wanted).select("lang", "doc_id", "text").join(F.broadcast(ids), ["lang", "doc_id"])
    texts = texts.dropDuplicates(["lang", "doc_id"])
    made = texts.groupBy("lang").applyInPandas(build, "lang string, size long, made binary")
    return [tuple(r) for r in made.where("size > 0").collect()]


def predict(docs: DataFrame, models: list[tuple[str, int, bytes]], block: int = 512) -> DataFrame:
    """(doc_id, lang_pred, score): one row for each row of `docs`."""
    held = docs.sparkSession.sparkContext.broadcast(models)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser(held.value, block) if held.value else None
        for batch in batches:
            text, languages, scores = batch.column("text"), [], []
            for rows in byte_slices(text):
                texts = text[rows].to_pylist()
                told, sure = parser.predict(texts) if parser else ([UNKNOWN] * len(texts), [0.0] * len(texts))
                languages += told
                scores += sure
            yield pa.record_batch({
                **{c: batch.column(c) for c in batch.schema.names if c not in ("lang_pred", "score")},
                "lang_pred": pa.array(languages, pa.string()),
                "score": pa.array(scores, pa.float64()),
            })

    rest = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]
    schema = docs.select(*(f"`{f.name}`" for f in rest)).schema.add("lang_pred", "string").add("score", "double")
    return docs.mapInArrow(work, schema)


def held_out(parts: int, fold: int) -> Column:
    """Rows that must not be learnt from: crc32 of the id as text leaves `fold`."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == fold
