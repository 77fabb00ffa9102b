"""Token counts by byte-pair merging with a heap and a linked list; no token identifiers are made.

A text gets its space mark in front, spaces become the mark, and it is cut before each run of marks and around each
character that no longer piece contains: no merge crosses such a cut, because no piece has a mark after another
character (checked when the vocabulary is read). In each part the adjacent pair with the lowest rank, leftmost first,
is popped and merged until no pair is left: its count is its initial symbols minus its merges, plus the bytes beyond
one of each symbol that the vocabulary lacks.

Counts equal the library's default (no added tokens, strings of special tokens are ordinary text). A null or empty
text has no tokens. Counts of parts are kept in a table of bounded size in each worker. Extra columns are ignored; a
repeated row gives a repeated result.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

MARK = "▁"
TABLE_ENTRIES = 1_000_000


class PairMerger(dict):
    """Part of a text -> number of tokens."""

    def __init__(self, model_path: str, entries: int = TABLE_ENTRIES):
        super().__init__()
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.entries = entries
        self.ranks: dict[str, float] = {}
        for i in range(model.get_piece_size()):
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.ranks[model.id_to_piece(i)] = -model.get_score(i)
        longer = [p for p in self.ranks if len(p) > 1]
        if any(MARK in p.lstrip(MARK) for p in longer):
            raise ValueError("a piece has a space mark after another character")
        if model.normalize(" a  b ") != f"{MARK}{MARK}a{MARK}{MARK}b{MARK}":
            raise ValueError("the model changes texts other than by space marks")
        alone = "".join(sorted(set("\n\t\r") - set("".join(longer))))
        self.part = re.compile(f"[{alone}]|{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+")

    def __missing__(self, part: str) -> int:
        if len(self) >= self.entries:
            self.clear()
        count = self[part] = self.merged(part)
        return count

    def merged(self, part: str) -> int:
        n = len(part)
        ranks = self.ranks
        symbols = list(part)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[pair], i, pair) for i in range(n - 1) if (pair := part[i : i + 2]) in ranks]
        heapq.heapify(heap)
        count = n
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            # A pair is stale when one of its symbols was merged since it was pushed.
            if not symbols[i] or j >= n or symbols[i] + symbols[j] != pair:
                continue
            symbols[i], symbols[j] = pair, ""
            after[i] = k = after[j]
            count -= 1
            if k < n:
                before[k] = i
                if (pair := symbols[i] + symbols[k]) in ranks:
                    heapq.heappush(heap, (ranks[pair], i, pair))
            h = before[i]
            if h >= 0 and (pair := symbols[h] + symbols[i]) in ranks:
                heapq.heappush(heap, (ranks[pair], h, pair))
        return count + sum(len(s.encode()) - 1 for s in symbols if len(s) == 1 and s not in ranks)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        return sum(map(self.__getitem__, self.part.findall(MARK + text.replace(" ", MARK))))


@lru_cache(maxsize=4)
def merger(model_path: str) -> PairMerger:
    return PairMerger(model_path)


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit): one row for each row of `docs`."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = merger(model_path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            tokens = [pairs.count(t) for t in texts]
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"),
                "n_bytes": pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64()),
                "n_tokens": pa.array(tokens, pa.int64()),
                "over_limit": pa.array([n > limit for n in tokens]),
            })

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return docs.select("doc_id", "text").mapInArrow(count, schema)
