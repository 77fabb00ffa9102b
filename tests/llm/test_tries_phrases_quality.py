"""Prefix trie, collocations and quality against brute force: nulls, ties, repeats, empty tables, clashing names."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallylake.llm import collocations, prefix_trie, quality
from tallylake.llm.queries import QUERIES

TURNS = "conv_id long, turn long, role string, text string, place long, size long, a long, leaves long"


# --------------------------------------------------------------------------- prefix trie


def rebuilt(rows: list[tuple]) -> dict[int, list[tuple[str, str]]]:
    said = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            said[conv].append((turn is not None, turn or 0, role, mark, text))
    own = {c: [(r, t) for *_, r, _, t in sorted(turns)] for c, turns in said.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return made


def slow_trie(made: dict[int, list[tuple[str, str]]]) -> Counter:
    members = defaultdict(list)
    for c in sorted(made):
        for d in range(len(made[c]) + 1):
            members[tuple(made[c][:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for path, ids in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(ids) - 1) * len(path[-1][1].encode()) if path else 0
    rows = Counter()
    for path, ids in members.items():
        ends = ",".join(str(c) for c in ids if len(made[c]) == len(path))
        rows[(ids[0], len(path), members[path[:-1]][0] if path else None, len(ids), children[path], leaves[path],
              saved[path], hashlib.sha256(ends.encode()).hexdigest())] += 1
    return rows


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(3)
    says = ["hi", "", None, "é", "long " * 50, "same"]
    rows = []
    for c in [*range(60), 77, 1005, 1009, 5_000_000_000, -1, -5]:
        if c % 10 == 5:
            continue  # the base of some conversations is absent
        for turn in range(rng.choice([1, 2, 3, 8, 12])):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(says[: rng.choice([1, 2, 6])])))
    rows += [(7, None, "user", "null turn"), (7, 0, "user", "tie"), (7, 0, "user", "a tie"), rows[5], rows[5]]
    rows += [(None, 0, "user", "nobody")]
    rows += [(100, i, "user", f"{i}") for i in range(700)] + [(101, i, "user", f"{i}") for i in range(690)]
    return [(*r, 9, 9, 9, 9) for r in rows]


@pytest.mark.parametrize("sizes", [{}, {"segment": 3, "block": 8}, {"segment": 64, "block": 100}])
def test_trie_of_rebuilt_conversations(spark, turns, sizes):
    frame = spark.createDataFrame(turns, TURNS).repartition(5)
    nodes = prefix_trie.trie(*prefix_trie.spliced(prefix_trie.numbered(frame)), **sizes)
    assert Counter(tuple(r) for r in nodes.collect()) == slow_trie(rebuilt(turns))


def test_trie_without_rows(spark):
    frame = spark.createDataFrame([], TURNS)
    assert prefix_trie.trie(*prefix_trie.spliced(prefix_trie.numbered(frame))).count() == 0


def test_many_ends_of_one_node(spark):
    rows = [(i, 0, "user", "same") for i in range(0, 3000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    nodes = prefix_trie.trie(prefix_trie.numbered(frame), block=500).collect()
    ends = hashlib.sha256(",".join(map(str, range(3000))).encode()).hexdigest()
    none = hashlib.sha256().hexdigest()
    assert {tuple(r) for r in nodes} == {(0, 0, None, 3000, 1, 1, 2999 * 4, none), (0, 1, 0, 3000, 0, 1, 2999 * 4, ends)}


# --------------------------------------------------------------------------- collocations

WORDS = "alpha beta gamma delta the of Zeta ÉTA x y".split()


def slow_phrases(rows: list[tuple], top: int, least: int, share: int = 50) -> list[tuple]:
    counts, n = defaultdict(Counter), Counter()
    for language, text in rows:
        language = "und" if language is None else language
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            n[language] += len(words)
            for k in (1, 2, 3):
                counts[language].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    made = []
    for language, c in counts.items():
        candidates = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        dropped = {q for p, a in candidates.items() if len(p) == 3 for q in (p[:2], p[1:]) if 100 * a >= share * c[q]}
        rated = []
        for p, a in candidates.items():
            if p not in dropped:
                score, k = min((1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                rated.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for i, (score, a, phrase, left, right) in enumerate(sorted(rated)[:top]):
            made.append((language, i + 1, phrase.decode(), -a, left, right, n[language], -score))
    return sorted(made)


@pytest.fixture(scope="module")
def spoken():
    rng = random.Random(5)
    rows = [("en", None), (None, ""), ("fr", " \t.\n"), ("fr", "a\x00b a\x00b\x1cc"), ("und", "no other words here")]
    for _ in range(150):
        weights = [rng.random() ** 3 for _ in WORDS]
        parts = rng.choices(WORDS, weights, k=rng.randrange(1, 120))
        rows.append((rng.choice(["en", "en", "en", "fr", None]),
                     "".join(w + rng.choice([" ", "  ", "\t", " ", ". ", ",", "\n", " new york city "]) for w in parts)))
    rows += [rows[-1]] * 20
    rows.append(("en", "ha " * 200_000))
    return rows


@pytest.mark.parametrize("settings", [{"top": 2000, "least": 10}, {"top": 5, "least": 2, "first_round": 1, "filter_bits": 16}])
def test_collocations(spark, spoken, settings):
    frame = spark.createDataFrame([(*r, "x", 1, 2) for r in spoken], "lang string, text string, w1 string, a long, score long").repartition(6)
    found = collocations.collocations(frame, **settings)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    slow = slow_phrases(spoken, settings["top"], settings["least"])
    assert sorted(tuple(r) for r in found.collect()) == slow and len(slow) >= 10


def test_rounds_go_on_until_the_last_place_is_settled(spark):
    """The best pairs are all dropped by longer phrases, so one round is not enough."""
    rows = [("en", f"left{i} mid{i} right{i}.") for i in range(40) for _ in range(10)]
    rows += [("en", f"left{i} of. mid{i} of. right{i} of. pair{i % 7} word{i % 5}.") for i in range(40) for _ in range(3 + i % 4)]
    frame = spark.createDataFrame(rows, "lang string, text string")
    for top in (1, 30, 45):
        found = collocations.collocations(frame, top=top, least=3, first_round=1)
        assert sorted(tuple(r) for r in found.collect()) == slow_phrases(rows, top, 3)


def test_collocations_of_no_rows(spark):
    assert collocations.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0


def test_scores_are_exact(spark):
    top = 10**15 - 1
    cases = [(top, top, top), (top - 1, top, top), (top // 3, top, top - 7), (10, 10, 11), (3, 10**15 - 1, 3)]
    frame = spark.createDataFrame(cases, "a long, l long, r long")
    found = frame.select("a", "l", "r", collocations.score(F.col("a"), F.col("l"), F.col("r"))).collect()
    assert all(s == 1_000_000 * a * a // (l * r) for a, l, r, s in found)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_each_phrase_lies_in_one_slice(n):
    rng = random.Random(n)
    texts = [b"one two. three", b"", b"a" * 50, b"four, five six", b"  ".join(b"w%d" % rng.randrange(30) for _ in range(300)), b" x ", b"long" * 30 + b" " + b"word" * 30]

    def phrases(data: bytes) -> Counter:
        return Counter(
            tuple(w[i : i + n]) for p in data.split(bytes([collocations.BREAK])) for w in [p.split(b" ")] for w in [[x for x in w if x]]
            for i in range(len(w) - n + 1))

    whole = sum((phrases(t.translate(collocations._TO_PLAIN)) for t in texts), Counter())
    for size in (1, 5, 12, 40, 1000):
        parts = list(collocations.slices(texts, size, n))
        assert sum(map(phrases, parts), Counter()) == whole
    for size in (5, 40, 10_000):
        tally = collocations.Tally(n, "en", *[type("All", (), {"has": lambda self, h: np.ones(len(h), bool)})()] * 2)
        assert all(tally.add(part) for part in collocations.slices(texts, size, n))
        rows = pa.Table.from_batches(tally.rows("en", collocations._words(n), 7)).to_pylist()
        found = {tuple(r[w].encode() for w in collocations._words(n)): r["a"] for r in rows if r["w1"] is not None}
        assert found == whole and (n > 1 or rows[-1]["a"] == whole.total())


# --------------------------------------------------------------------------- quality


def slow_places(text: str | None, bits: int) -> Counter:
    """One feature at a time, through the vectorised code on single words and pairs."""
    words = (text or "").encode().split()
    places = Counter()
    for word in words:
        places.update(quality.features([word.decode()], bits).places.tolist())
        assert len(quality.features([word.decode()], bits).places) == 1 + sum(
            max(0, len(word) + 2 - n + 1) for n in (3, 4, 5))
    for left, right in zip(words, words[1:]):
        places.update(quality.features([f"{left.decode()} {right.decode()}"], bits).pairs.tolist())
    return places


TEXTS = [None, "", " \t", "x", "Two Words", "the the the the", "é日本 ² a-b", "word " * 300 + "end", "ab" * 3000, "a\x1cb\x00 c"]


def test_features_of_texts():
    for made, text in zip(quality.of_each(quality.features(TEXTS, 12)), TEXTS):
        for places, counts in (made, quality.unpacked(quality.packed(*made))):
            assert dict(zip(places.tolist(), counts.tolist())) == slow_places(text, 12) and (np.diff(places) > 0).all()


def test_learner_equals_a_plain_loop():
    rng, bits, width, rate = random.Random(2), 6, 3, 0.3
    learner = quality.Learner(bits, width)
    vectors = learner.vectors.astype(float).tolist()
    layer, bias = [[0.0] * width for _ in range(2)], [0.0, 0.0]
    for _ in range(60):
        places = rng.sample(range(64), rng.randrange(1, 9))
        raw = [rng.random() for _ in places]
        shares, label = [r / sum(raw) for r in raw], rng.randrange(2)
        learner.update(np.array(places, np.int32), np.array(shares, np.float32), label, rate)
        hidden = [sum(s * vectors[p][j] for p, s in zip(places, shares)) for j in range(width)]
        logits = [sum(layer[c][j] * hidden[j] for j in range(width)) + bias[c] for c in range(2)]
        total = sum(math.exp(v) for v in logits)
        error = [math.exp(v) / total - (c == label) for c, v in enumerate(logits)]
        back = [sum(error[c] * layer[c][j] for c in range(2)) for j in range(width)]
        for c in range(2):
            layer[c] = [layer[c][j] - rate * error[c] * hidden[j] for j in range(width)]
            bias[c] -= rate * error[c]
        for p, s in zip(places, shares):
            vectors[p] = [vectors[p][j] - rate * len(places) * s * back[j] for j in range(width)]
    assert learner.vectors == pytest.approx(np.array(vectors), abs=1e-4)
    assert learner.layer == pytest.approx(np.array(layer), abs=1e-4)
    weights, lean = learner.weights()
    assert weights == pytest.approx(np.array(vectors) @ (np.array(layer[1]) - np.array(layer[0])), abs=1e-4)
    # Scores by distinct words of a slice equal the sum over the features of each text.
    for text, score in zip(TEXTS, quality.scores(TEXTS, (weights, lean), bits)):
        slow = slow_places(text, bits)
        mean = sum(weights[p] * n for p, n in slow.items()) / max(1, slow.total())
        assert score == pytest.approx(1 / (1 + math.exp(-(mean + lean))), abs=1e-5)


def test_quality_of_small_tables(spark):
    schema = "doc_id long, text string, places string, shares int, hash int, score double, good int"
    rows = [(i, f"fine words {i} about things" if i % 3 else "### $$$ %%% bad", "x", 1, 2, 0.5, 1) for i in range(200)]
    rows += [(500, None, "x", 1, 2, 0.5, 1), (501, "", "x", 1, 2, 0.5, 1), (None, "fine words", "x", 1, 2, 0.5, 1),
             (3, "another text of document three", "x", 1, 2, 0.5, 1), rows[7]]
    docs = spark.createDataFrame(rows, schema).repartition(4)
    labels = spark.createDataFrame(
        [(i, int(i % 3 > 0)) for i in range(200)] + [(1, 1), (None, 0), (7, None), (999, 0)], "doc_id long, quality int")
    model = quality.learn(docs, labels, passes=12, bits=12)
    again = quality.learn(docs.repartition(9), labels, passes=12, bits=12)
    assert (model[0] == again[0]).all() and model[1] == again[1]
    made = quality.score(docs, model, bits=12).collect()
    assert len(made) == len(rows)
    by_id = {r["doc_id"]: r for r in made}
    assert all(by_id[i]["predicted"] == (i % 3 > 0) for i in range(200) if i != 3) and by_id[None]["predicted"] == 1
    assert by_id[500]["score"] == by_id[501]["score"]
    nothing = quality.learn(docs, labels.where("false"), bits=12)
    assert {r["score"] for r in quality.score(docs, nothing, bits=12).collect()} == {0.5}
    assert quality.score(docs.where("false"), model, bits=12).count() == 0


def test_quality_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    truth = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{folder}/labels.parquet'").fetchall())
    rows = [(r["score"], truth[r["doc_id"]]) for r in QUERIES["op13_quality"](spark, folder).collect()
            if r["held_out"] and r["doc_id"] in truth]
    good, bad = np.array([s for s, t in rows if t]), np.array([s for s, t in rows if not t])
    assert (good[:, None] > bad).mean() > 0.99
    assert (good >= 0.7).mean() > 0.99 and (bad >= 0.7).mean() < 0.05


