"""The operators against brute force on small rows: nulls, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
import xxhash
from tokenizers import Tokenizer

from tallylake.llm import (
    chat, edited, exact_dedup, graph, language_id, mixing, neighbours, packing, simhash, suffix_dedup, token_counts, toxicity,
)
from tallylake.llm.queries import tokenizer_path

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, part int, before long, print long,"
          " copies long, score double")
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def texts_of(rng: random.Random) -> list[str | None]:
    passage = " ".join(rng.choice(WORDS) for _ in range(60))
    base = " ".join(rng.choice(WORDS) for _ in range(300))
    near = base.replace(" ", "  ", 1)
    line = "All Rights Reserved, see the license for the terms of use of this and other files. " * 3
    texts: list[str | None] = [None, "", " \t\n", "x", "Two Words", "é日本 ²", base, base, near, base + " end", "\x00\x1f a\x1cb"]
    texts += [f"{' '.join(rng.choice(WORDS) for _ in range(rng.randrange(5, 80)))} {passage} {i}" for i in range(12)]
    texts += [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 200))) for _ in range(20)]
    texts += ["ab" * 400, "a" * 900, line * 3, line + "tail", "word " * 30000, "<|endoftext|> <|im_end|> </s>"]
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(7)
    rows = [(i, t, rng.choice(["en", "fr", None]), rng.choice(["a", "b", "c", "d", "é", None]), None, 1, 2, 3, 4, 0.5)
            for i, t in enumerate(texts_of(rng))]
    rows.append(rows[6])  # one row twice
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def held(docs) -> list[tuple[int, str]]:
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def test_repeated_byte_strings(docs, empty):
    rows = [(d, (t or "").encode()) for d, t in held(docs)]
    length = 200
    seen = Counter(t[i : i + length] for _, t in rows for i in range(len(t) - length + 1))
    expected = []
    for doc, text in rows:
        mask = np.zeros(len(text), bool)
        for i in range(len(text) - length + 1):
            if seen[text[i : i + length]] > 1:
                mask[i : i + length] = True
        kept = bytes(np.frombuffer(text, np.uint8)[~mask])
        runs = int((np.diff(np.concatenate(([0], mask.astype(int)))) == 1).sum())
        expected.append((doc, len(text), int(mask.sum()), runs, hashlib.sha256(kept).hexdigest()))
    for settings in ({}, {"most": 2}, {"batch_bytes": 1, "shards": 2, "symbol": 8}):
        found = suffix_dedup.remove_repeated(docs, **settings)
        assert Counter(tuple(r)[:5] for r in found.collect()) == Counter(expected)
        assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in found.collect())
    assert suffix_dedup.remove_repeated(empty).count() == 0


def slow_removed(text: bytes, seen: Counter) -> bytes:
    mask = np.zeros(len(text), bool)
    for i in range(len(text) - 199):
        if seen[text[i : i + 200]] > 1:
            mask[i : i + 200] = True
    return bytes(np.frombuffer(text, np.uint8)[~mask])


def test_repeated_byte_strings_of_null_ids_and_crowded_passages(spark):
    rng = random.Random(12)
    letters = "abcdefghij "
    passage = "".join(rng.choice(letters) for _ in range(330))

    def noise(n: int) -> str:
        return "".join(rng.choice(letters) for _ in range(n))

    rows = [(i, noise(rng.randrange(90)) + passage[rng.randrange(40) : 330 - rng.randrange(40)] + noise(rng.randrange(90))) for i in range(60)]
    alike = noise(465)
    rows += [(None, alike), (1000, alike), (None, alike[:300] + noise(50)), (None, None), (1001, None)]
    seen = Counter(t.encode()[i : i + 200] for _, t in rows if t for i in range(len(t) - 199))
    expected = Counter((d, slow_removed((t or "").encode(), seen)) for d, t in rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for most in (4096, 16, 1):
        found = suffix_dedup.remove_repeated(frame, most=most).select("doc_id", "kept").collect()
        assert Counter((r["doc_id"], bytes(r["kept"])) for r in found) == expected
    assert (None, b"") in expected and (1000, b"") in expected


def test_parts_of_crowded_stretches():
    """Each string lies in one part, equal strings have one route, and the last parts are single strings."""
    rng = random.Random(13)
    middle = bytes(rng.choice(b"abcdef") for _ in range(300))
    texts = [bytes(rng.choice(b"abcdef") for _ in range(rng.randrange(250))) + middle + bytes([i]) * 200 for i in range(9)]
    widths = suffix_dedup._widths(169)
    assert widths[-1] == 1 and all(a > b for a, b in zip(widths, widths[1:]))
    for width in widths:
        routes = {}
        for text in texts:
            for _, anchor, start, n in suffix_dedup.winnow([text], 200, 32):
                for a, s, k in zip(anchor.tolist(), start.tolist(), n.tolist()):
                    data, strings = text[s : s + k + 199], []
                    for route, shift, part in suffix_dedup.cut_by_place(data, a, width, 200, 32):
                        assert data[shift : shift + len(part)] == part and len(part) < 200 + width
                        strings += [shift + i for i in range(len(part) - 199)]
                        for i in range(len(part) - 199):
                            assert routes.setdefault(part[i : i + 200], route) == route
                    assert sorted(strings) == list(range(k))


def test_winnowing_of_long_texts_in_slices(monkeypatch):
    rng = random.Random(14)
    texts = [bytes(rng.choice(b"abc ") for _ in range(n)) for n in (5000, 150, 1200, 1199, 201)]
    whole = [[p.tolist() for p in part] for part in suffix_dedup.winnow(texts, 200, 32)]
    monkeypatch.setattr(suffix_dedup, "CHUNK", 1000)
    sliced = [[p.tolist() for p in part] for part in suffix_dedup.winnow(texts, 200, 32)]
    flat = [sorted(zip(*(sum((p[i] for p in made), []) for i in range(4)))) for made in (whole, sliced)]
    assert flat[0] == flat[1]


def test_merge_of_transforms_by_rounds():
    rng = random.Random(3)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 90))) for _ in range(40)]
    seen = Counter(t[i : i + 12] for t in texts for i in range(len(t) - 11))
    for symbol in (1, 3, 12):
        for shards in (1, 3, 50):
            found = suffix_dedup.repeated_starts(texts, 12, symbol, shards)
            assert [f.tolist() for f in found] == [[i for i in range(len(t) - 11) if seen[t[i : i + 12]] > 1] for t in texts]


def test_winnowing_does_not_depend_on_the_batch():
    rng = random.Random(4)
    texts = [bytes(rng.choice(b"abc ") for _ in range(rng.randrange(0, 900))) for _ in range(30)]
    whole = [tuple(x.tolist() for x in part) for part in suffix_dedup.winnow(texts, 200, 32)]
    flat = sorted(zip(*(sum((p[i] for p in whole), []) for i in range(4))))
    single = []
    for i, t in enumerate(texts):
        for owner, anchor, start, n in suffix_dedup.winnow([t], 200, 32):
            single += zip([i] * len(owner), anchor.tolist(), start.tolist(), n.tolist())
    assert flat == sorted(single)
    assert Counter(i for i, _, _, n in flat for _ in range(n)) == Counter(
        {i: len(t) - 199 for i, t in enumerate(texts) if len(t) >= 200})


def slow_print(text: str | None) -> int:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints: dict[int, list[int]]) -> dict[int, int]:
    """Brute force: fingerprint -> smallest doc_id it can reach."""
    left, result = set(prints), {}
    while left:
        ahead = members = {left.pop()}
        while ahead:
            ahead = {p for p in left if any((p ^ q).bit_count() <= 2 for q in ahead)}
            left -= ahead
            members = members | ahead
        smallest = min(d for p in members for d in prints[p])
        result.update((p, smallest) for p in members)
    return result


def test_simhash_components(docs, empty):
    prints = defaultdict(list)
    for doc, text in held(docs):
        prints[slow_print(text)].append(doc)
    smallest = components(prints)
    expected = Counter((d, f"{p:016x}", smallest[p]) for p, ids in prints.items() for d in ids)
    assert Counter(tuple(r) for r in simhash.near_duplicates(docs).collect()) == expected
    assert simhash.near_duplicates(empty).count() == 0


def slow_edited(rows: list[tuple]) -> set:
    """Brute force: (doc_id, text) of the rows that stay when texts of five-word similarity >= 0.8 link."""
    sets = {}
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
        sets[text or ""] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    left, stays = set(sets), set()
    while left:
        ahead = members = {left.pop()}
        while ahead:
            ahead = {t for t in left if sets[t] and any(5 * len(sets[t] & sets[u]) >= 4 * len(sets[t] | sets[u]) for u in ahead)}
            left -= ahead
            members = members | ahead
        best = min((d is None, d or 0, t) for d, t in rows if (t or "") in members for t in [t or ""])
        stays.add(best[2])
    return {(d, t) for d, t in rows if (t or "") in stays}


def test_edited_copies(spark, docs, empty):
    rng = random.Random(11)
    many = [f"w{i}" for i in range(3000)]
    rows = []
    for length in (3, 5, 20, 150, 300, 600, 1500):
        base = [rng.choice(many) for _ in range(length)]
        for share in (0, 1 / 60, 1 / 60, 1 / 60, 1 / 45, 1 / 30, 1 / 10):
            rows.append((len(rows), " ".join(rng.choice(many) if rng.random() < share else w for w in base)))
        rows.append((len(rows), " ".join(base[: -1 - length // 12]).upper()))
        rows.append((None, " ".join([*base, "more"])))
    chain = [rng.choice(many) for _ in range(200)]
    rows += [(len(rows) + i, " ".join(chain[10 * i : 10 * i + 120])) for i in range(9)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    expected = slow_edited(rows)
    assert {tuple(r) for r in edited.without_edited_copies(frame).collect()} == expected
    assert len(expected) < len(rows) * 2 / 3
    rows = held(docs)
    kept = edited.without_edited_copies(docs)
    assert kept.columns == docs.columns and Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(
        r for r in rows if r in slow_edited(rows))
    assert edited.without_edited_copies(empty).count() == 0


@pytest.mark.parametrize("crowd", [8, 0])
def test_different_texts_around_one_passage(spark, monkeypatch, crowd):
    """They share bands, but only those that can be similar are compared."""
    monkeypatch.setattr(edited, "CROWD", crowd)
    rng = random.Random(3)
    many = [f"w{i}" for i in range(3000)]
    passage = [rng.choice(many) for _ in range(240)]
    texts = [" ".join([*(rng.choice(many) for _ in range(50)), *passage, *(rng.choice(many) for _ in range(50))]) for _ in range(60)]
    texts += [f"{t} more" for t in texts[:6]] + [" ".join(t.split()[:-30]) for t in texts[3:9]]
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {tuple(r) for r in edited.without_edited_copies(frame).collect()} == slow_edited(rows)
    sets = [(i, i, bytearray(edited.shingles(t).tobytes())) for i, t in rows]
    pairs = {tuple(r) for r in edited._rare_pairs(spark.createDataFrame(sets, "node long, root long, shingles binary")).collect()}
    alike = {(a, b) for a, x in rows for b, y in rows if a < b and edited.similar(edited.shingles(x), edited.shingles(y))}
    assert alike and alike <= pairs and len(pairs) < 2 * len(rows)


@pytest.mark.parametrize("texts", [1024, 7])
def test_pairs_of_many_edits_of_one_text(spark, monkeypatch, texts):
    """Most are not similar to each other: their pairs are told in blocks, and no join makes them."""
    monkeypatch.setattr(edited, "BLOCK_TEXTS", texts)
    rng = random.Random(5)
    many = [f"w{i}" for i in range(3000)]
    base = [rng.choice(many) for _ in range(150)]
    rows = [(i, " ".join(rng.choice(many) if rng.random() < 0.03 else w for w in base)) for i in range(120)]
    sets = [(i, i // 2 * 2, bytearray(edited.shingles(t).tobytes())) for i, t in rows]
    frame = spark.createDataFrame(sets, "node long, root long, shingles binary")
    shared = edited._rare_shared(frame)
    pairs = [tuple(r) for r in edited._rare_pairs(frame, shared).collect()]
    assert len(pairs) < edited.FEW * len(rows)
    held = [edited.shingles(t) for _, t in rows]
    alike = {(a, b) for a in range(len(rows)) for b in range(a) if edited.similar(held[a], held[b])}
    linked = {tuple(r) for r in edited._dense_links(frame, shared).collect()}
    assert linked and {(max(p), min(p)) for p in linked} <= alike
    ties = [(i // 2 * 2, i) for i, _ in rows]

    def connected(pairs):
        root = list(range(len(rows)))
        for _ in rows:
            for a, b in pairs:
                root[a] = root[b] = min(root[a], root[b])
        return root

    assert connected([*ties, *linked, *[p for p in pairs if (max(p), min(p)) in alike]]) == connected([*ties, *alike])
    assert len(set(connected(ties))) > len(set(connected([*ties, *alike])))


def test_rarest_shingles_of_similar_sets_meet():
    rng = np.random.default_rng(5)
    counts = rng.integers(0, 4, edited.BUCKETS)
    for n in (1, 2, 3, 4, 5, 9, 10, 40, 333):
        whole = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        for gone in range(n):
            part = np.sort(rng.permutation(whole)[gone:])
            if edited.similar(whole, part):
                assert np.intersect1d(edited.rarest(whole, counts), edited.rarest(part, counts)).size


@pytest.mark.parametrize("most", [4096, 3])
def test_links_of_crowded_fingerprints(spark, most):
    rng = random.Random(5)
    prints = set()
    for _ in range(4):
        center = rng.getrandbits(64)
        chain = center
        for _ in range(60):
            prints.add(center ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
            chain ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            prints.add(chain)
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    frame = spark.createDataFrame([(v,) for v in signed.values()], "print long")
    links = simhash.links(frame, most)
    roots = {r["node"]: r["root"] for r in graph.smallest_reachable(links).collect()}
    brute = components({p: [signed[p]] for p in prints})
    assert {v: roots.get(v, v) for v in signed.values()} == {signed[p]: r for p, r in brute.items()}


def test_golay_keys_meet_up_to_two_errors():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 3000)
    other = words ^ (1 << rng.integers(0, 23, 3000)) ^ (1 << rng.integers(0, 23, 3000))
    for a, b in zip(simhash.codewords(words), simhash.codewords(other)):
        assert set(a[a >= 0]) & set(b[b >= 0])


def test_exact_copies(docs, empty):
    groups = defaultdict(list)
    for doc, text in held(docs):
        groups[text or ""].append(doc)
    expected = Counter((d, max(ids), len(ids), d == max(ids), hashlib.sha256(t.encode()).hexdigest())
                       for t, ids in groups.items() for d in ids)
    assert Counter(tuple(r) for r in exact_dedup.groups(docs).collect()) == expected
    kept = exact_dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(max(ids) for ids in groups.values())
    assert exact_dedup.groups(empty).count() == 0 and exact_dedup.deduplicated(empty).count() == 0


def test_quotient_filters_merge_without_loss(spark):
    rng = np.random.default_rng(2)
    values = rng.integers(0, 1 << 63, 500, dtype=np.uint64) << np.uint64(1)
    drawn = rng.choice(values, 3000)
    parts = [exact_dedup.QuotientFilter.of(p) for p in np.array_split(drawn, 7)]
    merged = exact_dedup.QuotientFilter.merged(parts)
    counted = dict(zip(*(x.tolist() for x in np.unique(drawn, return_counts=True))))
    assert dict(zip(merged.prints().tolist(), merged.counters.tolist())) == counted
    for part, block in merged.blocks(16, 5):
        again = exact_dedup.QuotientFilter.from_record(block.record())
        assert again.prints().tolist() == block.prints().tolist() and again.counters.tolist() == block.counters.tolist()
    frame = spark.createDataFrame([(int(v),) for v in drawn.view(np.int64)], "print long").repartition(6)
    for settings in ({}, {"most_pending": 50, "slots": 3}):
        found = {r["print"]: r["n"] for r in exact_dedup.repeated_prints(frame, **settings).collect()}
        signed = {int(np.uint64(v).view(np.int64)): n for v, n in counted.items() if n > 1}
        assert found == signed


def test_packing(docs, empty):
    path = tokenizer_path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    made = packing.packed(docs, path).collect()
    pieces = defaultdict(list)
    for r in made:
        pieces[r["doc_id"]].append(r)
    twice = Counter(d for d, _ in held(docs))
    for doc, text in held(docs):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        own = {(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in pieces[doc]}
        bounds = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        assert own == {(i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for i, (a, b) in enumerate(zip(bounds, bounds[1:]))}
        assert len(pieces[doc]) == len(own) * twice[doc]
    sequences = defaultdict(list)
    for r in made:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r["length"] for r in made)
    assert len(sequences) <= -(-total // 1024) * 1.15 + 1
    assert packing.packed(empty, path).count() == 0


def test_plan_is_close_to_the_bound_and_uses_each_piece_once():
    rng = np.random.default_rng(3)
    histogram = np.bincount(np.clip(rng.lognormal(5.5, 1, 50_000).astype(int), 1, 1024), minlength=1025)
    plan = packing.plan_sequences(histogram, 1024)
    assert (np.bincount(plan.length, weights=plan.count, minlength=1025) == histogram).all()
    sequences = (plan.sequence + plan.count).max()
    assert sequences <= 1.005 * (np.arange(1025) * histogram).sum() / 1024 + 1
    for histogram in (np.zeros(1025, int), np.eye(1025, dtype=int)[700] * 9, np.eye(1025, dtype=int)[1] * 2049):
        plan = packing.plan_sequences(histogram, 1024)
        assert plan.count.sum() == histogram.sum()


def test_encoder_equals_the_library():
    path = tokenizer_path("byte_bpe_50k.json")
    tokenizer, encoder = Tokenizer.from_file(path), packing.Encoder(path, entries=300)
    rng = random.Random(5)
    parts = ["a", "Th", "'s", " ", "  ", "\n", "\t", "é", "日", "<|endoftext|>", "1", "!!", " ", "\r\n", "²", "\x85", "\x1c"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(4000)]
    expected = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [b for i in range(0, 4000, 100) for b in encoder.encode(texts[i : i + 100])] == expected


def slow_mix(rows: list[tuple]) -> dict:
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t, _ in rows}
    totals = defaultdict(int)
    for d, _, s in rows:
        totals[s] += size[d]
    order = sorted(totals, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, rest = {}, set(order), float(sum(totals.values()))
    while True:
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] > 3 * totals[s]}
        target.update(share)
        if not over:
            return {s: (totals[s], target[s]) for s in order}
        for s in over:
            target[s] = 3.0 * totals[s]
            rest -= target[s]
        free -= over


def test_mixing(docs, empty):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    goals = slow_mix(rows)
    made = mixing.plan(docs).collect()
    assert Counter(r["doc_id"] for r in made) == Counter(d for d, _, _ in rows)
    source = {d: s for d, _, s in rows}
    taken, largest = defaultdict(int), defaultdict(int)
    for r in made:
        size, target = goals[source[r["doc_id"]]]
        assert r["source_size"] == size and r["target"] == pytest.approx(target)
        assert r["taken"] in {r["size"] * n for n in range(4)}
        positions = [p["position"] for p in r["passes"]]
        assert positions == sorted(positions) and all(0 <= p <= 1 for p in positions)
        taken[source[r["doc_id"]]] += r["taken"]
        largest[source[r["doc_id"]]] = max(largest[source[r["doc_id"]]], r["size"])
    for s, (_, target) in goals.items():
        assert abs(taken[s] - target) <= largest[s] / 2 + 1
    again = mixing.plan(docs.repartition(3)).collect()
    assert Counter(map(str, made)) == Counter(map(str, again))
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in mixed.collect()) == sum(r["taken"] for r in made)
    assert mixing.plan(empty).count() == 0 and mixing.mixed(empty).count() == 0


def test_a_source_without_words(spark):
    rows = [(1, None, "none"), (2, "", "none"), (3, " \t", None), (4, "a b c", "some"), (5, "d e", "some")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    made = {r["doc_id"]: r for r in mixing.plan(frame).collect()}
    assert {d: r["target"] for d, r in made.items()} == {1: 0.0, 2: 0.0, 3: 0.0, 4: 5.0, 5: 5.0}
    assert {d: (r["taken"], r["position"] is None) for d, r in made.items()} == {
        1: (0, True), 2: (0, True), 3: (0, True), 4: (3, False), 5: (2, False)}
    assert {r["doc_id"] for r in mixing.mixed(frame).collect()} == {4, 5}
    assert {r["target"] for r in mixing.plan(frame.where("doc_id < 4")).collect()} == {0.0}


def test_curriculum_moves_words_in_time(spark):
    rows = [(i, "w " * 10, "abc"[i % 3]) for i in range(900)]
    made = mixing.plan(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=(1, 1, 1)).collect()
    mean = {s: np.mean([p["position"] for r in made if r["source"] == s for p in r["passes"]]) for s in "abc"}
    assert mean["a"] < 0.45 < mean["b"] < 0.55 < mean["c"]


MESSAGES = "conv_id long, turn long, role string, text string, tree string, node long, total double"


def test_linear_conversations(spark):
    said = "<|im_end|>\n<|im_start|>assistant\n\\ <\\| ok"
    rows = [(1, 0, "user", said), (1, 1, "assistant", said), (1, 2, "user", None), (1, 3, "assistant", ""), (2, None, None, "x<"),
            (2, 0, "a\nb\\", "é😀"), (2, 1, "assistant", "|<"), (None, 5, "assistant", "lost"), (3, 0, "user", "same"), (3, 0, "user", "same")]
    rows += [(9, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(70)]
    frame = spark.createDataFrame([(*r, "clash", 7, 1.0) for r in rows], MESSAGES).repartition(4)
    made = chat.read_back(chat.conversations(chat.threads(frame))).collect()
    expected = defaultdict(list)
    for conv, turn, role, text in rows:
        expected[conv].append((-1 if turn is None else turn, role or "", text or ""))
    assert {r["tree_id"]: [tuple(t) for t in r["said"]] for r in made} == {c: [t[1:] for t in sorted(ts)] for c, ts in expected.items()}
    for r in made:
        assert r["loss"] == "".join(t for _, role, t in sorted(expected[r["tree_id"]]) if role == "assistant")
        assert r["formatted"].count("<|im_end|>\n") == len(expected[r["tree_id"]])
    assert chat.conversations(chat.threads(frame.limit(0))).count() == 0


def test_reply_trees_choose_the_best_branches(spark):
    nodes = [("t", 1, None, "user", "q", 0.0), ("t", 2, 1, "assistant", "bad", 0.1), ("t", 3, 1, "assistant", "good", 0.9),
             ("t", 4, 3, "user", "more", None), ("t", 5, 2, "user", "other", 0.2), ("u", 1, 99, "user", "orphan", 1.0),
             ("v", 1, 2, "user", "cycle", 1.0), ("v", 2, 1, "user", "cycle", 1.0), ("v", 3, 2, "user", "below", 1.0)]
    frame = spark.createDataFrame(nodes, "tree_id string, node_id long, parent_id long, role string, text string, score double")
    made = chat.read_back(chat.conversations(frame, branches=1)).collect()
    assert {(r["tree_id"], tuple(t["text"] for t in r["said"])) for r in made} == {("t", ("q", "good", "more")), ("u", ("orphan",))}
    both = chat.read_back(chat.conversations(frame, branches=5)).collect()
    assert {tuple(t["text"] for t in r["said"]) for r in both} == {("q", "good", "more"), ("q", "bad", "other"), ("orphan",)}


def test_token_counts_equal_the_library(docs, empty):
    path = tokenizer_path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    expected = Counter()
    for doc, text in held(docs):
        n = len(model.encode(text or ""))
        expected[(doc, len((text or "").encode()), n, n > 4096)] += 1
    assert Counter(tuple(r) for r in token_counts.token_counts(docs, path).collect()) == expected
    assert token_counts.token_counts(empty, path).count() == 0
    merger = token_counts.PairMerger(path, entries=50)
    rng = random.Random(6)
    parts = ["a", "e", "th", " ", "  ", "\n", "\t", "▁", "é", "日", "</s>", "<0x0A>", "\x00", "😀", "aaaa", "　", "ing"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(30)))
        assert merger.count(text) == len(model.encode(text)), repr(text)


@pytest.mark.parametrize("shard_rows,leaf_rows,query_rows", [(4096, 128, 4096), (40, 8, 5)])
def test_neighbours(spark, shard_rows, leaf_rows, query_rows):
    rng = np.random.default_rng(8)
    vectors = [rng.normal(size=6) * rng.uniform(0.1, 3) for _ in range(150)]
    vectors += [vectors[0]] * 40 + [np.zeros(6), np.array([1.0, np.nan, 0, 0, 0, 0]), np.array([np.inf] * 6), np.ones(3), np.ones(3)]
    rows = [(i, [float(np.float32(x)) for x in v], "x", 1.0) for i, v in enumerate(vectors)]
    rows += [(900, None, "x", 1.0), (901, [], "x", 1.0), (902, [1.0, None, 1.0, 1.0, 1.0, 1.0], "x", 1.0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, shard string, score double")
    fit = {i: np.array(v) for i, v, *_ in rows if v and None not in v and np.isfinite(v).all() and np.any(v)}
    found = neighbours.nearest(frame, frame.where("vec_id % 20 = 0"), relax=1.0, shard_rows=shard_rows, leaf_rows=leaf_rows,
                               query_rows=query_rows, probe_rows=64).collect()
    expected = {}
    for q in fit:
        if q % 20 == 0:
            ranked = sorted((-float(np.einsum("i,i->", fit[q], v)), i) for i, v in fit.items() if i != q and len(v) == len(fit[q]))
            expected.update({(q, n + 1): (i, -s) for n, (s, i) in enumerate(ranked[:20])})
    assert {(r["query_id"], r["rank"]) for r in found} == set(expected)
    for r in found:
        i, score = expected[r["query_id"], r["rank"]]
        assert r["vec_id"] == i and r["score"] == pytest.approx(score, rel=1e-12, abs=1e-12)
    assert neighbours.nearest(frame.limit(0), frame).count() == 0
    assert neighbours.nearest(frame, frame.limit(0)).count() == 0


def slow_phrases(text: bytes, sample: bytes) -> int:
    at = count = 0
    while at < len(text):
        n = 1
        while at + n < len(text) and text[at : at + n + 1] in sample:
            n += 1
        at, count = at + n, count + 1
    return count


def test_cross_parsing_counts_longest_matches(spark, empty):
    samples = {"en": b"the cat sat on the mat and the dog", "fr": b"le chat est sur le tapis et le chien \xc3\xa9"}
    rows = [(k, len(v), __import__("pickle").dumps(language_id.automaton(v))) for k, v in samples.items()]
    parser = language_id.Parser(rows, block=16)
    texts = [b"the dog and the cat", b"le chien", b"", b"qqq the", "é".encode(), b"x"]
    for got, name in zip(parser.phrases(texts), parser.languages):
        expected = [sum(slow_phrases(t[i : i + 16], samples[name]) for i in range(0, len(t), 16)) for t in texts]
        assert got.tolist() == expected
    assert parser.predict([None, "", "123 !", "le chat"])[0] == ["und", "und", "und", "fr"]
    assert language_id.learn(empty) == []
    assert language_id.predict(empty, []).count() == 0


def test_language_of_rows(docs):
    models = language_id.learn(docs)
    assert {m[0] for m in models} == {"en", "fr"}
    made = language_id.predict(docs, models)
    rows = made.collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    for r in rows:
        spoken = r["text"] is not None and any(map(str.isalpha, r["text"]))
        assert (r["lang_pred"] == "und") == (not spoken)


def test_toxicity_learns_and_scores(spark, docs, empty):
    rng = random.Random(9)
    rows = [(i, " ".join([rng.choice(WORDS) for _ in range(30)] + ["vile"] * (i % 4 == 0)), None) for i in range(400)]
    rows += [(1000, None, None), (1001, "", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, place string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)] + [(5, 0), (None, 1), (7, None), (9999, 1)], "doc_id long, toxic int")
    model = toxicity.learn(frame, labels)
    assert 0 < len(model[0]) < 2000
    scores = {r["doc_id"]: r for r in toxicity.score(frame, model).collect()}
    assert len(scores) == len(rows)
    assert all(scores[i]["predicted"] == int(i % 4 == 0) for i in range(300, 400))
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in scores.values())
    nothing = toxicity.learn(frame, labels.limit(0))
    assert {r["score"] for r in toxicity.score(frame, nothing).collect()} == {0.5}
    assert toxicity.score(empty, model).count() == 0
