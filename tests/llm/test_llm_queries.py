"""The registered queries on the smallest test tables: SQL, held-out accuracy, recall, and the pipeline."""

from __future__ import annotations

from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tallylake.llm.oracles import ORACLES
from tallylake.llm.queries import QUERIES
from test_operators import components, slow_edited, slow_mix, slow_print

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("documents", "conversations", "embeddings", "labels"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    result = duck.sql(ORACLES[name])
    assert sorted(result.columns) == columns
    theirs = Counter(result.project(", ".join(f'"{c}"' for c in columns)).fetchall())
    assert Counter(tuple(r) for r in df.select(*columns).collect()) == theirs


def test_native_query_runs_no_python(spark):
    plan = QUERIES["op8_chat_formatting"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_language_of_held_out_documents(spark, duck):
    truth = dict(duck.sql("SELECT doc_id, lang FROM documents WHERE lang IS NOT NULL").fetchall())
    rows = [r for r in QUERIES["op1_language_id"](spark, SF).collect() if r["held_out"] and r["lang_pred"] != "und"]
    assert sum(truth[r["doc_id"]] == r["lang_pred"] for r in rows) >= 0.99 * len(rows) > 0


def test_toxicity_of_held_out_documents(spark, duck):
    folder = "/root/testdata/sf0.1"  # the smaller tables have only a few toxic rows to learn from
    truth = dict(duck.sql(f"SELECT doc_id, toxic FROM '{folder}/labels.parquet'").fetchall())
    rows = [(r["score"], truth[r["doc_id"]]) for r in QUERIES["op10_toxicity"](spark, folder).collect()
            if r["held_out"] and r["doc_id"] in truth]
    toxic, clean = np.array([s for s, t in rows if t]), np.array([s for s, t in rows if not t])
    assert ((toxic[:, None] > clean) + (toxic[:, None] == clean) / 2).mean() > 0.97
    assert (clean >= 0.3).mean() < 0.01 and (toxic >= 0.3).mean() > 0.7


def test_recall_of_neighbours(spark, duck):
    vectors = {i: np.array(v, float) for i, v in duck.sql("SELECT vec_id, embedding FROM embeddings").fetchall()}
    ids = np.array(sorted(vectors))
    table = np.stack([vectors[i] for i in ids])
    found = defaultdict(set)
    for r in QUERIES["op2_nearest_neighbours"](spark, SF).collect():
        found[r["query_id"]].add(r["vec_id"])
    recall = []
    for q in ids[ids % 20 == 0]:
        product = np.where(ids == q, -np.inf, table @ vectors[q])
        recall.append(len(found[q] & set(ids[np.argsort(-product, kind="stable")[:20]].tolist())) / 20)
    assert np.mean(recall) >= 0.95


def test_stages_of_the_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(-1, "1234 5678", None, None, None), (-2, None, "en", "src1", None), (-3, "", None, None, None)], docs.schema)
    before = docs.unionByName(extra)
    columns = before.columns
    held = {r["doc_id"]: r for r in before.collect()}

    def ids(frame):
        assert frame.columns == columns
        return [r["doc_id"] for r in frame.collect()]

    stages = dict(corpus_pipeline.STAGES)
    after = stages["language_id"](spark, before, SF)
    assert sorted(ids(after)) == sorted(d for d, r in held.items() if r["text"] and any(map(str.isalpha, r["text"])))
    unique = stages["exact_dedup"](spark, after, SF).cache()
    last = {}
    for r in after.collect():
        last[r["text"]] = max(r["doc_id"], last.get(r["text"], -9))
    assert sorted(ids(unique)) == sorted(last.values())
    near = stages["simhash_near_dedup"](spark, unique, SF).cache()
    prints = defaultdict(list)
    for r in unique.collect():
        prints[slow_print(r["text"])].append(r["doc_id"])
    first = set(components(prints).values())
    texts = [(r["doc_id"], r["text"]) for r in unique.collect() if r["doc_id"] in first]
    assert sorted(ids(near)) == sorted(d for d, _ in slow_edited(texts))
    mixed = stages["mixing"](spark, near, SF).cache()
    goals = slow_mix([(r["doc_id"], r["text"], r["source"]) for r in near.collect()])
    words = defaultdict(int)
    for r in mixed.collect():
        words[r["source"]] += len(r["text"].split())
    assert max(Counter(ids(mixed)).values()) <= 3
    for source, (size, target) in goals.items():
        assert words[source] == pytest.approx(target, rel=0.1)
    packed = stages["best_fit_packing"](spark, mixed, SF).collect()
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == Counter(ids(mixed))


def test_no_edited_copies_reach_the_mix(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    left = docs
    for name in list(stages)[: list(stages).index("mixing")]:
        left = stages[name](spark, left, SF).cache()
    rows = [(r["doc_id"], r["text"]) for r in left.collect()]
    assert slow_edited(rows) == set(rows) and len(rows) > 800


def test_language_stage_without_labels_and_with_clashing_names(spark):
    language = dict(corpus_pipeline.STAGES)["language_id"]
    schema = "doc_id long, text string, lang string, score int, lang_pred string"
    rows = [(1, "The cat and the dog", None, 7, "mine"), (2, "12 34", None, 8, None), (None, "Le chat", None, 9, "x"), (4, None, None, 1, "y")]
    docs = spark.createDataFrame(rows, schema)
    assert sorted(tuple(r) for r in language(spark, docs, SF).collect() if r[0]) == [rows[0]]
    assert language(spark, docs, SF).count() == 2
    labelled = docs.unionByName(spark.createDataFrame([(5, "The dog and the cat ran", "en", 1, "z")], schema))
    found = language(spark, labelled, SF)
    assert found.columns == docs.columns
    assert sorted((r["text"], r["lang"], r["score"], r["lang_pred"]) for r in found.collect()) == [
        ("Le chat", "en", 9, "x"), ("The cat and the dog", "en", 7, "mine"), ("The dog and the cat ran", "en", 1, "z")]


def test_whole_pipeline(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and corpus_pipeline.ORACLE_SQL is None
    places = {(r["sequence_id"], r["offset"]) for r in rows}
    assert len(places) == len(rows)
