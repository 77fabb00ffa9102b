"""From documents to packed training sequences: one function for each stage, each written and read again.

A stage takes (spark, docs, sf_dir) and returns the documents that go on, with the columns of documents; the last one
returns the packed pieces. Documents whose language cannot be told are dropped, of equal texts one stays, of each group
of near duplicates one stays (the smallest doc_id): first by SimHash within two bits over three-word shingles, then, of what
is left, by a Jaccard similarity of five-word shingles of at least 0.8. Sources are mixed to their target weights (a document goes on once
for each pass that takes it, in training order), and what is left is packed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.llm import edited, exact_dedup, language_id, mixing, packing, simhash
from tallylake.llm.queries import tokenizer_path
from tallylake.llm.staging import staged


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that belong to no language (those without a letter); others without a label get the predicted one
    as their `lang`. Learns from the labels of all documents; if there are none, `lang` stays as it is."""
    models = language_id.learn(docs)
    if not models:
        return docs.where(F.col("text").rlike("\\p{L}"))
    # The columns that the prediction adds have names of their own there.
    plain = docs.withColumnsRenamed({c: f"__{c}" for c in ("lang_pred", "score") if c in docs.columns})
    kept = language_id.predict(plain, models).where(F.col("lang_pred") != language_id.UNKNOWN)
    told = kept.withColumn("lang", F.coalesce("lang", "lang_pred")).drop("lang_pred", "score")
    return told.withColumnsRenamed({f"__{c}": c for c in ("lang_pred", "score")}).select(*docs.columns)


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicated(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash component (rows that repeat its doc_id are copies and stay together; a null
    doc_id is one of its own), then one text of each component of edited copies, most of which differ in more bits than
    SimHash links."""
    groups = simhash.near_duplicates(docs.where("doc_id is not null"))
    gone = groups.where("doc_id != component_id").select("doc_id").distinct()
    return edited.without_edited_copies(staged(docs.join(gone, "doc_id", "left_anti").select(*docs.columns), "near-copies"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("exact_dedup", copies),
    ("simhash_near_dedup", near_copies),
    ("mixing", mix),
    ("best_fit_packing", pack),
]

# Tokenising, cross-parsing and the search for near duplicates are not SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
