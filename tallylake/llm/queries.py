"""The queries of this subpackage: one for each operator, over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.llm import (
    chat, collocations, exact_dedup, language_id, mixing, neighbours, packing, prefix_trie, quality, simhash, suffix_dedup,
    token_counts, toxicity,
)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    held_out = language_id.held_out(3, 1)
    models = language_id.learn(docs.where(~held_out))
    found = language_id.predict(docs.select("doc_id", "text"), models)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeated(_read(spark, sf_dir, "documents")).drop("kept")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.sorted_by_position(mixing.plan(_read(spark, sf_dir, "documents")))
    return planned.select("doc_id", "size", "source_size", "target", "taken")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(_read(spark, sf_dir, "documents"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = f"{chat.END}{chat.BEGIN}assistant ok"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    messages = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    made = chat.read_back(chat.conversations(chat.threads(messages)))
    turns = F.array_join(F.transform("said", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return made.select(
        F.col("tree_id").alias("conv_id"), F.size("said").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_read(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    held_out = language_id.held_out(4, 2)
    model = toxicity.learn(docs, _read(spark, sf_dir, "labels").where(~held_out))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.numbered(_read(spark, sf_dir, "conversations"))
    return prefix_trie.trie(*prefix_trie.spliced(turns))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_read(spark, sf_dir, "documents"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    held_out = language_id.held_out(4, 2)
    model = quality.learn(docs, _read(spark, sf_dir, "labels").where(~held_out))
    return quality.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        op1_language_id, op2_nearest_neighbours, op3_simhash_near_dedup, op4_suffix_array_dedup, op5_best_fit_packing,
        op6_mixing, op7_exact_dedup, op8_chat_formatting, op9_token_counts, op10_toxicity,
        op11_conversation_trie, op12_collocations, op13_quality, pipeline,
    )
}
