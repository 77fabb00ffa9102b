"""Deduplication on transaction_id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallylake.config import Config, DEFAULT
from tallylake.operators.skew import salt_of


def _arrival_order(df: DataFrame) -> list[Column]:
    """Earliest event first, then stream position; without lineage, a hash of the row, so ties are equal rows."""
    lineage = [F.col(c) for c in ("partition", "offset") if c in df.columns]
    rest = lineage or [F.xxhash64(*[c for c in df.columns if c not in ("transaction_id", "event_ts")])]
    return [F.col("event_ts"), *rest]


def dedup(df: DataFrame) -> DataFrame:
    """The first row of each transaction id.

    `row_number() = 1` lets Spark keep one row per id and map task before the shuffle, so an id with very
    many copies stays small on the reduce side.
    """
    first = Window.partitionBy("transaction_id").orderBy(*_arrival_order(df))
    return df.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") == 1).drop("_n")


def duplicates(df: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """All rows but the first of each transaction id.

    Ranked in two steps, so that the copies of one id are spread over `cfg.salts` tasks: whatever is not first
    inside its salt is a duplicate; the few salt winners are then ranked against each other. Both ranks are in one
    plan, and the salt is a hash of the row, so a task that runs again ranks alike.
    """
    order = _arrival_order(df)
    salted = df.withColumn("_salt", salt_of(F.struct(*df.columns), cfg))
    in_salt = Window.partitionBy("transaction_id", "_salt").orderBy(*order)
    ranked = salted.withColumn("_n", F.row_number().over(in_salt))
    among = Window.partitionBy("transaction_id", F.when(F.col("_n") > 1, F.col("_salt")).otherwise(-1)).orderBy(*order)
    return ranked.withColumn("_m", F.row_number().over(among)).filter("_n > 1 or _m > 1").drop("_n", "_m", "_salt")
