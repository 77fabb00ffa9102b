"""Data-quality checks over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.config import Config, DEFAULT
from tallylake.functions.columns import count_if


class QualityGateFailed(Exception):
    """A load left rows that break an invariant of the star schema."""


def _orphans(fact: DataFrame, dim: DataFrame, key: str, name: str) -> DataFrame:
    # Facts are counted per key first, so the join sees one row per key and no key can be hot.
    per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.join(dim.select(key), key, "left_anti").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias(name)
    )


def orphan_accounts(fact: DataFrame, dim_account: DataFrame) -> DataFrame:
    return _orphans(fact, dim_account, "account_key", "orphaned_account_fk")


def orphan_dates(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return _orphans(fact, dim_date, "date_key", "orphaned_date_fk")


def duplicate_ids(fact: DataFrame) -> DataFrame:
    return fact.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") > 1)


def invalid_amounts(fact: DataFrame) -> DataFrame:
    return fact.agg(count_if(F.col("amount") <= 0).alias("invalid_amounts"))


def flag_consistency(fact: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    wrong = (F.col("is_anomaly") == 1) != (F.col("anomaly_score") >= cfg.anomaly_score)
    return fact.agg(count_if(wrong).alias("inconsistent_anomaly_flags"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        table.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, table in tables.items()
    ]
    first, *rest = counts
    for other in rest:
        first = first.unionByName(other)
    return first


def freshness(fact: DataFrame) -> DataFrame:
    return fact.agg(F.max("event_timestamp").alias("latest_event_timestamp"))


def daily_reconcile(daily: DataFrame, fact: DataFrame) -> DataFrame:
    """Days whose metric total differs from the facts, including days that only one side has."""
    metric = daily.select("date_key", F.col("total_transactions").alias("metric_total"))
    actual = fact.groupBy("date_key").agg(F.count(F.lit(1)).alias("fact_total"))
    return (
        metric.join(actual, "date_key", "full")
        .select(
            "date_key",
            F.coalesce("metric_total", F.lit(0)).alias("metric_total"),
            F.coalesce("fact_total", F.lit(0)).alias("fact_total"),
        )
        .filter(F.col("metric_total") != F.col("fact_total"))
    )


def gate(fact: DataFrame, dim_account: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """One row with the three counts that must be zero."""
    checks = {
        "orphaned_account_fk": orphan_accounts(fact, dim_account),
        "inconsistent_anomaly_flags": flag_consistency(fact, cfg),
        "duplicate_transaction_ids": duplicate_ids(fact).agg(F.count(F.lit(1))),
    }
    found = None
    for name, counted in checks.items():
        row = counted.toDF("_n").withColumn("_check", F.lit(name))
        found = row if found is None else found.unionByName(row)
    return found.agg(*[F.sum(F.when(F.col("_check") == name, F.col("_n"))).alias(name) for name in checks])


def enforce_gate(fact: DataFrame, dim_account: DataFrame, cfg: Config = DEFAULT) -> None:
    """Raises when one of the counts of `gate` is not zero."""
    broken = {name: n for name, n in gate(fact, dim_account, cfg).first().asDict().items() if n}
    if broken:
        raise QualityGateFailed(f"facts do not pass: {broken}")
