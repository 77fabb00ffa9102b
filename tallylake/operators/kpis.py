"""KPI tables: partial rows of some facts, which add up to the rows of all. Both are combined before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylake.config import Config, DEFAULT
from tallylake.functions.columns import count_if, money, ratio, utc_date
from tallylake.operators.scoring import band


def _failed() -> Column:
    return count_if(F.col("status") == "FAILED")


def _anomalies() -> Column:
    return count_if(F.col("is_anomaly") == 1)


def _money() -> tuple[Column, Column]:
    """Exact total, and how many amounts are in it."""
    amount = money(F.col("amount"))
    return F.sum(amount).alias("amount_sum"), F.count(amount).alias("amount_count")


def _added(*names: str) -> list[Column]:
    return [F.sum(name).alias(name) for name in names]


def _volume() -> Column:
    return F.col("amount_sum").cast("double")


# Partial rows: `*_parts` of facts, `added_*` of partial rows (again partial rows), `*_of` the table they stand for.


def daily_parts(fact: DataFrame) -> DataFrame:
    return fact.groupBy("date_key").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        *_money(),
        count_if(F.col("status") == "SUCCESS").alias("success_count"),
        _failed().alias("failed_count"),
        _anomalies().alias("anomaly_count"),
        F.current_timestamp().alias("computed_at"),
    )


def added_daily(parts: DataFrame) -> DataFrame:
    return parts.groupBy("date_key").agg(
        *_added("total_transactions", "amount_sum", "amount_count", "success_count", "failed_count", "anomaly_count"),
        F.max("computed_at").alias("computed_at"),
    )


def daily_of(parts: DataFrame) -> DataFrame:
    return added_daily(parts).select(
        "date_key",
        "total_transactions",
        _volume().alias("total_volume"),
        "success_count",
        "failed_count",
        ratio(F.col("success_count"), F.col("total_transactions")).alias("success_rate"),
        "anomaly_count",
        ratio(F.col("anomaly_count"), F.col("total_transactions")).alias("anomaly_rate"),
        F.try_divide(_volume(), F.col("amount_count").cast("double")).alias("avg_transaction_value"),
        "computed_at",
    )


def daily_metrics(fact: DataFrame) -> DataFrame:
    return daily_of(daily_parts(fact))


def hourly_parts(fact: DataFrame) -> DataFrame:
    # `event_timestamp` is canonical UTC text, so its hour does not depend on the session time zone.
    hour = F.substring("event_timestamp", 12, 2).cast("int")
    return fact.groupBy("date_key", hour.alias("hour_of_day")).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        _money()[0],
        _anomalies().alias("anomaly_count"),
        _failed().alias("failed_count"),
        F.current_timestamp().alias("computed_at"),
    )


def added_hourly(parts: DataFrame) -> DataFrame:
    return parts.groupBy("date_key", "hour_of_day").agg(
        *_added("total_transactions", "amount_sum", "anomaly_count", "failed_count"),
        F.max("computed_at").alias("computed_at"),
    )


def hourly_of(parts: DataFrame) -> DataFrame:
    return added_hourly(parts).select(
        "date_key", "hour_of_day", "total_transactions", _volume().alias("total_volume"), "anomaly_count",
        "failed_count", "computed_at",
    )


def hourly_metrics(fact: DataFrame) -> DataFrame:
    return hourly_of(hourly_parts(fact))


def account_parts(fact: DataFrame) -> DataFrame:
    return fact.groupBy("account_key").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        _money()[0],
        _anomalies().alias("anomaly_count"),
        F.max("anomaly_score").alias("max_anomaly_score"),
        F.sum("anomaly_score").alias("score_sum"),
        F.count("anomaly_score").alias("score_count"),
        F.max("event_timestamp").alias("last_transaction_ts"),
        F.current_timestamp().alias("computed_at"),
    )


def added_account(parts: DataFrame) -> DataFrame:
    latest = [F.max(c).alias(c) for c in ("max_anomaly_score", "last_transaction_ts", "computed_at")]
    return parts.groupBy("account_key").agg(
        *_added("total_transactions", "amount_sum", "anomaly_count", "score_sum", "score_count"), *latest
    )


def account_risk_of(parts: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    return added_account(parts).select(
        "account_key",
        "total_transactions",
        _volume().alias("total_volume"),
        "anomaly_count",
        "max_anomaly_score",
        F.try_divide(F.col("score_sum").cast("double"), F.col("score_count").cast("double")).alias("avg_anomaly_score"),
        "last_transaction_ts",
        band(F.col("max_anomaly_score"), cfg).alias("risk_band"),
        "computed_at",
    )


def account_risk(fact: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    return account_risk_of(account_parts(fact), cfg)


def device_parts(fact: DataFrame) -> DataFrame:
    """A sketch of the devices of each account and day (HyperLogLog, 2**12 places at most, few while there are few)."""
    return fact.groupBy("account_key", "date_key").agg(F.hll_sketch_agg("device_id").alias("devices"))


def added_devices(parts: DataFrame) -> DataFrame:
    return parts.groupBy("account_key", "date_key").agg(F.hll_union_agg("devices").alias("devices"))


# Three standard errors of a sketch of 2**12 places.
DEVICE_ERROR = 3 * 1.04 / 2**6


def device_counts(parts: DataFrame, first_day: int | None = None, last_day: int | None = None) -> DataFrame:
    """Estimated number of distinct devices of each account over any range of days, from stored sketches."""
    if first_day is not None:
        parts = parts.filter(F.col("date_key") >= first_day)
    if last_day is not None:
        parts = parts.filter(F.col("date_key") <= last_day)
    return parts.groupBy("account_key").agg(F.hll_sketch_estimate(F.hll_union_agg("devices")).alias("device_count"))


def account_activity(fact: DataFrame) -> DataFrame:
    """Per account: volume, failures, anomalies, last activity, number of devices and of locations.

    The rows are first grouped by account, device and location, so the distinct counts run over few rows.
    """
    parts = fact.groupBy("account_key", "device_id", "location_key").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(money(F.col("amount"))).alias("_amount"),
        F.count(money(F.col("amount"))).alias("_amounts"),
        _failed().alias("_failed"),
        _anomalies().alias("_anomalies"),
        F.max("anomaly_score").alias("_score"),
        F.max("event_timestamp").alias("_last"),
    )
    return parts.groupBy("account_key").agg(
        F.sum("_n").alias("total_transactions"),
        F.sum("_amount").cast("double").alias("total_volume"),
        F.try_divide(F.sum("_amount").cast("double"), F.sum("_amounts").cast("double")).alias("avg_amount"),
        F.sum("_failed").alias("failed_count"),
        F.sum("_anomalies").alias("anomaly_count"),
        F.max("_score").alias("max_anomaly_score"),
        F.max("_last").alias("last_activity"),
        F.count_distinct("device_id").alias("device_count"),
        F.count_distinct("location_key").alias("location_count"),
    )


def _latency() -> Column:
    return (F.unix_millis("ingestion_timestamp") - F.unix_millis("event_ts")).alias("_ms")


def ingest_latency(bronze: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Event-to-ingestion latency in milliseconds: mean and P95 (a mergeable quantile summary)."""
    return bronze.select(_latency()).agg(
        F.count("_ms").alias("row_count"),
        (F.sum("_ms") / F.count("_ms")).alias("avg_latency_ms"),
        F.percentile_approx("_ms", 0.95, accuracy).alias("p95_latency_ms"),
    )


# Stated error of a rank with KLL sketches of this size: 1.33 % in either direction at k = 200, in proportion to 1/k**0.9.
KLL_SIZE = 1600
KLL_RANK_ERROR = 0.0025


def latency_parts(bronze: DataFrame) -> DataFrame:
    """Per day of the events: rows, total latency, and a quantile sketch. Stored once, they answer any range of days."""
    day = utc_date(F.col("event_ts")).alias("day")
    return bronze.select(day, _latency()).groupBy("day").agg(
        F.count("_ms").alias("row_count"), F.sum("_ms").alias("total_ms"),
        F.kll_sketch_agg_bigint("_ms", F.lit(KLL_SIZE)).alias("sketch"),
    )


def latency_between(parts: DataFrame, first_day: str, last_day: str, quantile: float = 0.95) -> DataFrame:
    """Mean latency and a quantile over the days from `first_day` to `last_day`, from `latency_parts` (several rows of a
    day add up). No row in that range: a count of 0 and NULLs."""
    chosen = parts.filter(F.col("day").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date")))
    merged = chosen.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"), F.sum("total_ms").alias("_total"),
        F.kll_merge_agg_bigint("sketch").alias("_sketch"),
    )
    found = F.when(F.col("row_count") > 0, F.kll_sketch_get_quantile_bigint("_sketch", F.lit(quantile)))
    return merged.select(
        "row_count", F.try_divide("_total", "row_count").alias("avg_latency_ms"), found.alias("quantile_ms")
    )
