"""Report tables over the star schema.

Facts are grouped by the surrogate key first; the dimension is joined to the few groups that remain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylake.config import Config, DEFAULT
from tallylake.functions.columns import count_if, money, money_mean, money_sum, ratio
from tallylake.operators.facts import Dimensions
from tallylake.operators.scoring import band
from tallylake.operators.skew import lookup


def _count() -> Column:
    return F.count(F.lit(1)).alias("total_transactions")


def _volume() -> Column:
    return money_sum(F.col("amount")).alias("total_volume")


def _anomalies() -> Column:
    return count_if(F.col("is_anomaly") == 1).alias("anomaly_count")


def kpi_overview(fact: DataFrame) -> DataFrame:
    totals = fact.agg(
        _count(),
        F.coalesce(money_sum(F.col("amount")), F.lit(0.0)).alias("total_volume"),
        count_if(F.col("status") == "SUCCESS").alias("success_count"),
        count_if(F.col("status") == "FAILED").alias("failed_transactions"),
        _anomalies(),
        F.coalesce(F.sum("anomaly_score"), F.lit(0)).alias("_score"),
        money_mean(F.col("amount")).alias("avg_transaction_value"),
    )
    whole = F.col("total_transactions")
    return totals.select(
        "total_transactions",
        "total_volume",
        ratio(F.col("success_count"), whole).alias("success_rate"),
        "anomaly_count",
        ratio(F.col("anomaly_count"), whole).alias("anomaly_rate"),
        ratio(F.col("_score"), whole).alias("avg_anomaly_score"),
        "failed_transactions",
        ratio(F.col("failed_transactions"), whole).alias("failure_rate"),
        "avg_transaction_value",
    )


def risk_account_counts(risk: DataFrame) -> DataFrame:
    def accounts(name: str) -> Column:
        return count_if(F.col("risk_band") == name)  # one row per account

    return risk.agg(
        accounts("WATCH").alias("watch_band_accounts"), accounts("ANOMALY").alias("high_risk_accounts")
    )


def volume_mom(fact: DataFrame) -> DataFrame:
    """Volume per month against the calendar month before; 0 where there is no month before."""
    month = F.trunc(F.to_date(F.col("date_key").cast("string"), "yyyyMMdd"), "month")
    per_day = fact.groupBy("date_key").agg(F.sum(money(F.col("amount"))).alias("_volume"))
    monthly = per_day.groupBy(month.alias("month")).agg(F.sum("_volume").cast("double").alias("total_volume"))
    before = monthly.select(F.add_months("month", 1).alias("month"), F.col("total_volume").alias("prior_volume"))
    change = F.col("total_volume") - F.col("prior_volume")
    return monthly.join(before, "month", "left").select(
        "month", "total_volume", "prior_volume", ratio(change, F.col("prior_volume")).alias("volume_mom")
    )


def daily_trend(
    fact: DataFrame,
    dims: Dimensions,
    first_day: int | None = None,
    last_day: int | None = None,
    transaction_type: str | None = None,
    channel: str | None = None,
) -> DataFrame:
    """Volume and count per day, with the report's slicers as arguments."""
    sliced = fact
    if first_day is not None:
        sliced = sliced.filter(F.col("date_key") >= first_day)
    if last_day is not None:
        sliced = sliced.filter(F.col("date_key") <= last_day)
    if transaction_type is not None:
        wanted = dims.transaction_type.filter(F.col("transaction_type") == transaction_type)
        sliced = sliced.join(wanted.select("transaction_type_key"), "transaction_type_key", "left_semi")
    if channel is not None:
        wanted = dims.channel.filter(F.col("channel") == channel)
        sliced = sliced.join(wanted.select("channel_key"), "channel_key", "left_semi")
    per_day = sliced.groupBy("date_key").agg(_count(), _volume())
    return per_day.join(dims.date.select("date_key", "full_date"), "date_key").select(
        "full_date", "total_transactions", "total_volume"
    )


def _by(fact: DataFrame, dim: DataFrame, key: str, name: str, *measures: Column) -> DataFrame:
    grouped = fact.groupBy(key).agg(*measures)
    return grouped.join(dim.select(key, name), key, "left").drop(key)


def by_type(fact: DataFrame, dims: Dimensions) -> DataFrame:
    return _by(fact, dims.transaction_type, "transaction_type_key", "transaction_type", _count(), _volume())


def by_channel(fact: DataFrame, dims: Dimensions) -> DataFrame:
    return _by(fact, dims.channel, "channel_key", "channel", _count(), _volume())


def by_city(fact: DataFrame, dims: Dimensions) -> DataFrame:
    return _by(fact, dims.location, "location_key", "city", _count(), _volume())


def avg_size_by_type_channel(fact: DataFrame, dims: Dimensions) -> DataFrame:
    grouped = fact.groupBy("transaction_type_key", "channel_key").agg(
        _count(), money_mean(F.col("amount")).alias("avg_transaction_value")
    )
    return (
        grouped.join(dims.transaction_type, "transaction_type_key", "left")
        .join(dims.channel, "channel_key", "left")
        .select("transaction_type", "channel", "total_transactions", "avg_transaction_value")
    )


def success_failure_daily(daily: DataFrame, dims: Dimensions) -> DataFrame:
    return daily.join(dims.date.select("date_key", "full_date"), "date_key").select(
        "full_date", "success_count", "failed_count"
    )


def hourly_heatmap(hourly: DataFrame, dims: Dimensions) -> DataFrame:
    """Hour of day by day of week (0 = Monday), filled with transaction counts."""
    days = dims.date.select("date_key", "day_of_week")
    counts = (
        hourly.join(days, "date_key")
        .groupBy("hour_of_day")
        .pivot("day_of_week", list(range(7)))
        .agg(F.sum("total_transactions"))
    )
    return counts.select(
        "hour_of_day", *[F.coalesce(F.col(str(d)), F.lit(0)).alias(f"day_{d}") for d in range(7)]
    )


def amount_score_buckets(fact: DataFrame, cfg: Config = DEFAULT, width: int = 50) -> DataFrame:
    bucket = (F.floor(F.col("amount") / F.lit(width)) * F.lit(width)).cast("long")
    return (
        fact.groupBy(bucket.alias("amount_bucket"), "anomaly_score")
        .agg(_count())
        .withColumn("anomaly_band", band(F.col("anomaly_score"), cfg))
    )


def top_risk_accounts(risk: DataFrame, dims: Dimensions, n: int = 10) -> DataFrame:
    """The n accounts with the highest score. Ties go to more anomalies, then the smaller key; the account
    names are looked up for those n rows only."""
    top = risk.orderBy(F.desc("max_anomaly_score"), F.desc("anomaly_count"), "account_key").limit(n)
    return dims.account.select("account_key", "account_id").join(F.broadcast(top), "account_key").select(
        "account_id", "total_transactions", "anomaly_count", "max_anomaly_score", "risk_band"
    )


def anomaly_reasons_exploded(fact: DataFrame, dims: Dimensions, cfg: Config = DEFAULT) -> DataFrame:
    """Flagged transactions, one row per reason."""
    flagged = fact.filter(F.col("is_anomaly") == 1).select(
        "transaction_id",
        "account_key",
        "amount",
        "anomaly_score",
        "event_timestamp",
        F.explode(F.split("anomaly_reasons", ",")).alias("reason"),
    )
    return lookup(flagged, dims.account.select("account_key", "account_id"), "account_key", cfg).select(
        "transaction_id", "account_id", "amount", "anomaly_score", "reason", "event_timestamp"
    )


def reason_counts(fact: DataFrame) -> DataFrame:
    return (
        fact.filter(F.col("is_anomaly") == 1)
        .select(F.explode(F.split("anomaly_reasons", ",")).alias("reason"))
        .groupBy("reason")
        .agg(_count())
    )


def anomaly_trend(daily: DataFrame, dims: Dimensions) -> DataFrame:
    return daily.join(dims.date.select("date_key", "full_date"), "date_key").select(
        "full_date", "anomaly_count", "anomaly_rate"
    )


def by_segment(fact: DataFrame, dims: Dimensions) -> DataFrame:
    """Volume and count per customer segment, from one partial row per account."""
    per_account = fact.groupBy("account_key").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(money(F.col("amount"))).alias("_amount")
    )
    return (
        per_account.join(dims.account.select("account_key", "customer_segment"), "account_key", "left")
        .groupBy("customer_segment")
        .agg(
            F.sum("_n").alias("total_transactions"),
            F.sum("_amount").cast("double").alias("total_volume"),
        )
    )


def burst_accounts(fact: DataFrame, dims: Dimensions) -> DataFrame:
    """Accounts with transactions that were part of a burst."""
    bursts = fact.filter(F.array_contains(F.split("anomaly_reasons", ","), "TRANSACTION_BURST"))
    return _by(
        bursts, dims.account, "account_key", "account_id",
        F.count(F.lit(1)).alias("burst_transactions"), F.max("event_timestamp").alias("last_burst_ts"),
    )


def device_diversity(fact: DataFrame) -> DataFrame:
    """Number of accounts by number of distinct devices: 0, 1, 2, 3-5, 6 and more."""
    devices = fact.groupBy("account_key").agg(F.count_distinct("device_id").alias("_devices"))
    bucket = (
        F.when(F.col("_devices") <= 2, F.col("_devices").cast("string"))
        .when(F.col("_devices") <= 5, F.lit("3-5"))
        .otherwise(F.lit("6+"))
    )
    return devices.groupBy(bucket.alias("device_bucket")).agg(F.count(F.lit(1)).alias("account_count"))


def risk_distribution(risk: DataFrame) -> DataFrame:
    return risk.groupBy("risk_band").agg(F.count(F.lit(1)).alias("account_count"))


def anomaly_by_dim(fact: DataFrame, dims: Dimensions) -> DataFrame:
    """Anomaly counts by transaction type and by channel, in one table."""
    by_kind = _by(fact, dims.transaction_type, "transaction_type_key", "transaction_type", _count(), _anomalies())
    by_way = _by(fact, dims.channel, "channel_key", "channel", _count(), _anomalies())
    parts = [
        table.select(F.lit(name).alias("dimension"), F.col(name).alias("member"), "total_transactions", "anomaly_count")
        for table, name in ((by_kind, "transaction_type"), (by_way, "channel"))
    ]
    return parts[0].unionByName(parts[1])
