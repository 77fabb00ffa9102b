"""Fact rows: surrogate-key resolution, unresolved rows, keys of their own."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.config import Config, DEFAULT
from tallylake.functions.columns import codes, date_key
from tallylake.operators.dedup import dedup
from tallylake.operators.dimensions import UNKNOWN_KEY, with_keys
from tallylake.operators.skew import lookup

FACT_COLUMNS = (
    "transaction_key", "transaction_id", "account_key", "date_key", "transaction_type_key", "channel_key",
    "location_key", "amount", "currency", "status", "merchant_category", "device_id", "anomaly_score",
    "is_anomaly", "anomaly_reasons", "event_timestamp", "ingestion_timestamp",
)


@dataclass(frozen=True)
class Dimensions:
    account: DataFrame
    date: DataFrame
    transaction_type: DataFrame
    channel: DataFrame
    location: DataFrame


def resolve_keys(silver: DataFrame, dims: Dimensions, cfg: Config = DEFAULT) -> DataFrame:
    """Silver rows plus their five dimension keys; a key that is not found is NULL."""
    keyed = lookup(silver, dims.account.select("account_id", "account_key"), "account_id", cfg)
    for table, natural, key in (
        (dims.transaction_type, "transaction_type", "transaction_type_key"),
        (dims.channel, "channel", "channel_key"),
        (dims.location, "city", "location_key"),
    ):
        keyed = lookup(keyed, table.select(natural, key), natural, cfg)
    days = dims.date.select("date_key", F.lit(True).alias("_day"))
    keyed = lookup(keyed.withColumn("date_key", date_key(F.col("event_ts"))), days, "date_key", cfg)
    return keyed.withColumns(
        {
            "date_key": F.when(F.col("_day"), F.col("date_key")),
            "channel_key": F.when(F.col("channel").isNull(), F.lit(UNKNOWN_KEY).cast("long")).otherwise(
                F.col("channel_key")
            ),
        }
    ).drop("_day")


_KEYS = (
    ("UNRESOLVED_DATE", "date_key"),
    ("UNRESOLVED_ACCOUNT", "account_key"),
    ("UNRESOLVED_TRANSACTION_TYPE", "transaction_type_key"),
    ("UNRESOLVED_CHANNEL", "channel_key"),
)


def unresolved(keyed: DataFrame) -> DataFrame:
    """Rows that cannot become facts, with the reason."""
    return keyed.withColumn(
        "skip_reason", F.concat_ws(",", codes((code, F.col(key).isNull()) for code, key in _KEYS))
    ).filter(F.col("skip_reason") != "")


def first_facts(keyed: DataFrame) -> DataFrame:
    """Resolved rows, the first per transaction id."""
    resolved = keyed
    for _, key in _KEYS:
        resolved = resolved.filter(F.col(key).isNotNull())
    return dedup(resolved)


def numbered_facts(first: DataFrame, cfg: Config = DEFAULT, highest: DataFrame | None = None) -> DataFrame:
    """Rows of `first_facts` as facts, with surrogate keys after the `highest` ones that are stored."""
    filled = first.withColumns(
        {
            "amount": F.coalesce("amount", F.lit(0.0)),
            "currency": F.coalesce("currency", F.lit(cfg.currency)),
            "anomaly_score": F.coalesce("anomaly_score", F.lit(0)).cast("int"),
            "is_anomaly": F.coalesce(F.col("is_anomaly").cast("int"), F.lit(0)),
            "anomaly_reasons": F.coalesce("anomaly_reasons", F.lit("")),
            "ingestion_timestamp": F.current_timestamp(),
        }
    )
    return with_keys(filled, "transaction_id", "transaction_key", cfg.fact_key_bits, highest).select(*FACT_COLUMNS)


def fact_rows(keyed: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Facts of rows with resolved keys, the first per transaction id."""
    return numbered_facts(first_facts(keyed), cfg)


def fact_wide(fact: DataFrame, dims: Dimensions, cfg: Config = DEFAULT) -> DataFrame:
    """Facts with the attributes of all five dimensions."""
    wide = lookup(fact, dims.account.select("account_key", "account_id", "account_type", "customer_segment"), "account_key", cfg)
    for table, key in (
        (dims.date, "date_key"),
        (dims.transaction_type, "transaction_type_key"),
        (dims.channel, "channel_key"),
        (dims.location, "location_key"),
    ):
        wide = lookup(wide, table, key, cfg)
    return wide
