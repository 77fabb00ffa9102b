"""Validation: rules, ordered failure reasons, and the valid / invalid split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylake.config import Config, DEFAULT
from tallylake.functions.columns import (
    codes, count_if, is_blank, iso_text, parse_amount, parse_event_time, ratio,
)

# Failure code -> flag column, in reporting order.
RULES = {
    "MISSING_REQUIRED_FIELD": "missing_required_field",
    "INVALID_AMOUNT": "invalid_amount",
    "INVALID_TIMESTAMP": "invalid_timestamp",
    "INVALID_TRANSACTION_TYPE": "invalid_transaction_type",
    "INVALID_STATUS": "invalid_status",
}
FLAGS = tuple(RULES.values())
DUPLICATE = "DUPLICATE_TRANSACTION"
MALFORMED = "MALFORMED_JSON"
IMPLAUSIBLE = "IMPLAUSIBLE_TIMESTAMP"


def _missing(cfg: Config) -> Column:
    found = F.lit(False)
    for name in cfg.required_fields:
        # A blank amount is an invalid amount, not a missing one.
        found = found | (F.col(name).isNull() if name == "amount" else is_blank(F.col(name)))
    return found


def _outside(name: str, domain: tuple[str, ...]) -> Column:
    # An absent value is reported as missing only.
    return F.coalesce(~F.col(name).isin(*domain), F.lit(False))


def validation_flags(raw: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Raw rows plus one never-NULL boolean per rule, the parsed amount and the parsed event time."""
    # Behind a generator, so that a filter on the flags does not parse again, in one method too large to be compiled.
    values = F.struct(
        parse_amount(F.col("amount")).alias("amount_value"),
        parse_event_time(F.col("timestamp"), cfg.iso_timestamp).alias("event_ts"),
    )
    replaced = [c for c in raw.columns if c in ("amount_value", "event_ts")]
    parsed = raw.drop(*replaced).select("*", F.inline(F.array(values)))
    amount = F.col("amount_value")
    usable = amount > 0
    return parsed.withColumns(
        {
            "missing_required_field": _missing(cfg),
            "invalid_amount": ~F.coalesce(usable & (amount < float("inf")), F.lit(False)),
            "invalid_timestamp": F.col("event_ts").isNull(),
            "invalid_transaction_type": _outside("transaction_type", cfg.transaction_types),
            "invalid_status": _outside("status", cfg.statuses),
        }
    )


def failure_reasons(raw: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Raw rows plus `failure_reasons` (array) and `failure_reason` (comma text, '' for a valid row)."""
    flagged = validation_flags(raw, cfg)
    return flagged.withColumn(
        "failure_reasons", codes((code, F.col(flag)) for code, flag in RULES.items())
    ).withColumn("failure_reason", F.concat_ws(",", "failure_reasons"))


def _is_invalid() -> Column:
    found = F.lit(False)
    for flag in FLAGS:
        found = found | F.col(flag)
    return found


def valid_rows(raw: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Rows that break no rule, typed: double amount, canonical ISO text, event timestamp."""
    typed = (
        validation_flags(raw, cfg)
        .filter(~_is_invalid())
        .withColumns({"amount": F.col("amount_value"), "event_timestamp": iso_text(F.col("event_ts"))})
    )
    return typed.drop("amount_value", "timestamp", *FLAGS)


def invalid_rows(raw: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Rows that break at least one rule, as received, with their reasons."""
    return failure_reasons(raw, cfg).filter(_is_invalid()).drop("amount_value", "event_ts", *FLAGS)


def split(raw: DataFrame, cfg: Config = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid): disjoint, and together all of `raw`."""
    return valid_rows(raw, cfg), invalid_rows(raw, cfg)


def normalize_categories(raw: DataFrame) -> DataFrame:
    """Upper-case, blank-free category text. Optional; run it before validation."""
    names = [c for c in ("transaction_type", "status", "channel", "merchant_category") if c in raw.columns]
    return raw.withColumns({name: F.upper(F.trim(F.col(name))) for name in names})


def reason_counts(raw: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Invalid rows per single reason."""
    return (
        failure_reasons(raw, cfg)
        .select(F.explode("failure_reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def quality_rates(raw: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """One row: total, valid and quarantined rows and the quarantine rate."""
    return (
        validation_flags(raw, cfg)
        .agg(
            F.count(F.lit(1)).alias("total_rows"),
            count_if(~_is_invalid()).alias("valid_rows"),
            count_if(_is_invalid()).alias("invalid_rows"),
        )
        .withColumn("quarantine_rate", ratio(F.col("invalid_rows"), F.col("total_rows")))
    )
