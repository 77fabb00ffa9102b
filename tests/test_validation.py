from __future__ import annotations

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from helpers import raw, rows_of
from tallylake.operators import layers, validation
from tallylake.functions.columns import date_key, money_sum
from tallylake.operators.features import time_features
from tallylake.operators.validation import (
    failure_reasons, invalid_rows, normalize_categories, quality_rates, reason_counts, split, valid_rows,
)
from tallylake.sources import payload
from tallylake.sources.tables import raw_transactions

MISSING, AMOUNT, TIME = "MISSING_REQUIRED_FIELD", "INVALID_AMOUNT", "INVALID_TIMESTAMP"
TYPE, STATUS = "INVALID_TRANSACTION_TYPE", "INVALID_STATUS"


@pytest.mark.parametrize(
    "change, expected",
    [
        ({}, ""),
        ({"transaction_id": None}, MISSING),
        ({"transaction_id": "  "}, MISSING),
        ({"account_id": None}, MISSING),
        ({"transaction_type": "TELEPORT_PAYMENT"}, TYPE),
        ({"transaction_type": None}, MISSING),
        ({"amount": "-50.00"}, AMOUNT),
        ({"amount": "0"}, AMOUNT),
        ({"amount": "abcdef"}, AMOUNT),
        ({"amount": ""}, AMOUNT),
        ({"amount": "NaN"}, AMOUNT),
        ({"amount": "Infinity"}, AMOUNT),
        ({"amount": "1e999"}, AMOUNT),
        ({"amount": "5d"}, AMOUNT),
        ({"amount": " 5.25 "}, ""),
        ({"amount": None}, f"{MISSING},{AMOUNT}"),
        ({"timestamp": "not-a-real-timestamp"}, TIME),
        ({"timestamp": "2026-01-01"}, TIME),
        ({"timestamp": "2026"}, TIME),
        ({"timestamp": "2026-13-01T10:00:00Z"}, TIME),
        ({"timestamp": "2026-01-01T10:00:00+05:30"}, ""),
        ({"timestamp": None}, f"{MISSING},{TIME}"),
        ({"status": "UNKNOWN_STATE"}, STATUS),
        ({"status": None}, MISSING),
        ({"channel": None, "city": None}, ""),
        ({"account_id": "", "amount": "-1", "status": "X"}, f"{MISSING},{AMOUNT},{STATUS}"),
    ],
)
def test_reason(spark, change, expected):
    row = failure_reasons(raw(spark, change)).first()
    assert row["failure_reason"] == expected
    assert ",".join(row["failure_reasons"]) == expected


def test_split_is_disjoint_and_complete(spark):
    rows = raw(spark, {}, {"amount": "-1"}, {"transaction_id": None}, {"status": None}, {"transaction_id": "TXN-2"})
    valid, invalid = split(rows)
    assert valid.count() == 2
    assert invalid.count() == 3
    assert "failure_reason" in invalid.columns and "failure_reason" not in valid.columns


def test_valid_rows_are_typed(spark):
    row = valid_rows(raw(spark, {"timestamp": "2026-01-01T10:00:00+05:30"})).first()
    assert row["amount"] == 100.5
    assert row["event_timestamp"] == "2026-01-01T04:30:00.000Z"
    assert "timestamp" not in row.asDict()


def test_counts_and_rates(spark):
    rows = raw(spark, {}, {"amount": None}, {"amount": "x"}, {"status": "X"})
    assert rows_of(reason_counts(rows), "reason", "row_count") == [(AMOUNT, 2), (STATUS, 1), (MISSING, 1)]
    rates = quality_rates(rows).first()
    assert (rates["total_rows"], rates["valid_rows"], rates["invalid_rows"]) == (4, 1, 3)
    assert rates["quarantine_rate"] == 0.75
    assert quality_rates(rows.limit(0)).first()["quarantine_rate"] == 0.0


def test_normalize_categories(spark):
    untidy = raw(spark, {"transaction_type": " transfer ", "status": "success"})
    assert invalid_rows(untidy).count() == 1
    assert invalid_rows(normalize_categories(untidy)).count() == 0


def test_payload_parsing_and_quarantine_text(spark):
    good = raw(spark).select(F.to_json(F.struct("*")).alias("v")).first()["v"]
    texts = [good, '{"transaction_id":"T', "no json at all", good.replace("100.50", "-1"), None]
    messages = spark.createDataFrame(
        [("t", 0, 2**40 + i, v) for i, v in enumerate(texts)], "topic string, partition int, offset long, value string"
    )
    parsed = payload.parse_payload(messages)
    assert rows_of(parsed, "offset", "is_malformed") == [
        (2**40 + i, flag) for i, flag in enumerate((False, True, True, False, True))
    ]
    records = layers.quarantine_records(layers.rejected_messages(parsed))
    assert rows_of(records.filter("raw_record IS NOT NULL"), "raw_record", "failure_reason", "offset") == sorted(
        [
            (texts[1], "MALFORMED_JSON", 2**40 + 1),
            (texts[2], "MALFORMED_JSON", 2**40 + 2),
            (texts[3], AMOUNT, 2**40 + 3),
        ],
        key=repr,
    )


def test_quarantine_record_without_lineage(spark):
    record = layers.quarantine_records(invalid_rows(raw(spark, {"amount": None}))).first()
    assert '"amount":null' in record["raw_record"]
    assert (record["source_topic"], record["partition"], record["offset"]) == ("transactions", None, None)


def test_replay(spark):
    lineage = spark.createDataFrame([("a", 0, 7), ("b", 1, 8)], "transaction_id string, partition int, offset long")
    broken = raw(spark, {"transaction_id": "a", "amount": "abc"}, {"transaction_id": "b", "status": "X"})
    rejected = validation.invalid_rows(broken.join(lineage, "transaction_id").withColumn("topic", F.lit("t")))
    fixes = spark.createDataFrame(
        [("t", 0, 7, "12.5"), ("t", 0, 7, "11.5"), ("u", 0, 7, "99"), ("u", 1, 8, "98")],
        "topic string, partition int, offset long, amount string",
    )
    replayed = layers.replay(layers.quarantine_records(rejected), fixes)
    assert rows_of(valid_rows(replayed), "transaction_id", "amount") == [("a", 12.5)]
    assert rows_of(invalid_rows(replayed), "transaction_id", "failure_reason") == [("b", STATUS)]


def test_large_and_small_amounts_count(spark):
    rows = raw(spark, {"transaction_id": "a", "amount": "2e16"}, {"transaction_id": "b", "amount": "0.004"},
               {"transaction_id": "c", "amount": "1e999"})
    valid = valid_rows(rows)
    assert rows_of(valid, "transaction_id") == [("a",), ("b",)]
    assert valid.select(money_sum(F.col("amount"))).first()[0] == 20000000000000000.004


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/New_York"])
def test_times_are_utc_in_every_session(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = ["2026-01-01T10:00:00.000Z", "2026-01-01T10:00:00", "2026-03-08T02:30:00+05:30", "1969-12-31T23:59:59.5Z"]
        rows = raw(spark, *({"transaction_id": str(i), "timestamp": t} for i, t in enumerate(texts)))
        timed = time_features(valid_rows(rows)).withColumn("key", date_key(F.col("event_ts")))
        timed = timed.withColumn("event_date", F.col("event_date").cast("string"))
        assert rows_of(timed, "transaction_id", "event_timestamp", "event_date", "event_hour", "event_minute", "key") == [
            ("0", "2026-01-01T10:00:00.000Z", "2026-01-01", 10, 0, 20260101),
            ("1", "2026-01-01T10:00:00.000Z", "2026-01-01", 10, 0, 20260101),
            ("2", "2026-03-07T21:00:00.000Z", "2026-03-07", 21, 0, 20260307),
            ("3", "1969-12-31T23:59:59.500Z", "1969-12-31", 23, 59, 19691231),
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_generated_code_is_small_enough_to_be_compiled(spark, tmp_path):
    """The JVM interprets methods of more than 8,000 bytes for good."""
    rows = ("1L AS event_id", "TIMESTAMP_NTZ'2024-01-01 10:00:00' AS ts", "5L AS user_id", "'view' AS event_type", "1.5D AS value", "'{\"k\": 3}' AS props")
    spark.range(1).selectExpr(*rows).write.parquet(str(tmp_path / "events.parquet"))
    for copies in (False, True):
        raw = raw_transactions(spark, str(tmp_path), copies)
        for df in (raw, validation.valid_rows(raw), validation.invalid_rows(raw)):
            shown = io.StringIO()
            with contextlib.redirect_stdout(shown):
                df.explain("codegen")
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", shown.getvalue())]
            assert sizes and max(sizes) < 8_000
