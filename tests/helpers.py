"""Small frames shaped like the real ones."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from tallylake.schemas import RAW_SCHEMA

GOOD = {
    "transaction_id": "TXN-1",
    "account_id": "ACC0000000001",
    "transaction_type": "TRANSFER",
    "amount": "100.50",
    "currency": "INR",
    "timestamp": "2026-01-01T10:00:00.000Z",
    "channel": "MOBILE",
    "status": "SUCCESS",
    "merchant_category": "GROCERY",
    "city": "Mumbai",
    "device_id": "DEV-1",
    "source": "test",
    "_injected_violation": None,
}

EVENT_SCHEMA = (
    "transaction_id string, account_id string, amount double, status string, device_id string, city string,"
    " event_ts timestamp"
)


def raw(spark: SparkSession, *changes: dict) -> DataFrame:
    rows = [{**GOOD, **change} for change in changes or ({},)]
    return spark.createDataFrame([tuple(r[f] for f in RAW_SCHEMA.fieldNames()) for r in rows], RAW_SCHEMA)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def events(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, EVENT_SCHEMA)


def event(i: int, ts: str, account="A", amount=100.0, status="SUCCESS", device="D1", city="Mumbai") -> tuple:
    return (f"T{i:04d}", account, amount, status, device, city, at(ts))


def rows_of(df: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
