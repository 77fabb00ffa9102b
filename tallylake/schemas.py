"""Declared table shapes."""

from __future__ import annotations

from pyspark.sql import types as T

_S = T.StringType()

# Payload of one message. Every field is text; casts happen in validation.
RAW_FIELDS = (
    "transaction_id", "account_id", "transaction_type", "amount", "currency", "timestamp", "channel",
    "status", "merchant_category", "city", "device_id", "source", "_injected_violation",
)
RAW_SCHEMA = T.StructType([T.StructField(name, _S) for name in RAW_FIELDS])

# Columns rebuilt into `raw_record` when the original payload text is gone.
RAW_RECORD_FIELDS = RAW_FIELDS[:-1]

LINEAGE = ("topic", "partition", "offset")

QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField("raw_record", _S),
        T.StructField("failure_reason", _S),
        T.StructField("validation_timestamp", _S),
        T.StructField("source_topic", _S),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)

SILVER_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", _S),
        T.StructField("account_id", _S),
        T.StructField("transaction_type", _S),
        T.StructField("amount", T.DoubleType()),
        T.StructField("currency", _S),
        T.StructField("event_timestamp", _S),
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("event_date", T.DateType()),
        T.StructField("event_hour", T.IntegerType()),
        T.StructField("channel", _S),
        T.StructField("status", _S),
        T.StructField("merchant_category", _S),
        T.StructField("city", _S),
        T.StructField("device_id", _S),
        T.StructField("source", _S),
        T.StructField("window_txn_count", T.LongType()),
        T.StructField("window_total_amount", T.DoubleType()),
        T.StructField("window_failed_count", T.LongType()),
        T.StructField("window_distinct_devices", T.LongType()),
        T.StructField("window_distinct_cities", T.LongType()),
        T.StructField("high_amount_flag", T.BooleanType()),
        T.StructField("burst_flag", T.BooleanType()),
        T.StructField("failure_burst_flag", T.BooleanType()),
        T.StructField("location_jump_flag", T.BooleanType()),
        T.StructField("new_device_flag", T.BooleanType()),
        T.StructField("unusual_hour_flag", T.BooleanType()),
        T.StructField("anomaly_score", T.IntegerType()),
        T.StructField("anomaly_band", _S),
        T.StructField("is_anomaly", T.BooleanType()),
        T.StructField("anomaly_reasons", _S),
    ]
)
SILVER_COLUMNS = tuple(SILVER_SCHEMA.fieldNames())

ID_SCHEMA = "transaction_id string, id_part int"
BIT_SCHEMA = "id_part int, width long, bucket long, bits binary"

# Gold tables, without the partition layout.
GOLD_SCHEMAS = {
    "dim_account": "account_key long, account_id string, account_type string, customer_segment string,"
    " created_at timestamp, updated_at timestamp",
    "dim_date": "date_key int, full_date date, day int, month int, month_name string, quarter int, year int,"
    " day_of_week int, day_name string, is_weekend int",
    "dim_transaction_type": "transaction_type_key long, transaction_type string",
    "dim_channel": "channel_key long, channel string",
    "dim_location": "location_key long, city string, region string",
    "fact_transactions": "transaction_key long, transaction_id string, account_key long, date_key int,"
    " transaction_type_key long, channel_key long, location_key long, amount double, currency string,"
    " status string, merchant_category string, device_id string, anomaly_score int, is_anomaly int,"
    " anomaly_reasons string, event_timestamp string, ingestion_timestamp timestamp",
    # Partial rows of each load: they add up to the KPI tables.
    "daily_parts": "date_key int, total_transactions long, amount_sum decimal(38,6), amount_count long,"
    " success_count long, failed_count long, anomaly_count long, computed_at timestamp",
    "hourly_parts": "date_key int, hour_of_day int, total_transactions long, amount_sum decimal(38,6),"
    " anomaly_count long, failed_count long, computed_at timestamp",
    "account_parts": "account_key long, total_transactions long, amount_sum decimal(38,6), anomaly_count long,"
    " max_anomaly_score int, score_sum long, score_count long, last_transaction_ts string, computed_at timestamp",
    "device_parts": "account_key long, date_key int, devices binary",
    # What a load must know about the facts before it.
    "fact_ids": ID_SCHEMA,
    "fact_id_bits": BIT_SCHEMA,
    "fact_key_tops": "_bucket long, _highest long",
}
