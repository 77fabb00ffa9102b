"""Sources: message streams and batches, and the JSON payload they carry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake.schemas import RAW_FIELDS, RAW_SCHEMA

_CORRUPT = "_corrupt"
_PARSE_SCHEMA = T.StructType([*RAW_SCHEMA.fields, T.StructField(_CORRUPT, T.StringType())])


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Messages of one topic. Needs the Kafka connector on the classpath."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "false")
        .options(**options)
    )
    return reader.load().select("topic", "partition", "offset", "value")


def message_file_stream(
    spark: SparkSession, path: str, max_files: int | None = None
) -> DataFrame:
    """Messages landed as JSON-lines files of {topic, partition, offset, value}, e.g. a topic export."""
    reader = spark.readStream.schema("topic string, partition int, offset long, value string")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def parse_payload(messages: DataFrame) -> DataFrame:
    """Messages flattened to raw rows. The payload text stays in `value`; a payload that is no JSON object
    of the expected form has `is_malformed` set and all fields NULL."""
    parsed = F.from_json(
        F.col("value").cast("string"),
        _PARSE_SCHEMA,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT},
    )
    # A generator's output is computed once: later filters on the fields do not parse the payload again.
    rows = messages.select(
        "topic",
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("long").alias("offset"),
        F.col("value").cast("string").alias("value"),
        F.explode(F.array(parsed)).alias("_data"),
    )
    malformed = F.col("value").isNull() | F.col("_data").isNull() | F.col(f"_data.{_CORRUPT}").isNotNull()
    return rows.withColumn("is_malformed", malformed).select(
        "topic",
        "partition",
        "offset",
        "value",
        "is_malformed",
        *[F.when(~F.col("is_malformed"), F.col("_data")[name]).alias(name) for name in RAW_FIELDS],
    )


def as_payload(raw: DataFrame) -> DataFrame:
    """Raw rows written back as messages (lineage columns and one JSON `value`)."""
    fields = [c for c in RAW_FIELDS if c in raw.columns]
    return raw.select(
        "topic", "partition", "offset", F.to_json(F.struct(*fields)).alias("value")
    )
