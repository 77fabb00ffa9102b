"""Bronze and quarantine records, and their replay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.config import Config, DEFAULT
from tallylake.functions.columns import iso_text, utc_date
from tallylake.operators.dedup import duplicates
from tallylake.operators.validation import DUPLICATE, MALFORMED, invalid_rows
from tallylake.schemas import LINEAGE, QUARANTINE_SCHEMA, RAW_RECORD_FIELDS, RAW_SCHEMA


def bronze(valid: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    return valid.withColumns(
        {
            "ingestion_timestamp": F.current_timestamp(),
            "ingestion_date": utc_date(F.current_timestamp()),
            "pipeline_source": F.lit(cfg.pipeline_source),
        }
    )


def quarantine_records(rejected: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Dead-letter records of rows that carry a `failure_reason`.

    `raw_record` is the payload as received where the source kept it, else the raw columns as JSON with
    their NULLs.
    """
    have = set(rejected.columns)
    rebuilt = F.to_json(
        F.struct(*[c for c in RAW_RECORD_FIELDS if c in have]), {"ignoreNullFields": "false"}
    )
    columns = {
        "raw_record": F.col("value") if "value" in have else rebuilt,
        "failure_reason": F.col("failure_reason"),
        "validation_timestamp": iso_text(F.current_timestamp()),
        "source_topic": F.col("topic") if "topic" in have else F.lit(cfg.default_topic),
        "partition": F.col("partition") if "partition" in have else F.lit(None),
        "offset": F.col("offset") if "offset" in have else F.lit(None),
    }
    return rejected.select(
        *[columns[f.name].cast(f.dataType).alias(f.name) for f in QUARANTINE_SCHEMA.fields]
    )


def malformed_rows(parsed: DataFrame) -> DataFrame:
    """Parsed messages whose payload was no usable JSON, with their reason."""
    return parsed.filter("is_malformed").withColumn("failure_reason", F.lit(MALFORMED))


def duplicate_rows(valid: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Valid rows whose transaction id was already taken, with their reason."""
    return duplicates(valid, cfg).withColumn("failure_reason", F.lit(DUPLICATE))


def rejected_messages(parsed: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Malformed payloads and rows that break a rule; a malformed payload is reported as just that."""
    broken = invalid_rows(parsed.filter(~F.col("is_malformed")), cfg)
    columns = [*LINEAGE, "value", "failure_reason"]
    return malformed_rows(parsed).select(*columns).unionByName(broken.select(*columns))


def replay(quarantine: DataFrame, corrections: DataFrame) -> DataFrame:
    """Raw rows read back from quarantine with corrected fields put in, ready to be validated again.

    `corrections` holds the stream position (`topic`, `partition`, `offset`) and any raw columns; a NULL there keeps
    the original value. Of several corrections of one position the largest is taken, column by column.
    """
    fixed = [c for c in corrections.columns if c in RAW_SCHEMA.fieldNames()]
    position = ["topic", "partition", "offset"]
    renamed = corrections.groupBy(*position).agg(*[F.max(c).alias(f"_new_{c}") for c in fixed])
    original = quarantine.select(
        F.col("source_topic").alias("topic"),
        "partition",
        "offset",
        F.from_json("raw_record", RAW_SCHEMA).alias("_raw"),
    ).select("topic", "partition", "offset", "_raw.*")
    return original.join(renamed, position, "left").select(
        *LINEAGE,
        *[
            (F.coalesce(F.col(f"_new_{c}"), F.col(c)) if c in fixed else F.col(c)).alias(c)
            for c in RAW_SCHEMA.fieldNames()
        ],
    )
