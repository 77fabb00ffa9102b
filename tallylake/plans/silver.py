"""Silver: cleaned, deduplicated, scored transactions."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.config import Config, DEFAULT
from tallylake.operators import features, scoring
from tallylake.operators.dedup import dedup
from tallylake.schemas import SILVER_COLUMNS, SILVER_SCHEMA
from tallylake.sources.store import read_or_empty, staged


Stage = Callable[[DataFrame, str], DataFrame]


def transaction_features(clean: DataFrame, cfg: Config = DEFAULT, stage: Stage = staged) -> DataFrame:
    """Time, window and history features of deduplicated rows."""
    timed = features.time_features(clean)
    # The mean comes first: its range partitioning runs what is before it twice, once for a sample.
    return features.txn_window_stats(features.rolling_mean_amount(timed, cfg, stage), cfg)


def silver_frame(valid: DataFrame, cfg: Config = DEFAULT, stage: Stage = staged) -> DataFrame:
    """Valid rows -> one scored row per transaction id, in the declared Silver columns."""
    return to_silver(scoring.score(transaction_features(dedup(valid), cfg, stage), cfg))


def to_silver(scored: DataFrame) -> DataFrame:
    return scored.select(*[c for c in SILVER_COLUMNS if c in scored.columns])


def centred_scores(valid: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """The same rules on the centred window and the whole-account mean."""
    windowed = features.centred_window_features(features.time_features(valid), cfg)
    return scoring.score(features.account_mean_amount(windowed), cfg)


def write_silver(silver: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write partitioned by event date; the rebalance evens out file sizes over busy and quiet days."""
    silver.hint("rebalance", "event_date").write.mode(mode).partitionBy("event_date").parquet(path)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """The Silver table; empty if nothing was written yet."""
    return read_or_empty(spark, path, SILVER_SCHEMA)


def silver_recent(
    spark: SparkSession,
    path: str,
    cfg: Config = DEFAULT,
    as_of: datetime | None = None,
    lookback_hours: int | None = None,
) -> DataFrame:
    """Silver rows of the last hours (all rows if no number is set). The implied date filter prunes partitions."""
    hours = cfg.lookback_hours if lookback_hours is None else lookback_hours
    if hours is None:
        return read_silver(spark, path)
    cutoff = (as_of or datetime.now(timezone.utc)) - timedelta(hours=hours)
    if cutoff.tzinfo is None:
        cutoff = cutoff.replace(tzinfo=timezone.utc)
    since = F.timestamp_micros(F.lit(int(cutoff.timestamp() * 1_000_000)))
    return read_silver(spark, path).filter(
        (F.col("event_ts") >= since) & (F.col("event_date") >= F.lit(cutoff.astimezone(timezone.utc).date()))
    )


def silver_arrived(
    spark: SparkSession, path: str, cfg: Config = DEFAULT, mark: datetime | None = None
) -> DataFrame:
    """Silver rows of the files written since `mark`, less the overlap, whatever their event time; `_arrived` tells when."""
    table = read_or_empty(spark, path, SILVER_SCHEMA, arrival="_arrived")
    if mark is None:
        return table
    since = mark - timedelta(hours=cfg.arrival_overlap_hours)
    return table.filter(F.col("_arrived") >= F.timestamp_micros(F.lit(int(since.timestamp() * 1_000_000))))
