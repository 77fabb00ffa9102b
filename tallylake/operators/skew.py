"""Keys that hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylake.config import Config, DEFAULT


def salt_of(spread: Column, cfg: Config) -> Column:
    return F.pmod(F.xxhash64(spread), F.lit(cfg.salts)).cast("int")


def lookup(rows: DataFrame, table: DataFrame, key: str, cfg: Config = DEFAULT) -> DataFrame:
    """Left join of `rows` to a written lookup `table` with unique `key`.

    The table is counted, which only reads file footers, and its size in bytes is known from its files. Up to
    `cfg.broadcast_rows` rows and `cfg.broadcast_bytes` bytes it is broadcast; beyond that both sides are shuffled,
    and Spark's skew join splits the rows of keys, or of a missing key, that hold too many.
    """
    size = int(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size <= cfg.broadcast_bytes and table.count() <= cfg.broadcast_rows:
        return rows.join(F.broadcast(table), key, "left")
    return rows.join(table, key, "left")
