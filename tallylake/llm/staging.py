"""Tables written to the shared folder and read back: they cut lineage and survive lost executors."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tallylake.sources.store import shared_folder

_FOLDERS: dict[str, str] = {}


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df`, written once to a Parquet table of its own below the shared folder."""
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        _FOLDERS[app] = f"{shared_folder(spark)}/tallylake-llm-{app}"
    path = f"{_FOLDERS[app]}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    """Partitions of an explicit repartition: the session's setting for shuffles."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def byte_slices(texts: pa.Array, limit: int = 2 << 20) -> Iterator[slice]:
    """Stretches of rows that hold about `limit` bytes of text each, so that a task unpacks a batch bit by bit."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < len(ends):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield slice(begin, end)
        begin = end
