"""Parquet tables below one folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach: `spark.checkpoint.dir`. Only a local session, where it is unset,
    gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="tallylake-")


_FOLDERS: dict[str, str] = {}


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df`, written once to a table of its own below the shared folder and read back."""
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        _FOLDERS[app] = f"{shared_folder(spark)}/tallylake-stage-{app}"
    path = f"{_FOLDERS[app]}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_or_empty(
    spark: SparkSession, path: str, schema, base: str | None = None, arrival: str | None = None, **options: str
) -> DataFrame:
    """The Parquet table at `path` in the declared schema; empty if nothing was written yet. A `path` that
    names some partitions only needs the table folder as `base`. `arrival` names a column for the time at which the
    file of a row was written; filters on it leave out files before they are opened."""
    reader = spark.read.schema(schema).options(**options)
    try:
        table = (reader.option("basePath", base) if base else reader).parquet(path)
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" not in str(problem.getCondition()):
            raise
        table = spark.createDataFrame([], schema)
        return table.withColumn(arrival, F.lit(None).cast("timestamp")) if arrival else table
    wanted = spark.createDataFrame([], schema).columns if isinstance(schema, str) else schema.fieldNames()
    written = [F.col("_metadata.file_modification_time").alias(arrival)] if arrival else []
    return table.select(*wanted, *written)


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names right below a folder, in whatever store it lies; none if it is absent."""
    at, files = _path(spark, path)
    return [f.getPath().getName() for f in files.listStatus(at)] if files.exists(at) else []


def remove_folder(spark: SparkSession, path: str) -> None:
    at, files = _path(spark, path)
    files.delete(at, True)
