"""Versions of a folder of tables: which loads count. A reader sees one version whole; a load is seen once it is listed.

Every load writes below `<table>/load=<name>` and is then listed, with its tables, in one row of a small table. A load
that died is not listed, so its files are never read. Replacing several loads by one (compaction) is a new list as well:
readers of the old list still find the old files until `forget` removes what no kept version lists.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.sources.store import folder_names, read_or_empty, remove_folder

# Lists are written in turn to so many slots, the oldest first; so many versions stay readable.
KEPT = 64
_SCHEMA = "version long, mark timestamp, loads array<struct<name:string,level:int,tables:array<string>>>"


@dataclass(frozen=True)
class Load:
    name: str
    # Loads of level n + 1 were made of loads of level n.
    level: int
    tables: tuple[str, ...]


@dataclass(frozen=True)
class Version:
    number: int = 0
    # Newest arrival that was read from the source.
    mark: datetime | None = None
    loads: tuple[Load, ...] = ()

    def having(self, table: str) -> list[Load]:
        return [load for load in self.loads if table in load.tables]


def _kept(spark: SparkSession, folder: str) -> DataFrame:
    return read_or_empty(spark, f"{folder}/versions/slot=*", _SCHEMA, f"{folder}/versions", ignoreMissingFiles="true")


def latest(spark: SparkSession, folder: str) -> Version:
    row = _kept(spark, folder).orderBy(F.desc("version")).first()
    if row is None:
        return Version()
    return Version(row["version"], row["mark"], tuple(Load(r["name"], r["level"], tuple(r["tables"])) for r in row["loads"]))


def publish(spark: SparkSession, folder: str, version: Version) -> None:
    """One file, so a version appears at once."""
    row = (version.number, version.mark, [(load.name, load.level, list(load.tables)) for load in version.loads])
    rows = spark.createDataFrame([row], _SCHEMA).coalesce(1)
    rows.write.mode("overwrite").parquet(f"{folder}/versions/slot={version.number % KEPT}")


def rows_of(spark: SparkSession, folder: str, table: str, loads: list[Load], schema: str) -> DataFrame:
    """The rows of `table` that the given loads wrote; filters on its folders prune as usual."""
    if not loads:
        return spark.createDataFrame([], schema)
    base = f"{folder}/{table}"
    columns = spark.createDataFrame([], schema).columns
    reader = spark.read.schema(schema).option("basePath", base)
    return reader.parquet(*[f"{base}/load={load.name}" for load in loads]).select(*columns)


def forget(spark: SparkSession, folder: str, tables: list[str]) -> list[str]:
    """Remove the files of loads that no kept version lists: replaced ones and those of runs that died. Not beside a
    running load."""
    listed = {
        r[0] for r in _kept(spark, folder).select(F.explode("loads.name")).distinct().collect()
    }  # at most KEPT lists
    removed = []
    for table in tables:
        for name in folder_names(spark, f"{folder}/{table}"):
            if name.startswith("load=") and name.removeprefix("load=") not in listed:
                remove_folder(spark, f"{folder}/{table}/{name}")
                removed.append(f"{table}/{name}")
    return removed
