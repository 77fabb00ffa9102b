"""Silver and Gold tables derived from the test tables, built once per session and data folder."""

from __future__ import annotations

import uuid
import zlib
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.config import Config, DEFAULT
from tallylake.operators.validation import valid_rows
from tallylake.plans.gold import Gold, run_gold_load
from tallylake.plans.silver import read_silver, silver_frame, write_silver
from tallylake.sources.payload import as_payload
from tallylake.sources.store import shared_folder
from tallylake.sources.tables import account_reference, raw_transactions


@dataclass(frozen=True)
class Lake:
    spark: SparkSession
    sf_dir: str
    folder: str
    cfg: Config = DEFAULT

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write `df` to a table of its own and read it back."""
        path = f"{self.folder}/stage/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    def build_silver(self) -> str:
        path = f"{self.folder}/silver"
        valid = valid_rows(raw_transactions(self.spark, self.sf_dir, copies=True), self.cfg)
        write_silver(silver_frame(valid, self.cfg, self.stage), path)
        return path

    @cached_property
    def silver_path(self) -> str:
        return self.build_silver()

    @property
    def silver(self) -> DataFrame:
        return read_silver(self.spark, self.silver_path)

    def load_gold(self, folder: str, silver_path: str | None = None) -> dict:
        return run_gold_load(
            self.spark, silver_path or self.silver_path, folder, self.cfg,
            reference=account_reference(self.spark, self.sf_dir),
        )

    @cached_property
    def gold(self) -> Gold:
        self.load_gold(f"{self.folder}/gold")
        return Gold(self.spark, f"{self.folder}/gold")

    @cached_property
    def arrivals(self) -> tuple[Gold, list[dict]]:
        """Silver in three arrivals, dealt by the transaction's number, each with all rows of one late day once more; a
        load after each. Many events so arrive long after later ones were loaded."""
        folder = f"{self.folder}/arrivals"
        third = F.pmod(F.substring("transaction_id", 5, 18).cast("long"), F.lit(3))
        done = []
        for run in range(3):
            rows = self.silver.filter((third == run) | (F.col("event_date") == F.lit("2024-01-29").cast("date")))
            # Read by date, the rows need no shuffle to be written by date.
            rows.write.mode("append").partitionBy("event_date").parquet(f"{folder}/silver")
            done.append(self.load_gold(f"{folder}/gold", f"{folder}/silver"))
        return Gold(self.spark, f"{folder}/gold"), done

    @cached_property
    def messages_path(self) -> str:
        """Messages landed as JSON lines; some payloads are cut off."""
        path = f"{self.folder}/messages"
        messages(self.spark, self.sf_dir).write.mode("overwrite").json(path)
        return path


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, every 50th twice, as messages; one payload in 101 is cut off after 20 characters."""
    whole = as_payload(raw_transactions(spark, sf_dir, copies=True))
    cut = F.expr("(offset div 2) % 101 = 8")
    return whole.withColumn("value", F.when(cut, F.substring("value", 1, 20)).otherwise(F.col("value")))


_LAKES: dict[tuple[str, str], Lake] = {}
_FOLDERS: dict[str, str] = {}


def lake(spark: SparkSession, sf_dir: str) -> Lake:
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        _FOLDERS[app] = shared_folder(spark)
    if (app, sf_dir) not in _LAKES:
        name = f"{app}-{zlib.crc32(sf_dir.encode()):08x}"
        _LAKES[app, sf_dir] = Lake(spark, sf_dir, f"{_FOLDERS[app]}/tallylake/{name}")
    return _LAKES[app, sf_dir]
