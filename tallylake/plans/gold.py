"""Gold: Silver rows -> star schema and KPI tables, safe to run again, at the cost of what is new.

A load reads the Silver files that were written since the last one, keeps the transaction ids that the stored index does
not know, and writes facts, index and partial KPI rows beside what is there. Nothing of it counts until the load is
published, and it is published only if its facts pass the quality gate. KPI tables are sums over partial rows.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.config import Config, DEFAULT
from tallylake.operators import dimensions, facts, id_index, kpis, quality
from tallylake.operators.facts import Dimensions
from tallylake.plans.silver import silver_arrived, silver_recent
from tallylake.schemas import GOLD_SCHEMAS
from tallylake.sources import versions
from tallylake.sources.store import staged
from tallylake.sources.versions import Load, Version

DIMENSIONS = ("dim_account", "dim_date", "dim_transaction_type", "dim_channel", "dim_location")
KPI_TABLES = ("daily_transaction_metrics", "hourly_transaction_metrics", "account_risk_summary")
# In the list of a load's tables: its facts are in partial rows, its own or a later load's.
COUNTED = "counted"
# Partial rows: table -> (of facts, of partial rows).
PARTS = {
    "daily_parts": (kpis.daily_parts, kpis.added_daily),
    "hourly_parts": (kpis.hourly_parts, kpis.added_hourly),
    "account_parts": (kpis.account_parts, kpis.added_account),
    "device_parts": (kpis.device_parts, kpis.added_devices),
}


class Gold:
    """The Gold tables below one folder, as of the version that was the newest when this object was made. One writer
    at a time, any number of readers."""

    def __init__(self, spark: SparkSession, folder: str, version: Version | None = None):
        self.spark, self.folder = spark, folder
        self._version = versions.latest(spark, folder) if version is None else version

    @property
    def version(self) -> Version:
        return self._version

    def stored(self, name: str, loads: list[Load] | None = None) -> DataFrame:
        """A table as it was written by `loads` (without: all that count)."""
        having = self.version.having(name) if loads is None else [load for load in loads if name in load.tables]
        return versions.rows_of(self.spark, self.folder, name, having, GOLD_SCHEMAS[name])

    def table(self, name: str) -> DataFrame:
        """A table, or one of `KPI_TABLES`."""
        if name == "daily_transaction_metrics":
            return kpis.daily_of(self.stored("daily_parts"))
        if name == "hourly_transaction_metrics":
            return kpis.hourly_of(self.stored("hourly_parts"))
        if name == "account_risk_summary":
            return kpis.account_risk_of(self.stored("account_parts"))
        return self.stored(name)

    @property
    def dims(self) -> Dimensions:
        return Dimensions(
            account=self.table("dim_account"),
            date=self.table("dim_date"),
            transaction_type=self.table("dim_transaction_type"),
            channel=self.table("dim_channel"),
            location=self.table("dim_location"),
        )

    @property
    def fact(self) -> DataFrame:
        return self.table("fact_transactions")

    def forget(self) -> list[str]:
        """Remove files that no kept version lists."""
        return versions.forget(self.spark, self.folder, list(GOLD_SCHEMAS))


class GoldLoad(Gold):
    """Gold and, unpublished, one load on top of it."""

    def __init__(self, gold: Gold, level: int = 0):
        super().__init__(gold.spark, gold.folder, gold.version)
        self.base = gold.version
        self.name, self.level, self.written = f"{self.base.number + 1:09d}-{uuid.uuid4().hex[:8]}", level, set()

    @property
    def own(self) -> Load:
        return Load(self.name, self.level, tuple(sorted(self.written)))

    @property
    def version(self) -> Version:
        return Version(self.base.number, self.base.mark, (*self.base.loads, self.own))

    def write(self, name: str, rows: DataFrame, by: str | None = None) -> DataFrame:
        """Rows of this load, written and read back."""
        writer = rows.write.partitionBy(by) if by else rows.write
        writer.parquet(f"{self.folder}/{name}/load={self.name}")
        self.written.add(name)
        return self.stored(name, [self.own])

    def publish(self, mark: datetime | None, instead_of: list[Load] | None = None) -> Gold:
        """From now on readers see this load, without the loads that it replaces."""
        kept = [load for load in self.base.loads if load not in (instead_of or [])]
        own = (self.own,) if self.written else ()
        versions.publish(self.spark, self.folder, Version(self.base.number + 1, mark, (*kept, *own)))
        return Gold(self.spark, self.folder)


def load_dimensions(
    load: GoldLoad, silver: DataFrame, cfg: Config = DEFAULT, reference: DataFrame | None = None
) -> None:
    """Add the members that Silver brings and Gold does not have: one pass over Silver, no write without members."""
    stored = [dimensions.stored_members(name, load.stored(name)) for name in DIMENSIONS]
    known = stored[0]
    for more in stored[1:]:
        known = known.unionByName(more)
    found = staged(dimensions.members(silver).join(known, ["dimension", "member"], "left_anti"), "members")
    fresh = {r[0] for r in found.select("dimension").distinct().collect()}  # at most five
    if not load.base.having("dim_channel"):
        fresh.add("dim_channel")  # it has a member for rows without a channel
    now = load.dims
    make = {
        "dim_date": lambda: dimensions.dim_date_of(found, now.date),
        "dim_account": lambda: dimensions.dim_account(
            dimensions.of_dimension(found, "dim_account"), cfg, now.account, reference),
        "dim_transaction_type": lambda: dimensions.dim_transaction_type(
            dimensions.of_dimension(found, "dim_transaction_type"), cfg, now.transaction_type),
        "dim_channel": lambda: dimensions.dim_channel(dimensions.of_dimension(found, "dim_channel"), cfg, now.channel),
        "dim_location": lambda: dimensions.dim_location(dimensions.of_dimension(found, "dim_location"), cfg, now.location),
    }
    for name in DIMENSIONS:
        if name in fresh:
            load.write(name, make[name]())


def load_facts(
    load: GoldLoad, silver: DataFrame, cfg: Config = DEFAULT, again: DataFrame | None = None
) -> DataFrame:
    """Add the facts whose transaction id is new, with their ids; returns them.

    `again` are further rows, of files that an earlier load has read: of them only those go on whose id is not stored.
    """
    known = None
    if load.base.having("fact_ids"):
        # Ids alone tell which rows are stored already, so these are neither resolved nor shuffled in full.
        read = silver if again is None else silver.unionByName(again)
        maybe = staged(id_index.maybe_known(id_index.ids_of(read, cfg), load.stored("fact_id_bits")), "maybe-known")
        known = staged(id_index.known(maybe, load.stored("fact_ids")), "known")
    if again is not None:
        silver = silver.unionByName(_unstored(again, known))
    elif known is not None and silver.select("transaction_id").join(known, "transaction_id", "left_anti").isEmpty():
        return load.stored("fact_transactions", [])
    first = facts.first_facts(facts.resolve_keys(silver, load.dims, cfg))
    if known is not None:
        first = first.join(known, "transaction_id", "left_anti")
    # Only what facts are made of goes through the shuffle; the order of an id's rows is still told by all columns.
    first = staged(first.select(*[c for c in first.columns if c in facts.FACT_COLUMNS]), "candidates")
    if first.isEmpty():
        return load.stored("fact_transactions", [])
    tops = load.stored("fact_key_tops").groupBy("_bucket").agg(F.max("_highest").alias("_highest"))
    # The rebalance evens out file sizes over busy and quiet days.
    rows = facts.numbered_facts(first, cfg, tops)
    new = load.write("fact_transactions", rows.hint("rebalance", "date_key"), "date_key")
    _write_index(load, new, cfg)
    return new


def _unstored(rows: DataFrame, known: DataFrame | None) -> DataFrame:
    """Rows whose id is not `known`: mostly none, and then whole rows are not read at all."""
    if known is None:
        return rows
    left = staged(rows.select("transaction_id").join(known, "transaction_id", "left_anti").distinct(), "unstored")
    if left.isEmpty():
        return rows.limit(0)
    return rows.join(left.toDF("_id"), F.col("transaction_id").eqNullSafe(F.col("_id")), "left_semi")


def _write_index(load: GoldLoad, rows: DataFrame, cfg: Config) -> None:
    ids = load.write("fact_ids", id_index.ids_of(rows, cfg).repartition("id_part"), "id_part")
    load.write("fact_id_bits", id_index.filter_of(ids, ids.count(), cfg).sort("id_part"))
    load.write("fact_key_tops", dimensions.highest_keys(rows, "transaction_key"))


def load_kpis(load: GoldLoad, cfg: Config = DEFAULT) -> None:
    """Partial KPI rows of all facts that have none yet: those of this load, and those of loads without a refresh."""
    behind = [p for p in load.version.loads if "fact_transactions" in p.tables and COUNTED not in p.tables]
    if behind:
        rows = load.stored("fact_transactions", behind)
        for name, (of_facts, _) in PARTS.items():
            load.write(name, of_facts(rows))
        _mark_counted(load)


def _mark_counted(load: GoldLoad) -> None:
    earlier = [
        Load(p.name, p.level, tuple(sorted({*p.tables, COUNTED})) if "fact_transactions" in p.tables else p.tables)
        for p in load.base.loads
    ]
    load.base = Version(load.base.number, load.base.mark, tuple(earlier))
    load.written.add(COUNTED)


def refresh_kpis(gold: Gold, cfg: Config = DEFAULT) -> Gold:
    """Recompute all partial KPI rows from all facts. Loads need this only to repair."""
    load = GoldLoad(gold)
    for name, (of_facts, _) in PARTS.items():
        load.write(name, of_facts(gold.fact))
    bare = [Load(p.name, p.level, tuple(t for t in p.tables if t not in PARTS)) for p in load.base.loads]
    load.base = Version(load.base.number, load.base.mark, tuple(bare))
    _mark_counted(load)
    return load.publish(gold.version.mark)


def compact(gold: Gold, cfg: Config = DEFAULT) -> Gold:
    """Rewrite the loads of a level into one of the next, once there are `loads_per_level`. So the number of loads, and
    of files per day, grows with the logarithm of the number of loads, and each row is rewritten as often. Readers see
    the old list or the new one."""
    levels = sorted({load.level for load in gold.version.loads})
    for level in levels:
        chosen = [load for load in gold.version.loads if load.level == level]
        if len(chosen) < cfg.loads_per_level:
            continue
        # Facts whose partial rows are still missing wait for a load that makes them.
        if any("fact_transactions" in p.tables and COUNTED not in p.tables for p in chosen):
            continue
        merged = GoldLoad(gold, level + 1)
        names = {name for p in chosen for name in p.tables}
        for name in sorted(names - {"fact_ids", "fact_id_bits", "fact_key_tops", COUNTED}):
            rows = gold.stored(name, chosen)
            if name == "fact_transactions":
                rows = merged.write(name, rows.hint("rebalance", "date_key"), "date_key")
                _write_index(merged, rows, cfg)
            else:
                merged.write(name, PARTS[name][1](rows) if name in PARTS else rows.coalesce(1))
        merged.written.add(COUNTED)
        gold = merged.publish(gold.version.mark, chosen)
        return compact(gold, cfg)
    return gold


def run_gold_load(
    spark: SparkSession,
    silver_path: str,
    gold_folder: str,
    cfg: Config = DEFAULT,
    as_of: datetime | None = None,
    lookback_hours: int | None = None,
    reference: DataFrame | None = None,
) -> dict:
    """Silver rows that arrived since the last load -> dimensions -> facts -> quality gate -> KPI rows, published at once.

    With `lookback_hours` (counted from `as_of`, else from now) the rows of these hours are read instead, whenever they
    arrived. A gate that finds broken facts raises, and nothing of the load counts. A load without new members or facts
    changes nothing; only the mark of what was read moves.
    """
    gold = Gold(spark, gold_folder)
    mark = gold.version.mark
    again = None
    if lookback_hours is None:
        arrived = silver_arrived(spark, silver_path, cfg, mark)
        seen = arrived.agg(F.count(F.lit(1)).alias("n"), F.max("_arrived").alias("newest")).first()
        rows_read, rows = seen["n"], arrived.drop("_arrived")
        fresh = rows
        if mark is not None:
            before = F.col("_arrived") <= F.timestamp_micros(F.lit(round(mark.timestamp() * 1_000_000)))
            fresh, again = arrived.filter(~before).drop("_arrived"), arrived.filter(before).drop("_arrived")
        mark = max((m for m in (mark, seen["newest"]) if m is not None), default=None)
    else:
        fresh = rows = silver_recent(spark, silver_path, cfg, as_of, lookback_hours)
        rows_read = rows.count()
    inserted = 0
    if rows_read:
        load = GoldLoad(gold)
        load_dimensions(load, rows, cfg, reference)
        new = load_facts(load, fresh, cfg, again)
        inserted = new.count()
        if inserted:
            quality.enforce_gate(new, load.table("dim_account"), cfg)
        if cfg.refresh_kpis:
            load_kpis(load, cfg)
        if load.written or mark != gold.version.mark:
            gold = compact(load.publish(mark), cfg)
    if cfg.full_kpi_refresh and gold.version.loads:
        gold = refresh_kpis(gold, cfg)
    metrics = {name: gold.table(name).count() for name in KPI_TABLES} if cfg.refresh_kpis else {}
    return {"rows_read": rows_read, "rows_inserted": inserted, "metrics": metrics}
