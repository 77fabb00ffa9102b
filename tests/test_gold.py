from __future__ import annotations

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import at, rows_of
from tallylake.config import DEFAULT
from tallylake.operators import dimensions, facts, id_index, kpis, quality, reports
from tallylake.operators.skew import lookup
from tallylake.plans import gold as gold_plan
from tallylake.plans.gold import KPI_TABLES, Gold, GoldLoad, compact, load_facts, refresh_kpis, run_gold_load
from tallylake.plans.silver import silver_recent
from tallylake.schemas import SILVER_SCHEMA
from tallylake.sources.store import staged

SPLIT = DEFAULT.with_(broadcast_rows=0, salts=3)


def silver_rows(spark, *changes: dict):
    base = {
        "transaction_id": "TXN-1", "account_id": "ACC-1", "transaction_type": "TRANSFER", "amount": 100.0,
        "currency": "INR", "event_timestamp": "2026-01-01T10:00:00.000Z", "channel": "MOBILE",
        "status": "SUCCESS", "merchant_category": "GROCERY", "city": "Mumbai", "device_id": "DEV-1",
        "anomaly_score": 0, "is_anomaly": False, "anomaly_reasons": "",
    }
    names = SILVER_SCHEMA.fieldNames()
    rows = []
    for change in changes:
        row = {**base, **change}
        row["event_ts"] = at(row["event_timestamp"][:-1])
        row["event_date"] = row["event_ts"].date()
        rows.append(tuple(row.get(name) for name in names))
    return spark.createDataFrame(rows, SILVER_SCHEMA)


TWO = (
    {},
    {
        "transaction_id": "TXN-2", "account_id": "ACC-2", "transaction_type": "DEPOSIT", "city": "Delhi",
        "event_timestamp": "2026-01-01T02:00:00.000Z", "status": "FAILED", "anomaly_score": 5,
        "is_anomaly": True, "anomaly_reasons": "REPEATED_FAILURES,LOCATION_JUMP,UNUSUAL_HOUR",
    },
)


def load(spark, tmp_path, rows, cfg=DEFAULT, **options):
    path = str(tmp_path / "silver")
    rows.write.mode("overwrite").partitionBy("event_date").parquet(path)
    done = run_gold_load(
        spark, path, str(tmp_path / "gold"), cfg, as_of=datetime(2026, 1, 3), lookback_hours=24 * 30, **options
    )
    return Gold(spark, str(tmp_path / "gold")), done


@pytest.mark.parametrize("cfg", [DEFAULT, SPLIT], ids=["broadcast", "shuffled"])
def test_load_twice(spark, tmp_path, cfg):
    gold, done = load(spark, tmp_path, silver_rows(spark, *TWO), cfg)
    assert (done["rows_read"], done["rows_inserted"]) == (2, 2)
    assert list(done["metrics"].values()) == [1, 2, 2]
    assert gold.dims.account.count() == 2
    assert gold.dims.date.count() == 1
    assert gold.dims.transaction_type.count() == 2
    assert gold.dims.location.count() == 2
    daily = gold.table("daily_transaction_metrics").first()
    assert (daily["total_transactions"], daily["anomaly_count"], daily["success_rate"]) == (2, 1, 0.5)
    quality.enforce_gate(gold.fact, gold.dims.account)

    keys = rows_of(gold.fact, "transaction_id", "transaction_key", "account_key")
    gold, done = load(spark, tmp_path, silver_rows(spark, *TWO, {"transaction_id": "TXN-3", "account_id": "ACC-3"}), cfg)
    assert (done["rows_read"], done["rows_inserted"]) == (3, 1)
    assert gold.dims.account.count() == 3
    assert gold.dims.location.count() == 2
    assert [r for r in rows_of(gold.fact, "transaction_id", "transaction_key", "account_key") if r[0] != "TXN-3"] == keys
    fact = gold.fact
    assert fact.select("transaction_key").distinct().count() == fact.count() == 3


def test_same_id_twice_in_one_batch(spark, tmp_path):
    rows = silver_rows(spark, {}, {"amount": 5.0, "event_timestamp": "2026-01-01T11:00:00.000Z"})
    gold, done = load(spark, tmp_path, rows)
    assert done["rows_inserted"] == 1
    assert gold.fact.first()["amount"] == 100.0


def test_missing_channel_and_city(spark, tmp_path):
    gold, _ = load(spark, tmp_path, silver_rows(spark, {"channel": None, "city": None}))
    row = gold.fact.first()
    assert (row["channel_key"], row["location_key"]) == (-1, None)
    wide = facts.fact_wide(gold.fact, gold.dims).first()
    assert (wide["channel"], wide["city"]) == ("UNKNOWN", None)


def test_batch_over_midnight(spark, tmp_path):
    rows = silver_rows(
        spark,
        {"event_timestamp": "2026-01-01T23:00:00.000Z"},
        {"transaction_id": "TXN-2", "event_timestamp": "2026-01-02T01:00:00.000Z"},
    )
    gold, _ = load(spark, tmp_path, rows)
    days = rows_of(gold.dims.date, "date_key", "day_name", "day_of_week", "is_weekend", "month_name", "quarter")
    assert days == [(20260101, "Thursday", 3, 0, "January", 1), (20260102, "Friday", 4, 0, "January", 1)]


def test_empty_silver(spark, tmp_path):
    done = run_gold_load(spark, str(tmp_path / "absent"), str(tmp_path / "gold"))
    assert (done["rows_read"], done["rows_inserted"]) == (0, 0)
    assert list(done["metrics"].values()) == [0, 0, 0]


def test_zero_lookback_is_not_the_default(spark, tmp_path):
    path = str(tmp_path / "silver")
    silver_rows(spark, *TWO).write.partitionBy("event_date").parquet(path)
    assert silver_recent(spark, path, as_of=datetime(2026, 1, 1, 12), lookback_hours=0).count() == 0
    assert silver_recent(spark, path, as_of=datetime(2026, 1, 1, 12)).count() == 2


def test_recent_silver_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "silver")
    silver_rows(spark, *TWO).write.partitionBy("event_date").parquet(path)
    recent = silver_recent(spark, path, as_of=datetime(2026, 1, 1, 12))
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "PushedFilters: [IsNotNull(event_ts), GreaterThanOrEqual(event_ts" in plan


def test_unresolved_rows_are_reported(spark, tmp_path):
    gold, _ = load(spark, tmp_path, silver_rows(spark, *TWO))
    keyed = facts.resolve_keys(
        silver_rows(
            spark, {"transaction_id": "X", "account_id": "NEW", "transaction_type": "REFUND",
                    "event_timestamp": "2030-01-01T00:00:00.000Z"}
        ),
        gold.dims,
    )
    assert rows_of(facts.unresolved(keyed), "transaction_id", "skip_reason") == [
        ("X", "UNRESOLVED_DATE,UNRESOLVED_ACCOUNT,UNRESOLVED_TRANSACTION_TYPE")
    ]
    assert facts.fact_rows(keyed).count() == 0


def test_reference_data_for_accounts(spark, tmp_path):
    reference = spark.createDataFrame([("ACC-1", "SAVINGS", "SME")], "account_id string, account_type string, customer_segment string")
    gold, _ = load(spark, tmp_path, silver_rows(spark, *TWO), reference=reference)
    assert rows_of(gold.dims.account, "account_id", "account_type", "customer_segment") == [
        ("ACC-1", "SAVINGS", "SME"), ("ACC-2", "UNKNOWN", "UNKNOWN")
    ]
    assert rows_of(reports.by_segment(gold.fact, gold.dims), "customer_segment", "total_transactions") == [
        ("SME", 1), ("UNKNOWN", 1)
    ]


def test_gate_reports_what_is_wrong(spark, tmp_path):
    gold, _ = load(spark, tmp_path, silver_rows(spark, *TWO))
    broken = gold.fact.withColumn("account_key", F.lit(-9).cast("long")).withColumn("is_anomaly", F.lit(1))
    with pytest.raises(quality.QualityGateFailed, match="orphaned_account_fk': 4, 'inconsistent_anomaly_flags': 2, 'duplicate_transaction_ids': 2"):
        quality.enforce_gate(broken.union(broken), gold.dims.account)


def test_reconciliation_sees_missing_days(spark):
    fact = spark.createDataFrame([(20260101,), (20260102,)], "date_key int")
    daily = spark.createDataFrame([(20260101, 3), (20260103, 1)], "date_key int, total_transactions long")
    found = quality.daily_reconcile(daily, fact)
    assert rows_of(found, "date_key", "metric_total", "fact_total") == [
        (20260101, 3, 1), (20260102, 0, 1), (20260103, 1, 0)
    ]


def test_month_over_month_with_a_gap(spark):
    fact = spark.createDataFrame(
        [(20260105, 100.0), (20260210, 150.0), (20260405, 10.0)], "date_key int, amount double"
    )
    assert rows_of(reports.volume_mom(fact), "total_volume", "prior_volume", "volume_mom") == [
        (10.0, None, 0.0), (100.0, None, 0.0), (150.0, 100.0, 0.5)
    ]


def test_totals_agree(spark, tmp_path):
    gold, _ = load(spark, tmp_path, silver_rows(spark, *TWO))
    sums = {
        kpi: gold.table(kpi).agg(F.sum("total_transactions")).first()[0]
        for kpi in ("daily_transaction_metrics", "hourly_transaction_metrics", "account_risk_summary")
    }
    assert set(sums.values()) == {gold.fact.count()}


def test_keys_continue_after_existing_ones(spark):
    def members(*names):
        return spark.createDataFrame([(n,) for n in names], "name string")

    first = dimensions.with_keys(members("a", "b", "c"), "name", "k", 0).cache()
    more = dimensions.with_keys(members("d", "e"), "name", "k", 0, dimensions.highest_keys(first, "k"))
    assert rows_of(first, "k", "name") == [(1, "a"), (2, "b"), (3, "c")]
    assert rows_of(more, "k", "name") == [(4, "d"), (5, "e")]
    wide = dimensions.with_keys(members(*"abcdefghij"), "name", "k", 12)
    assert wide.select("k").distinct().count() == 10


def test_joins_with_hot_and_missing_keys(spark):
    rows = spark.createDataFrame(
        [(f"T{i}", "hot" if i % 3 else None if i % 2 else f"k{i}") for i in range(60)], "transaction_id string, k string"
    )
    table = spark.createDataFrame([("hot", 1), ("k0", 2), ("unused", 3)], "k string, v int")
    expected = rows_of(rows.join(table, "k", "left"), "transaction_id", "v")
    assert rows_of(lookup(rows, table, "k", SPLIT), "transaction_id", "v") == expected
    assert rows_of(lookup(rows, table, "k"), "transaction_id", "v") == expected


def test_latency(spark):
    rows = spark.createDataFrame(
        [(at("2026-01-01T00:00:00"), at(f"2026-01-01T00:00:{i:02d}")) for i in range(1, 21)],
        "event_ts timestamp, ingestion_timestamp timestamp",
    )
    row = kpis.ingest_latency(rows).first()
    assert (row["row_count"], row["avg_latency_ms"], row["p95_latency_ms"]) == (20, 10500.0, 19000)


def same_kpis(gold: Gold) -> None:
    """The KPI tables equal a recomputation from all facts."""
    fresh = (kpis.daily_metrics(gold.fact), kpis.hourly_metrics(gold.fact), kpis.account_risk(gold.fact))
    for name, recomputed in zip(KPI_TABLES, fresh):
        table = gold.table(name).drop("computed_at")
        assert rows_of(table, *table.columns) == rows_of(recomputed, *table.columns)


def arrive(spark, tmp_path, rows, cfg=DEFAULT, **options) -> tuple[Gold, dict]:
    """Rows appended to Silver, and a load of what arrived."""
    path = str(tmp_path / "silver")
    rows.write.mode("append").partitionBy("event_date").parquet(path)
    done = run_gold_load(spark, path, str(tmp_path / "gold"), cfg, **options)
    return Gold(spark, str(tmp_path / "gold")), done


def test_load_facts_counts_inserts(spark, tmp_path):
    gold, _ = load(spark, tmp_path, silver_rows(spark, *TWO))
    assert load_facts(GoldLoad(gold), silver_rows(spark, *TWO)).count() == 0


def spoil(folder) -> int:
    files = list(folder.glob("**/part-*.parquet"))
    for file in files:
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
        file.write_bytes(b"spoiled")
    return len(files)


def test_a_load_opens_only_what_it_touches(spark, tmp_path):
    """Old facts, and the ids of other folders, may be unreadable: a load that brings a known and a new id does not look."""
    gold, _ = arrive(spark, tmp_path, silver_rows(spark, *TWO, *({"transaction_id": f"OLD-{i}"} for i in range(40))))
    ids = {r["id_part"] for r in gold.stored("fact_ids").filter("transaction_id = 'TXN-1'").select("id_part").collect()}
    assert spoil(tmp_path / "gold" / "fact_transactions") > 0
    others = [p for p in (tmp_path / "gold" / "fact_ids").glob("load=*/id_part=*") if int(p.name.split("=")[1]) not in ids]
    assert sum(map(spoil, others)) >= 10
    # No overlap is read again, so only the new file counts.
    (tmp_path / "silver").rename(tmp_path / "silver-before")
    later = {"transaction_id": "TXN-NEW", "account_id": "ACC-3", "event_timestamp": "2026-01-02T10:00:00.000Z"}
    gold, done = arrive(spark, tmp_path, silver_rows(spark, {}, later))
    assert (done["rows_read"], done["rows_inserted"]) == (2, 1)
    assert done["metrics"] == {"daily_transaction_metrics": 2, "hourly_transaction_metrics": 3, "account_risk_summary": 3}


def test_kpis_of_many_loads_and_compaction(spark, tmp_path):
    cfg = DEFAULT.with_(loads_per_level=3)
    gold = None
    for i in range(10):
        rows = [{"transaction_id": f"T{i}-{j}", "account_id": f"ACC-{j % 3}", "device_id": f"D{i % 4}-{j}", "amount": 1.0 + i,
                 "event_timestamp": f"2026-01-0{1 + j % 2}T{10 + i:02d}:00:00.000Z"} for j in range(3)]
        before = gold
        gold, done = arrive(spark, tmp_path, silver_rows(spark, *rows, {"transaction_id": f"T{max(i - 1, 0)}-0"}), cfg)
        assert done["rows_inserted"] == 3
        assert before is None or before.fact.count() == 3 * i  # readers of an earlier version are not disturbed
    same_kpis(gold)
    assert gold.fact.count() == gold.fact.select("transaction_key").distinct().count() == 30
    levels = [p.level for p in gold.version.loads]
    assert max(levels) == 2 and max(levels.count(n) for n in levels) < 3
    listed = [p.name for p in gold.version.loads]
    removed = gold.forget()
    assert not removed  # the last versions still list everything
    devices = {r["account_key"]: r["device_count"] for r in kpis.device_counts(gold.stored("device_parts")).collect()}
    assert devices == {r["account_key"]: r["n"] for r in gold.fact.groupBy("account_key").agg(
        F.count_distinct("device_id").alias("n")).collect()}
    one_day = kpis.device_counts(gold.stored("device_parts"), 20260102, 20260102)
    assert {r["device_count"] for r in one_day.collect()} == {4}
    assert [p.name for p in compact(gold, cfg).version.loads] == listed


def test_files_that_no_version_lists_are_removed(spark, tmp_path):
    gold, _ = arrive(spark, tmp_path, silver_rows(spark, *TWO))
    dead = GoldLoad(gold)
    dead.write("dim_location", gold.dims.location)
    assert gold.forget() == [f"dim_location/load={dead.name}"]
    same_kpis(gold)


@pytest.mark.parametrize("stop", ["fact_transactions", "fact_id_bits", "hourly_parts", "publish"])
def test_a_load_that_stopped_leaves_nothing(spark, tmp_path, monkeypatch, stop):
    gold, _ = arrive(spark, tmp_path, silver_rows(spark, {}))
    later = {"transaction_id": "TXN-3", "account_id": "ACC-9", "event_timestamp": "2026-01-02T10:00:00.000Z"}
    write, publish = GoldLoad.write, GoldLoad.publish
    with monkeypatch.context() as patch:
        def dies(self, name, rows, by=None):
            done = write(self, name, rows, by)
            if name == stop:
                raise RuntimeError("stopped")
            return done

        def never(self, *args):
            raise RuntimeError("stopped")

        patch.setattr(GoldLoad, "write", dies)
        patch.setattr(GoldLoad, "publish", never if stop == "publish" else publish)
        with pytest.raises(RuntimeError, match="stopped"):
            arrive(spark, tmp_path, silver_rows(spark, *TWO, later))
    same_kpis(gold)
    assert Gold(spark, gold.folder).fact.count() == 1
    done = run_gold_load(spark, str(tmp_path / "silver"), gold.folder)
    assert done["rows_inserted"] == 2
    gold = Gold(spark, gold.folder)
    same_kpis(gold)
    quality.enforce_gate(gold.fact, gold.dims.account)


def test_kpis_left_out_are_made_up_for(spark, tmp_path):
    lazy = DEFAULT.with_(refresh_kpis=False, loads_per_level=2)
    for i in range(3):
        gold, done = arrive(spark, tmp_path, silver_rows(spark, {"transaction_id": f"T{i}"}), lazy)
        assert done == {"rows_read": i + 1, "rows_inserted": 1, "metrics": {}}
    assert gold.table("account_risk_summary").count() == 0
    gold, _ = arrive(spark, tmp_path, silver_rows(spark, {"transaction_id": "T0"}))
    same_kpis(gold)
    gold, _ = arrive(spark, tmp_path, silver_rows(spark, {"transaction_id": "T9"}), DEFAULT.with_(full_kpi_refresh=True))
    same_kpis(gold)
    same_kpis(refresh_kpis(gold))


def test_rows_that_arrive_long_after_their_event(spark, tmp_path):
    gold, _ = arrive(spark, tmp_path, silver_rows(spark, *TWO))
    late = {"transaction_id": "TXN-LATE", "event_timestamp": "2025-06-01T10:00:00.000Z"}
    gold, done = arrive(spark, tmp_path, silver_rows(spark, late))
    assert done["rows_inserted"] == 1
    gold, done = arrive(spark, tmp_path, silver_rows(spark, late))
    assert done["rows_inserted"] == 0
    assert gold.dims.date.agg(F.min("date_key")).first()[0] == 20250601
    same_kpis(gold)


def test_nothing_new_changes_nothing(spark, tmp_path):
    gold, _ = arrive(spark, tmp_path, silver_rows(spark, *TWO))
    files = sorted(str(p) for p in (tmp_path / "gold").glob("**/part-*"))
    done = run_gold_load(spark, str(tmp_path / "silver"), gold.folder)
    assert (done["rows_read"], done["rows_inserted"]) == (2, 0)
    done = run_gold_load(spark, str(tmp_path / "absent"), gold.folder)
    assert (done["rows_read"], list(done["metrics"].values())) == (0, [1, 2, 2])
    assert sorted(str(p) for p in (tmp_path / "gold").glob("**/part-*")) == files


def test_a_broken_fact_fails_the_run(spark, tmp_path, monkeypatch):
    gold, _ = arrive(spark, tmp_path, silver_rows(spark, {}))
    numbered = facts.numbered_facts
    with monkeypatch.context() as patch:
        patch.setattr(facts, "numbered_facts", lambda *args: numbered(*args).unionAll(numbered(*args)))
        with pytest.raises(quality.QualityGateFailed, match="duplicate_transaction_ids"):
            arrive(spark, tmp_path, silver_rows(spark, *TWO))
    assert Gold(spark, gold.folder).fact.count() == 1  # nothing of the load counts


@pytest.mark.parametrize("n_ids", [10, 3_000_000])
def test_no_stored_id_is_ruled_out(spark, n_ids):
    ids = id_index.ids_of(spark.range(5000).select(F.concat(F.lit("T"), F.col("id")).alias("transaction_id")))
    bits = id_index.filter_of(ids, n_ids).unionByName(id_index.filter_of(ids.limit(10), 10)).cache()
    assert id_index.maybe_known(ids, bits).count() == 5000
    others = id_index.ids_of(spark.range(5000, 10000).select(F.concat(F.lit("T"), F.col("id")).alias("transaction_id")))
    assert id_index.maybe_known(others, bits).count() < 500
    assert id_index.maybe_known(others, bits.limit(0)).count() == 0


def test_money_beyond_measure(spark, tmp_path):
    """Rows of absurd amounts count as rows; totals and means are those of the others."""
    odd = [{"transaction_id": f"ODD-{i}", "amount": a} for i, a in enumerate((1e20, 1e31, 1e33, 1e300))]
    gold, _ = arrive(spark, tmp_path, silver_rows(spark, {"amount": 2e16}, {"transaction_id": "T2", "amount": 0.004}, *odd))
    same_kpis(gold)
    daily = gold.table("daily_transaction_metrics").first()
    assert (daily["total_transactions"], daily["total_volume"], daily["avg_transaction_value"]) == (6, 2e16 + 0.004, (2e16 + 0.004) / 2)
    activity = kpis.account_activity(gold.fact).first()
    assert (activity["total_volume"], activity["avg_amount"]) == (2e16 + 0.004, (2e16 + 0.004) / 2)
    assert reports.volume_mom(gold.fact).first()["total_volume"] == 2e16 + 0.004
    assert reports.by_segment(gold.fact, gold.dims).first()["total_volume"] == 2e16 + 0.004
    small = gold.fact.filter("amount < 1")
    assert {f(small).first()["total_volume"] for f in (kpis.daily_metrics, kpis.account_activity, reports.volume_mom)} == {0.004}


def test_latency_of_any_days_from_stored_sketches(spark):
    rows = spark.range(40_000).select(
        F.timestamp_seconds(F.lit(1_767_225_600) + F.pmod("id", F.lit(5)) * 86_400 + F.lit(60)).alias("event_ts"),
        F.pmod(F.xxhash64("id"), F.lit(100_000)).alias("ms"),
    ).withColumn("ingestion_timestamp", F.timestamp_millis(F.unix_millis("event_ts") + F.col("ms")))
    parts = kpis.latency_parts(rows.filter("ms % 2 = 0")).unionByName(kpis.latency_parts(rows.filter("ms % 2 = 1")))
    row = kpis.latency_between(parts, "2026-01-02", "2026-01-03").first()
    exact = sorted(r["ms"] for r in rows.collect() if r["event_ts"].astimezone().timestamp() // 86_400 % 5 in
                   {(1_767_225_600 + d * 86_400) // 86_400 % 5 for d in (1, 2)})
    assert (row["row_count"], row["avg_latency_ms"]) == (len(exact), pytest.approx(sum(exact) / len(exact)))
    rank = sum(e <= row["quantile_ms"] for e in exact) / len(exact)
    assert abs(rank - 0.95) <= kpis.KLL_RANK_ERROR
    assert tuple(kpis.latency_between(parts, "2030-01-01", "2030-01-02").first()) == (0, None, None)


def test_a_load_stages_only_what_facts_are_made_of(spark, tmp_path, monkeypatch):
    """Wide rows are written once beside the facts, not twice."""
    seen = {}
    monkeypatch.setattr(gold_plan, "staged", lambda df, name: seen.setdefault(name, df.columns) and staged(df, name))
    _, done = load(spark, tmp_path, silver_rows(spark, *TWO))
    assert done["rows_inserted"] == 2
    wide = {name: columns for name, columns in seen.items() if "amount" in columns}
    assert list(wide) == ["candidates"] and set(wide["candidates"]) <= set(facts.FACT_COLUMNS)
    _, done = load(spark, tmp_path, silver_rows(spark, *TWO, {"transaction_id": "TXN-3"}))
    assert done["rows_inserted"] == 1


def test_rows_read_again_are_not_resolved_again(spark, tmp_path, monkeypatch):
    """Of files read before, only rows whose id is not stored go on to the dimension keys, and they do."""
    arrive(spark, tmp_path, silver_rows(spark, *TWO))
    resolved, resolve = [], facts.resolve_keys

    def counted(silver, *args):
        resolved.append(rows_of(silver, "transaction_id"))
        return resolve(silver, *args)

    monkeypatch.setattr(facts, "resolve_keys", counted)
    _, done = arrive(spark, tmp_path, silver_rows(spark, {}, {"transaction_id": "TXN-3"}))
    assert (done["rows_read"], done["rows_inserted"]) == (4, 1)
    assert resolved == [[("TXN-1",), ("TXN-3",)]]
    # A file that could not be seen when later ones were read.
    late = tmp_path / "late"
    silver_rows(spark, {"transaction_id": "TXN-4"}, {"transaction_id": None}, {"transaction_id": "TXN-2"}).write.partitionBy("event_date").parquet(str(late))
    day = tmp_path / "silver" / "event_date=2026-01-01"
    hour = max(f.stat().st_mtime for f in day.glob("part-*")) - 3600
    for file in list(late.glob("event_date=*/part-*.parquet")):
        moved = file.rename(day / file.name)
        os.utime(moved, (hour, hour))
    gold, done = arrive(spark, tmp_path, silver_rows(spark, {"transaction_id": "TXN-5"}))
    assert (done["rows_read"], done["rows_inserted"]) == (8, 3)
    assert resolved[1] == [("TXN-4",), ("TXN-5",), (None,)]
    assert rows_of(gold.fact, "transaction_id") == [("TXN-1",), ("TXN-2",), ("TXN-3",), ("TXN-4",), ("TXN-5",), (None,)]
    same_kpis(gold)
