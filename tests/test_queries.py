"""Every registered query on the smallest test tables: equal to its SQL, and without forbidden joins."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_points

SF = "/root/testdata/sf0.001"
TABLES = ("events", "customer", "orders")
from tallylake.catalog.oracles import ORACLES  # noqa: E402
from tallylake.catalog.queries import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_registry():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


# Streams, repeated loads and the plans for hot accounts have tests of their own.
SLOW = {"stream_ingest", "bronze_sink", "quarantine_sink", "silver_sink", "stream_dedup", "stream_sliding_stats",
        "gold_load_summary", "stream_restart"}


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW and not n.endswith("_split")])
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert forbidden not in plan
    columns = sorted(df.columns)
    ours = Counter(tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    assert ours
    if name in ORACLES:
        result = duck.sql(ORACLES[name])
        assert sorted(result.columns) == columns
        theirs = Counter(result.project(", ".join(f'"{c}"' for c in columns)).fetchall())
        assert ours == theirs


def test_entry(spark):
    row = entry_points.entry(spark).first()
    assert row["risk_band"] in ("NORMAL", "WATCH", "ANOMALY")


@pytest.mark.parametrize("name", ["valid_rows", "time_features", "silver_frame", "hourly_metrics"])
def test_result_does_not_depend_on_the_session_time_zone(spark, duck, name):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        df = QUERIES[name](spark, SF)
        columns = sorted(df.columns)
        theirs = duck.sql(ORACLES[name]).project(", ".join(f'"{c}"' for c in columns)).fetchall()
        assert Counter(tuple(r) for r in df.select(*columns).collect()) == Counter(theirs)
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Kolkata"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
