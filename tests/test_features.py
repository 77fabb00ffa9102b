from __future__ import annotations

import random
import time
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from helpers import at, event, events, rows_of
from tallylake.config import DEFAULT
from tallylake.operators import features
from tallylake.operators.dedup import dedup, duplicates
from tallylake.plans import silver

SHORT = DEFAULT.with_(block_seconds=1, salts=3)
MIDDLE = DEFAULT.with_(block_seconds=700, salts=3)
PLANS = pytest.mark.parametrize("cfg", [DEFAULT, SHORT, MIDDLE], ids=["hours", "shortest", "middle"])


@pytest.fixture(scope="module")
def crowd():
    """Three accounts: one dense, one sparse, one with many rows at one instant; NULL devices and cities."""
    draw = random.Random(7)
    rows = []
    for i in range(260):
        account = draw.choice(["A", "A", "A", "B", "C"])
        if account == "C":
            ts = at("2026-03-15T10:30:00")
        else:
            spread = 1500 if account == "A" else 200_000
            ts = at("2026-03-15T10:00:00") + timedelta(seconds=draw.randrange(spread), milliseconds=draw.choice([0, 500]))
        rows.append(
            (
                f"T{i:04d}", account, draw.randrange(1, 90_000) / 100, draw.choice(["SUCCESS", "FAILED"]),
                draw.choice([None, "D1", "D2", "D3"]), draw.choice([None, "Pune", "Delhi"]), ts,
            )
        )
    return rows


def _stats(rows, seen) -> tuple:
    near = [r for r in rows if seen(r)]
    return (
        len(near),
        round(sum(r[2] for r in near), 2),
        sum(r[3] == "FAILED" for r in near),
        len({r[4] for r in near} - {None}),
        len({r[5] for r in near} - {None}),
    )


def _minute(ts) -> int:
    return int(ts.timestamp()) // 60


@PLANS
def test_txn_window_stats(spark, crowd, cfg):
    found = features.txn_window_stats(events(spark, crowd), cfg)
    expected = [
        (r[0], *_stats(crowd, lambda o: o[1] == r[1] and 0 <= _minute(r[6]) - _minute(o[6]) <= 4)) for r in crowd
    ]
    assert rows_of(found, "transaction_id", *features.STATS) == sorted(expected, key=repr)


@PLANS
def test_centred_window(spark, crowd, cfg):
    found = features.centred_window_features(events(spark, crowd), cfg)
    reach = timedelta(minutes=5)
    expected = [(r[0], *_stats(crowd, lambda o: o[1] == r[1] and abs(o[6] - r[6]) <= reach)) for r in crowd]
    assert rows_of(found, "transaction_id", *features.STATS) == sorted(expected, key=repr)


@PLANS
def test_location_jump(spark, crowd, cfg):
    found = features.location_jump_10m(events(spark, crowd), cfg)
    reach = timedelta(minutes=10)
    expected = [
        (r[0], _stats(crowd, lambda o: o[1] == r[1] and timedelta(0) <= r[6] - o[6] <= reach)[4] > 1) for r in crowd
    ]
    assert rows_of(found, "transaction_id", "location_jump_10m") == sorted(expected, key=repr)


def _expected_means(crowd, size=50):
    means = []
    for r in crowd:
        past = sorted(o[6:] + o[:3] for o in crowd if o[1] == r[1] and (o[6], o[0]) < (r[6], r[0]))[-size:]
        means.append((r[0], round(sum(p[3] for p in past) / len(past), 6) if past else None))
    return sorted(means, key=repr)


def _rounded(found):
    return sorted(
        ((r[0], None if r[1] is None else round(r[1], 6)) for r in found.select(
            "transaction_id", "account_rolling_mean_amount").collect()),
        key=repr,
    )


@PLANS
@pytest.mark.parametrize("size", [3, 50])
def test_rolling_mean(spark, crowd, cfg, size):
    found = features.rolling_mean_amount(events(spark, crowd), cfg.with_(trailing_rows=size))
    assert _rounded(found) == _expected_means(crowd, size)


def test_rolling_mean_in_equal_shares(spark, crowd, tmp_path):
    """Blocks cut by row count also split rows of one instant."""

    def stage(df, name):
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    found = features.rolling_mean_amount(events(spark, crowd).repartition(4), SHORT, stage)
    assert _rounded(found) == _expected_means(crowd)
    blocks = spark.read.parquet(str(tmp_path / "trailing"))
    assert blocks.filter("account_id = 'C'").count() > 20


def test_account_mean(spark, crowd):
    amounts = {}
    for r in crowd:
        amounts.setdefault(r[1], []).append(r[2])
    expected = [(r[0], round(sum(amounts[r[1]]) / len(amounts[r[1]]), 6)) for r in crowd]
    assert _rounded(features.account_mean_amount(events(spark, crowd))) == sorted(expected, key=repr)


@PLANS
def test_first_seen_device(spark, crowd, cfg):
    rows = crowd + [event(900, "2026-04-20T00:00:00", "A"), event(901, "2026-04-21T00:00:00", "A")]
    expected = []
    for r in rows:
        past = [o[6] for o in rows if o[1] == r[1] and o[4] == r[4] and (o[6], o[0]) < (r[6], r[0])]
        new = r[4] is not None and (not past or max(past) < r[6] - timedelta(days=30))
        expected.append((r[0], new))
    found = features.first_seen_device(events(spark, rows), cfg)
    assert rows_of(found, "transaction_id", "first_seen_device") == sorted(expected, key=repr)


def test_sliding_windows_and_containment(spark, crowd):
    df = events(spark, crowd)
    windows = features.sliding_window_stats(df)
    starts = {(r[1], (_minute(r[6]) - k) * 60) for r in crowd for k in range(5)}
    expected = []
    for account, start in starts:
        stats = _stats(crowd, lambda o: o[1] == account and start <= o[6].timestamp() < start + 300)
        expected.append((account, start, *stats))
    seconds = windows.selectExpr("*", "unix_seconds(window_start) AS s")
    assert rows_of(seconds, "account_id", "s", *features.STATS) == sorted(expected, key=repr)
    assert features.sliding_window_stats(df, distinct="approx").count() == len(starts)

    for cfg in (DEFAULT, SHORT):
        joined = features.containment_join(df, windows, cfg)
        assert joined.count() == 5 * len(crowd)
        assert joined.filter("event_ts < window_start OR event_ts >= window_end").count() == 0
        assert rows_of(joined.select("transaction_id").distinct(), "transaction_id") == sorted((r[0],) for r in crowd)


def test_unmatched_transaction_counts_for_itself(spark):
    df = events(spark, [event(1, "2026-03-15T10:00:00", amount=42.0)])
    joined = features.containment_join(df, features.sliding_window_stats(df.limit(0)))
    assert rows_of(joined, "transaction_id", *features.STATS) == [("T0001", 1, 42.0, 0, 1, 1)]


def test_event_on_window_edge(spark):
    df = events(spark, [event(1, "2026-03-15T10:00:00"), event(2, "2026-03-15T10:04:59"), event(3, "2026-03-15T10:05:00")])
    counts = rows_of(features.txn_window_stats(df), "transaction_id", "window_txn_count")
    assert counts == [("T0001", 1), ("T0002", 2), ("T0003", 2)]


def test_time_features(spark):
    row = features.time_features(events(spark, [event(1, "2026-03-15T23:30:00")])).first()
    assert (row["event_hour"], str(row["event_date"]), row["event_minute"]) == (23, "2026-03-15", 30)


def test_dedup_and_duplicates(spark):
    rows = [event(1, "2026-03-15T10:00:00")] * 40 + [event(2, "2026-03-15T10:00:00"), event(2, "2026-03-15T09:00:00", amount=7.0)]
    df = events(spark, rows).repartition(3).selectExpr("*", "0 AS partition", "monotonically_increasing_id() AS offset").cache()
    kept = dedup(df)
    assert rows_of(kept, "transaction_id", "amount") == [("T0001", 100.0), ("T0002", 7.0)]
    dropped = duplicates(df, SHORT)
    assert dropped.count() == 40
    assert kept.select("offset").intersect(dropped.select("offset")).count() == 0
    assert dedup(df.drop("partition", "offset")).count() == 2
    assert duplicates(df.drop("partition", "offset"), SHORT).count() == 40


def test_dedup_keeps_one_row_per_id_before_the_shuffle(spark):
    plan = dedup(events(spark, [event(1, "2026-03-15T10:00:00")]))._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_silver_plans_agree(spark, crowd, tmp_path):
    base = events(spark, crowd + crowd[:30]).selectExpr(
        "*", "date_format(event_ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\") AS event_timestamp"
    )

    def stage(df, name):
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    ordinary = silver.silver_frame(base)
    split = silver.silver_frame(base, SHORT, stage)
    assert ordinary.count() == len(crowd)
    assert ordinary.exceptAll(split).count() == 0 and split.exceptAll(ordinary).count() == 0


def test_a_burst_costs_its_rows(spark):
    """One account with 200,000 rows inside ten minutes, many at one instant."""
    burst = spark.range(200_000).selectExpr(
        "concat('T', id) AS transaction_id", "'A' AS account_id", "1.0 AS amount", "'SUCCESS' AS status",
        "concat('D', id % 50) AS device_id", "concat('C', id % 7) AS city",
        "timestamp_micros(1773000000000000 + (id * 7919 % 600000) * 1000) AS event_ts",
    )
    started = time.monotonic()
    for frame in (features.txn_window_stats(burst), features.centred_window_features(burst)):
        row = frame.agg(F.max("window_txn_count"), F.max("window_distinct_devices"), F.max("window_distinct_cities")).first()
        assert row[0] > 90_000 and row[1:] == (50, 7)
    assert features.location_jump_10m(burst).filter("location_jump_10m").count() > 199_000
    assert features.rolling_mean_amount(burst).agg(F.avg("account_rolling_mean_amount")).first()[0] == 1.0
    assert time.monotonic() - started < 120
