"""Time, window and history features of a transaction.

There is one plan for all accounts, whatever their size: an account is cut into time blocks or into equal shares of
its sorted rows, so none is gathered in one task, and every row costs the same however many rows lie around it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallylake.config import Config, DEFAULT
from tallylake.functions.columns import (
    MONEY, block_of, count_if, money, money_mean, utc_date, utc_hour, utc_minute,
)
from tallylake.sources.store import staged

STATS = (
    "window_txn_count",
    "window_total_amount",
    "window_failed_count",
    "window_distinct_devices",
    "window_distinct_cities",
)
_MICROS = 1_000_000
# Relative standard error of approximate distinct counts.
APPROX_ERROR = 0.05


def time_features(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "event_hour": utc_hour(F.col("event_ts")),
            "event_date": utc_date(F.col("event_ts")),
            "event_minute": utc_minute(F.col("event_ts")),
        }
    )


# --------------------------------------------------------------------------- sliding windows as a table


def sliding_window_stats(df: DataFrame, cfg: Config = DEFAULT, distinct: str = "exact") -> DataFrame:
    """One row per account and sliding window that holds at least one of its transactions.

    Rows are first summed per account, slide, device and city; only those sums are copied into the windows
    that cover them.
    """
    slide = cfg.slide_minutes * 60
    per_window = cfg.window_minutes // cfg.slide_minutes
    pane = block_of(F.unix_seconds("event_ts"), slide) * F.lit(slide)
    panes = (
        df.groupBy("account_id", pane.alias("_pane"), "device_id", "city")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.sum(money(F.col("amount"))).alias("_amount"),
            count_if(F.col("status") == "FAILED").alias("_failed"),
        )
        .withColumn(
            "_start", F.explode(F.array(*[F.col("_pane") - F.lit(i * slide) for i in range(per_window)]))
        )
    )
    how_many = F.count_distinct if distinct == "exact" else lambda c: F.approx_count_distinct(c, APPROX_ERROR)
    return (
        panes.groupBy("account_id", "_start")
        .agg(
            F.sum("_n").alias("window_txn_count"),
            F.sum("_amount").cast("double").alias("window_total_amount"),
            F.sum("_failed").alias("window_failed_count"),
            how_many("device_id").alias("window_distinct_devices"),
            how_many("city").alias("window_distinct_cities"),
        )
        .select(
            "account_id",
            F.timestamp_seconds("_start").alias("window_start"),
            F.timestamp_seconds(F.col("_start") + F.lit(cfg.window_minutes * 60)).alias("window_end"),
            *STATS,
        )
    )


def containment_join(df: DataFrame, windows: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Each transaction with every window of its account that contains it (start <= event_ts < end).

    Windows start on slide boundaries, so the windows over one slide are a short list. The lists are built
    on the (narrow) window side and matched by an equi-join on account and slide; the transactions are
    shuffled once and fan out only after the join.
    """
    slide = cfg.slide_minutes * 60
    covers = F.sequence(
        F.unix_seconds("window_start"), F.unix_seconds("window_end") - F.lit(slide), F.lit(slide).cast("long")
    )
    lists = (
        windows.withColumn("_pane", F.explode(covers))
        .groupBy("account_id", "_pane")
        .agg(F.collect_list(F.struct("window_start", "window_end", *STATS)).alias("_windows"))
    )
    alone = dict(zip(STATS, (F.lit(1), F.col("amount"), F.lit(0), F.lit(1), F.lit(1))))
    placed = df.withColumn("_pane", block_of(F.unix_seconds("event_ts"), slide) * F.lit(slide))
    return (
        placed.join(lists, ["account_id", "_pane"], "left")
        .withColumn("_w", F.explode_outer("_windows"))
        .select(
            *df.columns,
            "_w.window_start",
            "_w.window_end",
            # A transaction without a window row counts for itself.
            *[F.coalesce(F.col("_w")[name], default).alias(name) for name, default in alone.items()],
        )
    )


# --------------------------------------------------------------------------- windows around each row


def frame_stats(df: DataFrame, axis: Column, before: int, after: int, block: int) -> DataFrame:
    """Rows plus count, amount, failures, distinct devices and cities of the account's rows whose `axis`
    (a whole number) lies in [own - before, own + after].

    Rows are shuffled once, by account and block of the axis; a row that the next or the previous block can see
    is copied there. A sum over the window is the difference of two totals that grow with the axis, which Spark
    updates row by row. A value is in the window from `after` before to `before` after each occurrence; where
    these stretches of one value meet they count as one, so distinct values are the stretches that have begun
    minus those that have ended.
    """
    block = max(block, before + after + 1)
    x = F.col("_x")
    placed = (
        df.withColumn("_x", axis)
        .withColumn("_home", block_of(x, block))
        .withColumn("_b", F.explode(F.sequence(block_of(x - F.lit(after), block), block_of(x + F.lit(before), block))))
        .repartition("account_id", "_b")
    )
    counted = {
        "_n": F.lit(1),
        "_amount": money(F.col("amount")),
        "_failed": (F.col("status") == "FAILED").cast("int"),
    }
    begins, ends = {}, {}
    for name in ("device_id", "city"):
        same = Window.partitionBy("account_id", "_b", name).orderBy("_x")
        gap = F.lit(before + after)
        begins[name] = F.col(name).isNotNull() & F.coalesce(x - F.lag("_x").over(same) > gap, F.lit(True))
        ends[name] = F.col(name).isNotNull() & F.coalesce(F.lead("_x").over(same) - x > gap, F.lit(True))
    flagged = placed.withColumns(
        {f"_begins_{n}": c.cast("int") for n, c in begins.items()} | {f"_ends_{n}": c.cast("int") for n, c in ends.items()}
    )
    line = Window.partitionBy("account_id", "_b").orderBy("_x")
    reached = line.rangeBetween(Window.unboundedPreceding, after)
    passed = line.rangeBetween(Window.unboundedPreceding, -before - 1)

    def inside(reach: Column, gone: Column) -> Column:
        return F.coalesce(F.sum(reach).over(reached), F.lit(0)) - F.coalesce(F.sum(gone).over(passed), F.lit(0))

    stats = {
        "window_txn_count": inside(counted["_n"], counted["_n"]),
        "window_total_amount": inside(counted["_amount"], counted["_amount"]).cast("double"),
        "window_failed_count": inside(counted["_failed"], counted["_failed"]),
        "window_distinct_devices": inside(F.col("_begins_device_id"), F.col("_ends_device_id")),
        "window_distinct_cities": inside(F.col("_begins_city"), F.col("_ends_city")),
    }
    return flagged.withColumns(stats).filter("_b = _home").select(*df.columns, *STATS)


def txn_window_stats(df: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """One window per transaction: the earliest sliding window that contains it.

    That window covers the transaction's slide and the ones before it, so it is a range frame over slide
    numbers: no window table, no join, no fan-out.
    """
    slide = cfg.slide_minutes * 60
    back = cfg.window_minutes // cfg.slide_minutes - 1
    axis = block_of(F.unix_seconds("event_ts"), slide)
    return frame_stats(df, axis, back, 0, max(1, cfg.block_seconds // slide))


def centred_window_features(df: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Activity of the account within +- `window_minutes` of each transaction, both ends included."""
    reach = cfg.window_minutes * 60 * _MICROS
    return frame_stats(df, F.unix_micros("event_ts"), reach, reach, cfg.block_seconds * _MICROS)


def location_jump_10m(df: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Flag: the account was seen in two or more cities within the last `location_jump_minutes`."""
    reach = cfg.location_jump_minutes * 60 * _MICROS
    stats = frame_stats(df, F.unix_micros("event_ts"), reach, 0, cfg.block_seconds * _MICROS)
    return stats.withColumn("location_jump_10m", F.col("window_distinct_cities") > 1).select(
        *df.columns, "location_jump_10m"
    )


# --------------------------------------------------------------------------- history


def _trailing(df: DataFrame, rows: int, *partition: str) -> DataFrame:
    """Mean of the previous `rows` amounts from running totals, so a row costs the same at any `rows`."""
    order = Window.partitionBy(*partition).orderBy("event_ts", "transaction_id")
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    totals = df.withColumns(
        {
            "_sum": F.coalesce(F.sum(money(F.col("amount"))).over(past), F.lit(0).cast(MONEY)),
            "_count": F.count("amount").over(past),
        }
    )
    spent = F.col("_sum") - F.coalesce(F.lag("_sum", rows).over(order), F.lit(0).cast(MONEY))
    count = F.col("_count") - F.coalesce(F.lag("_count", rows).over(order), F.lit(0))
    return totals.withColumn(
        "account_rolling_mean_amount", F.try_divide(spent.cast("double"), count.cast("double"))
    ).drop("_sum", "_count")


def tail_arrays(df: DataFrame, rows: int, *partition: str) -> DataFrame:
    """Last `rows` (event_ts, transaction_id, amount) per group, oldest first: at most `rows` per group."""
    latest = Window.partitionBy(*partition).orderBy(F.desc("event_ts"), F.desc("transaction_id"))
    return (
        df.select(*partition, "event_ts", "transaction_id", "amount")
        .withColumn("_n", F.row_number().over(latest))
        .filter(F.col("_n") <= rows)
        .groupBy(*partition)
        .agg(F.sort_array(F.collect_list(F.struct("event_ts", "transaction_id", "amount"))).alias("tail"))
    )


def last_of(array: Column, rows: int) -> Column:
    return F.when(F.size(array) > rows, F.slice(array, -rows, rows)).otherwise(array)


def rolling_mean_amount(
    df: DataFrame, cfg: Config = DEFAULT, stage: Callable[[DataFrame, str], DataFrame] = staged
) -> DataFrame:
    """Mean of the account's previous `trailing_rows` amounts, the current one excluded; NULL for the first.

    The rows, sorted by account and time, are cut into equal shares, whatever their accounts and times; `stage`
    (write to a table and read back) fixes which row is in which share. An account that goes on in the next share
    hands over its last rows.
    """
    size = cfg.trailing_rows
    ranges = df.repartitionByRange("account_id", "event_ts", "transaction_id")
    shares = stage(ranges.withColumn("_b", F.spark_partition_id().cast("long")), "trailing")
    # An account in one share only has nobody to hand rows to, so most accounts drop out here.
    several = (
        shares.groupBy("account_id").agg(F.min("_b").alias("_first"), F.max("_b").alias("_last"))
        .filter("_first < _last").select("account_id")
    )
    # Every share with rows counts, so that many earlier shares always hold enough rows.
    earlier = Window.partitionBy("account_id").orderBy("_b").rowsBetween(-size, -1)
    narrow = shares.select("account_id", "_b", "event_ts", "transaction_id", "amount")
    carried = (
        tail_arrays(narrow.join(several, "account_id", "left_semi"), size, "account_id", "_b")
        .select("account_id", "_b", F.flatten(F.collect_list("tail").over(earlier)).alias("_earlier"))
        .select("account_id", "_b", F.explode(last_of(F.col("_earlier"), size)).alias("_e"))
        .select("account_id", "_b", "_e.*", F.lit(False).alias("_own"))
    )
    merged = shares.withColumn("_own", F.lit(True)).unionByName(carried, allowMissingColumns=True)
    return _trailing(merged, size, "account_id", "_b").filter("_own").select(*df.columns, "account_rolling_mean_amount")


def account_mean_amount(df: DataFrame) -> DataFrame:
    """Mean amount of the whole account, the current row included: summed before the shuffle, then joined back; the
    rows of a large account are split by Spark's skew join."""
    means = df.groupBy("account_id").agg(money_mean(F.col("amount")).alias("account_rolling_mean_amount"))
    return df.join(means, "account_id", "left").select(*df.columns, "account_rolling_mean_amount")


def first_seen_device(df: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Flag: the account has not used this device within the last `new_device_lookback_days`.

    Only the first use in a day can be new, and only the last use of the day before matters to it. So each account,
    device and day is summed up before the shuffle; the few new uses are joined back by transaction id.
    """
    lookback = F.lit(cfg.new_device_lookback_days * 86_400 * _MICROS)
    days = (
        df.filter(F.col("device_id").isNotNull())
        .groupBy("account_id", "device_id", block_of(F.unix_seconds("event_ts"), min(1, cfg.new_device_lookback_days) * 86_400).alias("_day"))
        .agg(F.min(F.struct("event_ts", "transaction_id")).alias("_first"), F.max("event_ts").alias("_last"))
    )
    before = F.lag("_last").over(Window.partitionBy("account_id", "device_id").orderBy("_day"))
    unused = F.unix_micros("_first.event_ts") - F.unix_micros(before) > lookback
    new_uses = (
        days.withColumn("first_seen_device", F.coalesce(unused, F.lit(True)))
        .filter("first_seen_device").select("_first.transaction_id", "first_seen_device")
    )
    return df.join(new_uses, "transaction_id", "left").select(
        *df.columns, F.coalesce("first_seen_device", F.lit(False)).alias("first_seen_device"))
