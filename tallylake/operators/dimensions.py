"""Star-schema dimensions: new members only, with stable surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake.config import Config, DEFAULT
from tallylake.functions.columns import key_of_date, utc_date

UNKNOWN_KEY = -1
UNKNOWN = "UNKNOWN"
# A surrogate key is (hash bucket << RANK_BITS) + rank inside the bucket.
RANK_BITS = 40


def _bucket(natural: Column, bits: int) -> Column:
    """First `bits` bits of the MD5 of the natural key."""
    return F.shiftright(F.conv(F.substring(F.md5(natural), 1, 4), 16, 10).cast("long"), 16 - bits)


def highest_keys(rows: DataFrame, key: str) -> DataFrame:
    """(_bucket, _highest): the highest key in each hash bucket."""
    return (
        rows.filter(F.col(key) >= 0)
        .groupBy(F.shiftright(F.col(key), RANK_BITS).alias("_bucket"))
        .agg(F.max(key).alias("_highest"))
    )


def with_keys(new: DataFrame, natural: str, key: str, bits: int, highest: DataFrame | None = None) -> DataFrame:
    """Number `new` rows (unique on `natural`), after the `highest_keys` of the rows that are there.

    Ranks are taken per hash bucket, so no single task sees all members. Keys are unique and repeatable;
    they are not consecutive across buckets. At most 2**bits highest keys are broadcast.
    """
    ranked = new.withColumn("_bucket", _bucket(F.col(natural), bits)).withColumn(
        "_rank", F.row_number().over(Window.partitionBy("_bucket").orderBy(natural))
    )
    base = F.shiftleft(F.col("_bucket"), RANK_BITS)
    if highest is None:
        return ranked.withColumn(key, base + F.col("_rank")).drop("_bucket", "_rank")
    return (
        ranked.join(F.broadcast(highest), "_bucket", "left")
        .withColumn(key, F.coalesce(F.col("_highest"), base) + F.col("_rank"))
        .drop("_bucket", "_rank", "_highest")
    )


def _members(
    silver: DataFrame, natural: str, key: str, cfg: Config, existing: DataFrame | None, bits: int | None = None
) -> DataFrame:
    """Distinct non-NULL values of a Silver column that `existing` does not hold yet, keyed."""
    found = silver.select(natural).filter(F.col(natural).isNotNull()).distinct()
    if existing is not None:
        found = found.join(existing.select(natural), natural, "left_anti")
    highest = None if existing is None else highest_keys(existing, key)
    return with_keys(found, natural, key, cfg.dimension_key_bits if bits is None else bits, highest)


# Where a member of each dimension comes from: Silver column, key column.
NATURAL = {
    "dim_account": "account_id",
    "dim_transaction_type": "transaction_type",
    "dim_channel": "channel",
    "dim_location": "city",
}


def members(silver: DataFrame) -> DataFrame:
    """(dimension, member): what all dimensions need of Silver, in one pass."""
    found = [F.struct(F.lit(table).alias("dimension"), F.col(column).alias("member")) for table, column in NATURAL.items()]
    day = utc_date(F.col("event_ts")).cast("string")
    found.append(F.struct(F.lit("dim_date").alias("dimension"), day.alias("member")))
    return silver.select(F.inline(F.array(*found))).filter(F.col("member").isNotNull()).distinct()


def of_dimension(found: DataFrame, table: str) -> DataFrame:
    """The `members` of one dimension, as a column of Silver."""
    return found.filter(F.col("dimension") == table).select(F.col("member").alias(NATURAL[table]))


def stored_members(table: str, stored: DataFrame) -> DataFrame:
    """A stored dimension in the form of `members`."""
    member = F.col("full_date").cast("string") if table == "dim_date" else F.col(NATURAL[table])
    return stored.select(F.lit(table).alias("dimension"), member.alias("member"))


def dim_account(
    silver: DataFrame,
    cfg: Config = DEFAULT,
    existing: DataFrame | None = None,
    reference: DataFrame | None = None,
) -> DataFrame:
    """New accounts. Type and segment come from `reference` (unique account_id) where it knows them."""
    keyed = _members(silver, "account_id", "account_key", cfg, existing)
    if reference is None:
        account_type = segment = F.lit(UNKNOWN)
    else:
        keyed = keyed.join(reference.select("account_id", "account_type", "customer_segment"), "account_id", "left")
        account_type = F.coalesce("account_type", F.lit(UNKNOWN))
        segment = F.coalesce("customer_segment", F.lit(UNKNOWN))
    return keyed.select(
        "account_key",
        "account_id",
        account_type.alias("account_type"),
        segment.alias("customer_segment"),
        F.current_timestamp().alias("created_at"),
        F.current_timestamp().alias("updated_at"),
    )


def calendar(bounds: DataFrame) -> DataFrame:
    """One row per calendar day from `first_day` to `last_day` of the one-row input."""
    days = bounds.filter(F.col("first_day").isNotNull()).select(
        F.explode(F.sequence("first_day", "last_day", F.expr("INTERVAL 1 DAY"))).alias("full_date")
    )
    weekday = F.weekday("full_date")
    return days.select(
        key_of_date(F.col("full_date")).alias("date_key"),
        "full_date",
        F.day("full_date").alias("day"),
        F.month("full_date").alias("month"),
        F.date_format("full_date", "MMMM").alias("month_name"),
        F.quarter("full_date").alias("quarter"),
        F.year("full_date").alias("year"),
        weekday.alias("day_of_week"),
        F.date_format("full_date", "EEEE").alias("day_name"),
        (weekday >= 5).cast("int").alias("is_weekend"),
    )


def dim_date(silver: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """All days between the first and the last Silver event."""
    return days_between(
        silver.agg(
            utc_date(F.min("event_ts")).alias("first_day"), utc_date(F.max("event_ts")).alias("last_day")
        ),
        existing,
    )


def dim_date_of(found: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """`dim_date` of the days among `members`."""
    day = F.col("member").cast("date")
    own = found.filter("dimension = 'dim_date'")
    return days_between(own.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day")), existing)


def days_between(bounds: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    days = calendar(bounds)
    return days if existing is None else days.join(existing.select("date_key"), "date_key", "left_anti")


def dim_transaction_type(
    silver: DataFrame, cfg: Config = DEFAULT, existing: DataFrame | None = None
) -> DataFrame:
    # Validation admits only the configured types, so one bucket is enough and keys count from 1.
    return _members(silver, "transaction_type", "transaction_type_key", cfg, existing, bits=0).select(
        "transaction_type_key", "transaction_type"
    )


def dim_channel(silver: DataFrame, cfg: Config = DEFAULT, existing: DataFrame | None = None) -> DataFrame:
    """Channels, and the member that stands for a missing one (channel is not a required field)."""
    found = _members(silver, "channel", "channel_key", cfg, existing).select("channel_key", "channel")
    unknown = silver.sparkSession.range(1).select(
        F.lit(UNKNOWN_KEY).cast("long").alias("channel_key"), F.lit(UNKNOWN).alias("channel")
    )
    # A channel that is literally called UNKNOWN is that same member.
    found = found.filter(F.col("channel") != UNKNOWN)
    if existing is not None:
        unknown = unknown.join(existing.select("channel_key"), "channel_key", "left_anti")
    return found.unionByName(unknown)


def dim_location(silver: DataFrame, cfg: Config = DEFAULT, existing: DataFrame | None = None) -> DataFrame:
    """Cities; the region is not part of the stream, so a city is known once whatever its region."""
    known = None if existing is None else existing.select("location_key", "city").distinct()
    return _members(silver, "city", "location_key", cfg, known).select(
        "location_key", "city", F.lit(None).cast(T.StringType()).alias("region")
    )
