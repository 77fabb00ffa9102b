"""Raw transactions derived from the general test tables (see FIXTURES.md, part 5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallylake.config import TRANSACTION_TYPES

# Microseconds since 1970, counted from the fields of `ts`, which has no time zone.
_MICROS = (
    "(unix_date(CAST(ts AS DATE)) * 86400000000L + ((day(ts) * 5) % 24) * 3600000000L + ((hour(ts) * 60 + minute(ts))"
    " * 60000000L + CAST(extract(SECOND FROM ts) * 1000000 AS LONG)) div 24)"
)
_ISO = (
    "concat(CAST(date_add(DATE'1970-01-01', CAST(micros div 86400000000L AS INT)) AS STRING), 'T',"
    " lpad(micros div 3600000000L % 24, 2, '0'), ':', lpad(micros div 60000000L % 60, 2, '0'), ':',"
    " lpad(micros div 1000000L % 60, 2, '0'), '.', lpad(micros div 1000L % 1000, 3, '0'), 'Z')"
)


def _pick(values, index: str) -> str:
    return f"element_at(array({', '.join(repr(v) for v in values)}), CAST({index} AS INT) + 1)"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


_ACCOUNT_ID = "CASE WHEN event_id % 89 = 1 THEN NULL ELSE concat('ACC', user_id div 40) END AS account_id"


def raw_transactions(spark: SparkSession, sf_dir: str, copies: bool = False) -> DataFrame:
    """All events as raw transactions; with `copies`, every 50th event arrives twice."""
    arrivals = "IF(event_id % 50 = 0, array(struct(0 AS copy), struct(1 AS copy)), array(struct(0 AS copy)))"
    # A generator's output is computed once, however many rules refer to it later. Each value has a small one of its own:
    # the JVM never compiles a generated method of more than 8,000 bytes, and so runs it ten times slower.
    base = (
        _events(spark, sf_dir)
        .selectExpr("event_id", "event_type", "user_id", "value", "props", f"inline(array(struct({_MICROS} AS micros)))")
        .selectExpr(
            "event_id", "event_type", "user_id",
            f"inline(array(struct(CAST(get_json_object(props, '$.k') AS INT) AS k, CAST(value AS STRING) AS amount_text, {_ISO} AS iso)))",
        )
        .selectExpr("*", "user_id div 40 AS acct", f"inline({arrivals})" if copies else "0 AS copy")
    )
    return base.selectExpr(
        "'transactions' AS topic",
        "CAST(event_id % 3 AS INT) AS partition",
        "event_id * 2 + copy AS offset",
        "CASE WHEN event_id % 97 = 0 THEN NULL ELSE concat('TXN-', event_id) END AS transaction_id",
        _ACCOUNT_ID,
        "CASE WHEN event_id % 83 = 2 THEN 'TELEPORT_PAYMENT' ELSE "
        f"{_pick(TRANSACTION_TYPES, 'k % 7')} END AS transaction_type",
        "CASE WHEN event_id % 79 = 3 THEN concat('-', amount_text) WHEN event_id % 73 = 4 THEN 'abcdef'"
        " WHEN event_id % 71 = 5 THEN NULL ELSE amount_text END AS amount",
        "'INR' AS currency",
        "CASE WHEN event_id % 67 = 6 THEN 'not-a-real-timestamp' ELSE iso END AS `timestamp`",
        f"{_pick(('MOBILE', 'WEB', 'ATM', 'POS', 'BRANCH', 'UPI'), 'k % 6')} AS channel",
        "CASE WHEN event_id % 61 = 7 THEN 'UNKNOWN_STATE' WHEN event_type = 'error' THEN 'FAILED'"
        " WHEN k % 50 = 1 THEN 'PENDING' WHEN k % 50 = 2 THEN 'REVERSED' ELSE 'SUCCESS' END AS status",
        f"{_pick(('GROCERY', 'FUEL', 'UTILITIES', 'ECOMMERCE'), 'k % 4')} AS merchant_category",
        _pick(("Mumbai", "Delhi", "Bengaluru", "Hyderabad", "Chennai"), "(acct + IF(k % 25 = 0, 1, 0)) % 5")
        + " AS city",
        "concat('DEV-', acct, '-', IF(k % 20 = 0, 1, 0)) AS device_id",
        "'fixture' AS source",
        "CAST(NULL AS STRING) AS _injected_violation",
    )


def account_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference data for accounts: the customer segments."""
    return read_table(spark, sf_dir, "customer").selectExpr(
        "concat('ACC', c_custkey) AS account_id",
        "'UNKNOWN' AS account_type",
        "c_mktsegment AS customer_segment",
    )
