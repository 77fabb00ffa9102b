"""Every operator as a registered query over the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake.catalog.lake import Lake, lake, messages
from tallylake.config import DEFAULT, Config
from tallylake.functions.columns import iso_text, utc_date
from tallylake.operators import (
    dedup, dimensions, facts, features, kpis, layers, quality, reports, scoring, validation,
)
from tallylake.operators.facts import Dimensions
from tallylake.plans import silver as silver_plan
from tallylake.sources import payload
from tallylake.sources.store import staged
from tallylake.sources.tables import account_reference, raw_transactions, read_table
from tallylake.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _flat(df: DataFrame) -> DataFrame:
    """Timestamps as ISO text, dates as text, arrays as comma text: nothing depends on a session setting."""
    shown = {
        T.TimestampType: iso_text,
        T.DateType: lambda c: c.cast("string"),
        T.ArrayType: lambda c: F.concat_ws(",", c),
    }
    changed = {
        f.name: shown[type(f.dataType)](F.col(f.name)) for f in df.schema.fields if type(f.dataType) in shown
    }
    return df.withColumns(changed) if changed else df


def query(name: str):
    def register(make: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: _flat(make(spark, sf_dir))
        return make

    return register


def on_raw(name: str):
    """A query over all raw transactions, without copies."""

    def register(make: Callable[[DataFrame], DataFrame]):
        query(name)(lambda spark, sf_dir: make(raw_transactions(spark, sf_dir)))
        return make

    return register


def on_valid(name: str):
    """A query over all valid transactions, without copies."""

    def register(make: Callable[[DataFrame], DataFrame]):
        query(name)(lambda spark, sf_dir: make(validation.valid_rows(raw_transactions(spark, sf_dir))))
        return make

    return register


def on_lake(name: str):
    """A query over the written Silver and Gold tables."""

    def register(make: Callable[[Lake], DataFrame]):
        query(name)(lambda spark, sf_dir: make(lake(spark, sf_dir)))
        return make

    return register


_ID = ("partition", "offset")
_LINEAGE_REST = ("topic", "source", "_injected_violation")

# --------------------------------------------------------------------------- sources and validation


@query("parse_json_payload")
def _(spark, sf_dir):
    return payload.parse_payload(messages(spark, sf_dir)).drop("value", "topic", "_injected_violation")


@on_raw("validate_flags")
def _(raw):
    return validation.validation_flags(raw).select(*_ID, "amount_value", *validation.FLAGS)


@on_raw("failure_reasons")
def _(raw):
    return validation.failure_reasons(raw).select(*_ID, "failure_reasons", "failure_reason")


@on_raw("valid_rows")
def _(raw):
    return validation.valid_rows(raw).drop(*_LINEAGE_REST)


@on_raw("invalid_rows")
def _(raw):
    return validation.invalid_rows(raw).drop(*_LINEAGE_REST, "failure_reasons")


@on_raw("quarantine_reasons")
def _(raw):
    return validation.reason_counts(raw)


@on_raw("quality_rates")
def _(raw):
    return validation.quality_rates(raw)


@on_raw("normalize_categories")
def _(raw):
    shouted = ("transaction_type", "status", "channel", "merchant_category")
    untidy = raw.withColumns({c: F.concat(F.lit(" "), F.lower(c), F.lit("  ")) for c in shouted})
    return validation.normalize_categories(untidy).select(*_ID, *shouted)


@on_valid("bronze_enrich")
def _(valid):
    return layers.bronze(valid).drop(*_LINEAGE_REST, "ingestion_timestamp", "ingestion_date")


@on_raw("quarantine_records")
def _(raw):
    return _record_fields(layers.quarantine_records(validation.invalid_rows(raw)))


def _record_fields(records: DataFrame) -> DataFrame:
    """Quarantine records with three fields read out of the record text."""
    fields = {
        name: F.get_json_object("raw_record", f"$.{name}") for name in ("transaction_id", "amount", "timestamp")
    }
    return records.withColumns(fields).drop("raw_record", "validation_timestamp")


@query("quarantine_malformed")
def _(spark, sf_dir):
    parsed = payload.parse_payload(messages(spark, sf_dir))
    return layers.quarantine_records(layers.malformed_rows(parsed)).drop("validation_timestamp")


@query("quarantine_duplicates")
def _(spark, sf_dir):
    valid = validation.valid_rows(raw_transactions(spark, sf_dir, copies=True))
    return layers.duplicate_rows(valid).select(*_ID, "transaction_id", "failure_reason")


@query("quarantine_replay")
def _(spark, sf_dir):
    records = layers.quarantine_records(validation.invalid_rows(raw_transactions(spark, sf_dir)))
    corrections = (
        read_table(spark, sf_dir, "events")
        .filter("event_id % 73 = 4 OR event_id % 61 = 7")
        .selectExpr(
            "'transactions' AS topic",
            "CAST(event_id % 3 AS INT) AS partition",
            "event_id * 2 AS offset",
            "IF(event_id % 73 = 4, CAST(value AS STRING), NULL) AS amount",
            "IF(event_id % 61 = 7, 'SUCCESS', NULL) AS status",
        )
    )
    return validation.valid_rows(layers.replay(records, corrections)).select(
        *_ID, "transaction_id", "amount", "status"
    )


# --------------------------------------------------------------------------- features and scores


def on_accounts(name: str, cfg: Config = DEFAULT):
    """A query over all valid transactions, without copies, with given settings."""

    def register(make: Callable[[DataFrame, Config], DataFrame]):
        query(name)(lambda spark, sf_dir: make(validation.valid_rows(raw_transactions(spark, sf_dir)), cfg))
        return make

    return register


@on_valid("time_features")
def _(valid):
    return features.time_features(valid).select("transaction_id", "event_hour", "event_date", "event_minute")


@query("dedup_transactions")
def _(spark, sf_dir):
    return dedup.dedup(validation.valid_rows(raw_transactions(spark, sf_dir, copies=True))).drop(*_LINEAGE_REST)


@on_valid("sliding_window_stats")
def _(valid):
    return features.sliding_window_stats(valid)


@on_valid("approx_window_distincts")
def _(valid):
    """Exact distinct counts of each window, and whether the estimates lie within three standard errors of them."""
    names = ("window_distinct_devices", "window_distinct_cities")
    keys = ("account_id", "window_start")
    exact = features.sliding_window_stats(valid).select(*keys, *names)
    estimates = features.sliding_window_stats(valid, distinct="approx").select(
        *keys, *[F.col(n).alias(f"_{n}") for n in names])
    near = F.lit(True)
    for n in names:
        near = near & (F.abs(F.col(f"_{n}") - F.col(n)) <= 3 * features.APPROX_ERROR * F.col(n))
    return exact.join(estimates, list(keys)).select(*keys, *names, near.alias("within_error"))


@on_valid("containment_join")
def _(valid):
    joined = features.containment_join(valid, features.sliding_window_stats(valid))
    return joined.select("transaction_id", "window_start", "window_end", *features.STATS)


# The same operators again, with all accounts cut into the shortest time blocks.
_SPLIT = DEFAULT.with_(block_seconds=1, salts=4)


@on_accounts("txn_window_stats")
@on_accounts("txn_window_stats_split", _SPLIT)
def _(valid, cfg):
    return features.txn_window_stats(valid, cfg).select("transaction_id", *features.STATS)


@on_accounts("centred_window_features")
@on_accounts("centred_window_features_split", _SPLIT)
def _(valid, cfg):
    return features.centred_window_features(valid, cfg).select("transaction_id", *features.STATS)


@on_accounts("rolling_mean_amount")
@on_accounts("rolling_mean_amount_split", _SPLIT)
def _(valid, cfg):
    return features.rolling_mean_amount(valid, cfg).select("transaction_id", "account_rolling_mean_amount")


@on_accounts("account_mean_amount")
@on_accounts("account_mean_amount_split", _SPLIT)
def _(valid, cfg):
    return features.account_mean_amount(valid).select("transaction_id", "account_rolling_mean_amount")


@on_accounts("first_seen_device")
@on_accounts("first_seen_device_split", _SPLIT)
def _(valid, cfg):
    return features.first_seen_device(valid, cfg).select("transaction_id", "first_seen_device")


@on_accounts("location_jump_10m")
@on_accounts("location_jump_10m_split", _SPLIT)
def _(valid, cfg):
    return features.location_jump_10m(valid, cfg).select("transaction_id", "location_jump_10m")


@on_accounts("risk_flags")
def _(valid, cfg):
    flagged = scoring.risk_flags(silver_plan.transaction_features(valid, cfg), cfg)
    return flagged.select("transaction_id", *[flag for _, flag in scoring.SIGNALS.values()])


_SCORES = ("transaction_id", "anomaly_score", "anomaly_reasons", "is_anomaly", "anomaly_band")


@on_accounts("anomaly_scores")
def _(valid, cfg):
    return scoring.score(silver_plan.transaction_features(valid, cfg), cfg).select(*_SCORES)


@on_accounts("anomaly_scores_centred")
def _(valid, cfg):
    return silver_plan.centred_scores(valid, cfg).select(*_SCORES)


def _silver_frame(spark: SparkSession, sf_dir: str, cfg: Config) -> DataFrame:
    valid = validation.valid_rows(raw_transactions(spark, sf_dir, copies=True))
    return silver_plan.silver_frame(valid, cfg, lake(spark, sf_dir).stage)


query("silver_frame")(lambda spark, sf_dir: _silver_frame(spark, sf_dir, DEFAULT))
query("silver_frame_split")(lambda spark, sf_dir: _silver_frame(spark, sf_dir, _SPLIT))


@on_lake("silver_recent")
def _(tables):
    return silver_plan.silver_recent(
        tables.spark, tables.silver_path, as_of=datetime(2024, 1, 30, 6, 30)
    ).select("transaction_id", "event_date", "event_timestamp", "amount", "anomaly_score")


# --------------------------------------------------------------------------- gold


@on_lake("dim_account")
def _(tables):
    reference = account_reference(tables.spark, tables.sf_dir)
    return dimensions.dim_account(tables.silver, reference=reference).drop("created_at", "updated_at")


@on_lake("dim_date")
def _(tables):
    return dimensions.dim_date(tables.silver)


@on_lake("dim_transaction_type")
def _(tables):
    return dimensions.dim_transaction_type(tables.silver)


@on_lake("dim_channel")
def _(tables):
    return dimensions.dim_channel(tables.silver)


@on_lake("dim_location")
def _(tables):
    return dimensions.dim_location(tables.silver)


@on_lake("fact_transactions")
def _(tables):
    keyed = facts.resolve_keys(tables.silver, tables.gold.dims)
    return facts.fact_rows(keyed).drop("ingestion_timestamp")


@on_lake("fact_unresolved")
def _(tables):
    """Some members are withheld from the dimensions."""
    dims = tables.gold.dims
    partial = Dimensions(
        account=dims.account.filter("account_id <> 'ACC1'"),
        date=dims.date.filter("date_key <> 20240105"),
        transaction_type=dims.transaction_type.filter("transaction_type <> 'REFUND'"),
        channel=dims.channel,
        location=dims.location,
    )
    return facts.unresolved(facts.resolve_keys(tables.silver, partial)).select("transaction_id", "skip_reason")


@on_lake("fact_wide")
def _(tables):
    return facts.fact_wide(tables.gold.fact, tables.gold.dims).drop("ingestion_timestamp")


@on_lake("gold_load_summary")
def _(tables):
    """Two loads of the same Silver rows into a new folder; the second one inserts nothing."""
    folder = f"{tables.folder}/gold-{uuid.uuid4().hex}"
    rows = []
    for run in (1, 2):
        done = tables.load_gold(folder)
        rows.append((run, done["rows_read"], done["rows_inserted"], *done["metrics"].values()))
    return tables.spark.createDataFrame(
        rows, "run int, rows_read long, rows_inserted long, daily_rows long, hourly_rows long, account_rows long"
    )


@on_lake("gold_arrivals")
def _(tables):
    """What each of three loads inserts, and how many KPI rows there are after it."""
    rows = [(run + 1, d["rows_inserted"], *d["metrics"].values()) for run, d in enumerate(tables.arrivals[1])]
    return tables.spark.createDataFrame(
        rows, "run int, rows_inserted long, daily_rows long, hourly_rows long, account_rows long")


@on_lake("gold_merged_kpis")
def _(tables):
    """Account summary after three loads, added up from their partial rows."""
    return tables.arrivals[0].table("account_risk_summary").drop("computed_at", "account_key")


@on_lake("daily_metrics")
def _(tables):
    return kpis.daily_metrics(tables.gold.fact).drop("computed_at")


@on_lake("hourly_metrics")
def _(tables):
    return kpis.hourly_metrics(tables.gold.fact).drop("computed_at")


@on_lake("account_risk")
def _(tables):
    return kpis.account_risk(tables.gold.fact).drop("computed_at")


@on_lake("account_activity")
def _(tables):
    return kpis.account_activity(tables.gold.fact)


def _arrived(valid: DataFrame) -> DataFrame:
    """Rows count as ingested a quarter second and up to 976 seconds after the event."""
    millis = F.expr("((offset div 2) % 977) * 1000 + 250")
    return valid.withColumn("ingestion_timestamp", F.timestamp_millis(F.unix_millis("event_ts") + millis))


@on_valid("ingest_latency")
def _(valid):
    return kpis.ingest_latency(_arrived(valid))


@on_valid("latency_of_days")
def _(valid):
    """Latency over ten days from daily sketches, and whether their P95 lies within the stated error of its rank."""
    rows = staged(_arrived(valid).select("event_ts", "ingestion_timestamp"), "arrived")
    days = ("2024-01-08", "2024-01-17")
    found = kpis.latency_between(kpis.latency_parts(rows), *days).first()  # three numbers
    quantile = F.lit(found["quantile_ms"]).cast("long")
    own = rows.filter(utc_date(F.col("event_ts")).between(*[F.lit(d).cast("date") for d in days]))
    millis = F.unix_millis("ingestion_timestamp") - F.unix_millis("event_ts")
    rank = own.agg(
        F.avg((millis <= quantile).cast("double")).alias("above"), F.avg((millis < quantile).cast("double")).alias("below"))
    error = kpis.KLL_RANK_ERROR
    near = (F.col("above") >= 0.95 - error) & (F.col("below") <= 0.95 + error)
    return rank.select(
        F.lit(found["row_count"]).cast("long").alias("row_count"), F.lit(found["avg_latency_ms"]).cast("double").alias("avg_latency_ms"),
        near.alias("within_error"))


# --------------------------------------------------------------------------- data quality


def _damaged(tables: Lake) -> DataFrame:
    """The fact table with broken keys, amounts, flags and repeated ids."""
    n = F.substring("transaction_id", 5, 18).cast("long")
    copies = F.when(n % 233 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        tables.gold.fact.withColumns(
            {
                "account_key": F.when(n % 211 == 0, F.lit(-5).cast("long")).otherwise(F.col("account_key")),
                "date_key": F.when(n % 223 == 0, F.lit(19000101)).otherwise(F.col("date_key")),
                "amount": F.when(n % 227 == 0, -F.col("amount")).otherwise(F.col("amount")),
                "is_anomaly": F.when(n % 229 == 0, 1 - F.col("is_anomaly")).otherwise(F.col("is_anomaly")),
            }
        )
        .withColumn("_copy", F.explode(copies))
        .drop("_copy")
    )


@on_lake("dq_orphan_account")
def _(tables):
    return quality.orphan_accounts(_damaged(tables), tables.gold.dims.account)


@on_lake("dq_orphan_date")
def _(tables):
    return quality.orphan_dates(_damaged(tables), tables.gold.dims.date)


@on_lake("dq_duplicates")
def _(tables):
    return quality.duplicate_ids(_damaged(tables))


@on_lake("dq_invalid_amounts")
def _(tables):
    return quality.invalid_amounts(_damaged(tables))


@on_lake("dq_flag_consistency")
def _(tables):
    return quality.flag_consistency(_damaged(tables))


@on_lake("dq_row_counts")
def _(tables):
    names = (
        "fact_transactions", "dim_account", "dim_date", "daily_transaction_metrics", "account_risk_summary",
    )
    return quality.row_counts({name: tables.gold.table(name) for name in names})


@on_lake("dq_freshness")
def _(tables):
    return quality.freshness(tables.gold.fact)


@on_lake("dq_daily_reconcile")
def _(tables):
    return quality.daily_reconcile(tables.gold.table("daily_transaction_metrics"), _damaged(tables))


@on_lake("dq_gate")
def _(tables):
    return quality.gate(_damaged(tables), tables.gold.dims.account)


# --------------------------------------------------------------------------- reports


@query("volume_mom")
def _(spark, sf_dir):
    """Orders cover several years, so they stand in for the facts."""
    orders = read_table(spark, sf_dir, "orders")
    return reports.volume_mom(
        orders.select(
            F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("date_key"),
            F.col("o_totalprice").alias("amount"),
        )
    )


def _report(name: str, make: Callable[[Lake], DataFrame]) -> None:
    on_lake(name)(make)


_report("kpi_overview", lambda t: reports.kpi_overview(t.gold.fact))
_report("risk_account_counts", lambda t: reports.risk_account_counts(t.gold.table("account_risk_summary")))
_report("daily_trend", lambda t: reports.daily_trend(t.gold.fact, t.gold.dims))
_report(
    "daily_trend_sliced",
    lambda t: reports.daily_trend(t.gold.fact, t.gold.dims, 20240105, 20240124, "REFUND", "WEB"),
)
_report("by_type", lambda t: reports.by_type(t.gold.fact, t.gold.dims))
_report("by_channel", lambda t: reports.by_channel(t.gold.fact, t.gold.dims))
_report("by_city", lambda t: reports.by_city(t.gold.fact, t.gold.dims))
_report("avg_size_by_type_channel", lambda t: reports.avg_size_by_type_channel(t.gold.fact, t.gold.dims))
_report(
    "success_failure_daily",
    lambda t: reports.success_failure_daily(t.gold.table("daily_transaction_metrics"), t.gold.dims),
)
_report(
    "hourly_heatmap", lambda t: reports.hourly_heatmap(t.gold.table("hourly_transaction_metrics"), t.gold.dims)
)
_report("amount_score_buckets", lambda t: reports.amount_score_buckets(t.gold.fact))
_report(
    "top_risk_accounts", lambda t: reports.top_risk_accounts(t.gold.table("account_risk_summary"), t.gold.dims)
)
_report("anomaly_reasons_exploded", lambda t: reports.anomaly_reasons_exploded(t.gold.fact, t.gold.dims))
_report("reason_counts", lambda t: reports.reason_counts(t.gold.fact))
_report(
    "anomaly_trend", lambda t: reports.anomaly_trend(t.gold.table("daily_transaction_metrics"), t.gold.dims)
)
_report("by_segment", lambda t: reports.by_segment(t.gold.fact, t.gold.dims))
_report("burst_accounts", lambda t: reports.burst_accounts(t.gold.fact, t.gold.dims))
_report("device_diversity", lambda t: reports.device_diversity(t.gold.fact))


@on_lake("device_sketches")
def _(tables):
    """Devices of each account over some days, and whether the estimate from stored sketches is within its error."""
    days = F.col("date_key").between(20240105, 20240124)
    exact = tables.gold.fact.filter(days).groupBy("account_key").agg(F.count_distinct("device_id").alias("device_count"))
    guess = kpis.device_counts(tables.gold.stored("device_parts"), 20240105, 20240124)
    guess = guess.select("account_key", F.col("device_count").alias("_guess"))
    near = F.abs(F.col("_guess") - F.col("device_count")) <= kpis.DEVICE_ERROR * F.col("device_count")
    return exact.join(guess, "account_key", "left").select("account_key", "device_count", F.coalesce(near, F.lit(False)).alias("within_error"))


_report("risk_distribution", lambda t: reports.risk_distribution(t.gold.table("account_risk_summary")))
_report("anomaly_by_dim", lambda t: reports.anomaly_by_dim(t.gold.fact, t.gold.dims))


# --------------------------------------------------------------------------- streams


def _run_folder(tables: Lake) -> str:
    return f"{tables.folder}/stream-{uuid.uuid4().hex}"


def _messages(tables: Lake) -> DataFrame:
    return payload.message_file_stream(tables.spark, tables.messages_path)


@on_lake("stream_ingest")
def _(tables):
    folder = _run_folder(tables)
    parsed = payload.parse_payload(_messages(tables)).select(*_ID, "is_malformed", "transaction_id", "amount")
    writer = parsed.writeStream.format("parquet").outputMode("append")
    writer.option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start(
        f"{folder}/out"
    ).awaitTermination()
    return tables.spark.read.parquet(f"{folder}/out")


def _bronze(tables: Lake, folder: str) -> str:
    jobs.start_bronze(_messages(tables), f"{folder}/bronze", f"{folder}/cp-bronze").awaitTermination()
    return f"{folder}/bronze"


@on_lake("bronze_sink")
def _(tables):
    written = tables.spark.read.schema(jobs.BRONZE_SCHEMA).parquet(_bronze(tables, _run_folder(tables)))
    return written.drop(*_LINEAGE_REST, "ingestion_timestamp", "ingestion_date")


@on_lake("stream_restart")
def _(tables):
    """Half of the messages, a stop, the other half: the stream goes on from its checkpoint."""
    folder = _run_folder(tables)
    for half in (0, 1):
        arrived = messages(tables.spark, tables.sf_dir).filter(F.pmod("offset", F.lit(2)) == half)
        arrived.write.mode("append").json(f"{folder}/in")
        source = payload.message_file_stream(tables.spark, f"{folder}/in")
        jobs.start_bronze(source, f"{folder}/bronze", f"{folder}/cp").awaitTermination()
    written = tables.spark.read.schema(jobs.BRONZE_SCHEMA).parquet(f"{folder}/bronze")
    return written.drop(*_LINEAGE_REST, "ingestion_timestamp", "ingestion_date")


@on_lake("quarantine_sink")
def _(tables):
    folder = _run_folder(tables)
    jobs.start_quarantine(_messages(tables), f"{folder}/out", f"{folder}/cp").awaitTermination()
    return tables.spark.read.parquet(f"{folder}/out").drop("raw_record", "validation_timestamp")


@on_lake("silver_sink")
def _(tables):
    folder = _run_folder(tables)
    job = jobs.SilverJob(tables.spark, folder)
    job.start(jobs.bronze_stream(tables.spark, _bronze(tables, folder)), f"{folder}/cp-silver").awaitTermination()
    return silver_plan.read_silver(tables.spark, job.silver_path)


@on_lake("stream_dedup")
def _(tables):
    folder = _run_folder(tables)
    once = jobs.dedup_stream(jobs.valid_stream(_messages(tables)))
    writer = once.writeStream.format("parquet").outputMode("append")
    writer.option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start(
        f"{folder}/out"
    ).awaitTermination()
    return tables.spark.read.parquet(f"{folder}/out").select("transaction_id", "account_id", "amount", "status")


@on_lake("stream_sliding_stats")
def _(tables):
    folder = _run_folder(tables)
    jobs.start_window_stats(
        jobs.valid_stream(_messages(tables)), f"{folder}/out", f"{folder}/cp", distinct="exact"
    ).awaitTermination()
    return tables.spark.read.parquet(f"{folder}/out")


@on_lake("ingest_one_pass")
def _(tables):
    """Every message with its outcome, from the one table that holds Bronze and quarantine."""
    folder = _run_folder(tables)
    jobs.start_ingest(_messages(tables), f"{folder}/in", f"{folder}/cp").awaitTermination()
    bronze, rejected = (jobs.ingested(tables.spark, f"{folder}/in", outcome) for outcome in (jobs.VALID, jobs.REJECTED))
    taken = bronze.select(*_ID, F.lit(jobs.VALID).alias("outcome"), F.lit(None).cast("string").alias("failure_reason"))
    return taken.unionByName(rejected.select(*_ID, F.lit(jobs.REJECTED).alias("outcome"), "failure_reason"))


def _dedup_parts(tables: Lake, folder: str, parts: list, runs: int) -> DataFrame:
    """The dedup stream over messages that arrive in parts: all in one run, or each before a run of its own."""
    for n, part in enumerate(parts):
        messages(tables.spark, tables.sf_dir).filter(part).write.mode("append").json(f"{folder}/in")
        if runs > 1 or n == len(parts) - 1:
            once = jobs.dedup_stream(jobs.valid_stream(payload.message_file_stream(tables.spark, f"{folder}/in")))
            writer = once.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{folder}/cp")
            writer.trigger(availableNow=True).start(f"{folder}/out").awaitTermination()
    return tables.spark.read.parquet(f"{folder}/out")


@on_lake("late_records")
def _(tables):
    """One event in ten arrives after all others: the rows that their watermark keeps out, and the number that the
    listener's table has of them."""
    folder = _run_folder(tables)
    listener = jobs.LateRows(tables.spark, f"{folder}/late")
    tables.spark.streams.addListener(listener)
    try:
        held_back = F.expr("(offset div 2) % 10 = 3")
        silver = _dedup_parts(tables, folder, [~held_back, held_back], 2)
        dropped = listener.counted().agg(F.coalesce(F.sum("dropped"), F.lit(0))).first()[0]
    finally:
        tables.spark.streams.removeListener(listener)
    bronze = jobs.valid_stream(tables.spark.read.schema("topic string, partition int, offset long, value string").json(f"{folder}/in"))
    return jobs.late_records(bronze, silver).select(*_ID, "transaction_id", "event_timestamp", F.lit(dropped).cast("long").alias("counted"))


@on_lake("stream_dedup_restart")
def _(tables):
    """The dedup stream stopped between two batches and resumed: its rows, and whether what it remembers then equals the
    state of one run."""
    early = F.coalesce(F.get_json_object("value", "$.timestamp") < "2024-01-16", F.lit(False))
    folders = [_run_folder(tables) for _ in range(2)]
    rows = [_dedup_parts(tables, folder, [early, ~early], runs) for folder, runs in zip(folders, (2, 1))]
    steps = 2 if tables.cfg.stream_dedup_salts > 1 else 1
    resumed, whole = (jobs.dedup_state(tables.spark, f"{folder}/cp", steps) for folder in folders)
    same = resumed.exceptAll(whole).isEmpty() and whole.exceptAll(resumed).isEmpty() and not whole.isEmpty()
    return rows[0].select("transaction_id", "account_id", "amount", "status", F.lit(same).alias("same_state"))
