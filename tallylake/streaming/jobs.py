"""Streaming jobs: messages -> Bronze and quarantine; Bronze -> Silver; window statistics.

The jobs call the same operators as batch plans. Each has its own checkpoint and can be stopped and restarted.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tallylake.config import Config, DEFAULT
from tallylake.functions.columns import block_of, count_if, iso_text, money
from tallylake.operators import features, layers, scoring
from tallylake.operators.validation import FLAGS, IMPLAUSIBLE, MALFORMED, failure_reasons
from tallylake.plans.silver import to_silver
from tallylake.schemas import QUARANTINE_SCHEMA, RAW_SCHEMA
from tallylake.sources.payload import parse_payload
from tallylake.sources.store import folder_names, read_or_empty, remove_folder, staged

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

BRONZE_SCHEMA = (
    "topic string, partition int, offset long, "
    + ", ".join(
        f"{name} {'double' if name == 'amount' else 'string'}"
        for name in RAW_SCHEMA.fieldNames()
        if name != "timestamp"
    )
    + ", event_timestamp string, event_ts timestamp, ingestion_timestamp timestamp, ingestion_date date,"
    " pipeline_source string"
)


def use_rocksdb(spark: SparkSession) -> None:
    """Keep streaming state on executor disks. Call before a query is first started."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _run(writer: DataStreamWriter, checkpoint: str, every: str | None) -> DataStreamWriter:
    """Without `every`, process what is there and stop."""
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


# --------------------------------------------------------------------------- messages -> layers


INGEST_SCHEMA = f"value string, failure_reason string, {BRONZE_SCHEMA}, outcome string"
VALID, REJECTED = "valid", "rejected"


def judged(messages: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Messages parsed and judged once: typed columns, the payload, and a `failure_reason` that is NULL for valid ones.

    An event time before 1970, or further ahead than `max_ahead`, is refused: one event of the far future would move the
    watermark past all that follow. The current time is that of the micro-batch, which a replay repeats."""
    parsed = failure_reasons(parse_payload(messages), cfg)
    latest = F.current_timestamp() + F.expr(f"INTERVAL {cfg.max_ahead}")
    plausible = (F.unix_micros("event_ts") >= 0) & (F.col("event_ts") <= latest)
    reason = (
        F.when(F.col("is_malformed"), MALFORMED).when(F.col("failure_reason") != "", F.col("failure_reason"))
        .when(~plausible, IMPLAUSIBLE)
    )
    typed = {"failure_reason": reason, "amount": F.col("amount_value"), "event_timestamp": iso_text(F.col("event_ts"))}
    return parsed.withColumns(typed).drop("amount_value", "timestamp", "failure_reasons", *FLAGS)


def valid_stream(messages: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Typed valid rows of a message stream with a plausible event time."""
    return judged(messages, cfg).filter(F.col("failure_reason").isNull()).drop("value", "is_malformed", "failure_reason")


def start_ingest(
    messages: DataFrame, path: str, checkpoint: str, cfg: Config = DEFAULT, every: str | None = None
) -> StreamingQuery:
    """Every message once, valid or rejected, by outcome and ingestion date: one source, one parse, one decision, so
    that Bronze (`ingested(VALID)`) and quarantine (`ingested(REJECTED)`) together are all messages. The file sink's log
    makes it exactly-once."""
    rows = layers.bronze(judged(messages, cfg), cfg)
    rejected = F.col("failure_reason").isNotNull()
    rows = rows.drop("is_malformed").withColumns(
        {
            "outcome": F.when(rejected, REJECTED).otherwise(VALID),
            # A valid message is all in its columns; of a rejected one the payload is kept.
            "value": F.when(rejected, F.col("value")),
        }
    )
    writer = rows.writeStream.format("parquet").partitionBy("outcome", "ingestion_date")
    return _run(writer, checkpoint, every).start(path)


def ingested(spark: SparkSession, path: str, outcome: str, stream: bool = False) -> DataFrame:
    """Bronze rows (VALID) or dead-letter records (REJECTED) of the table that `start_ingest` writes."""
    reader = (spark.readStream if stream else spark.read).schema(INGEST_SCHEMA)
    rows = reader.parquet(path).filter(F.col("outcome") == outcome)
    if outcome == VALID:
        return rows.drop("value", "failure_reason", "outcome")
    records = rows.select(
        F.col("value").alias("raw_record"), "failure_reason", iso_text(F.col("ingestion_timestamp")).alias("validation_timestamp"),
        F.col("topic").alias("source_topic"), "partition", "offset")
    return records


def start_bronze(
    messages: DataFrame, path: str, checkpoint: str, cfg: Config = DEFAULT, every: str | None = None
) -> StreamingQuery:
    """Append all valid rows, duplicates included, by ingestion date. The file sink's log makes it exactly-once. Beside
    `start_quarantine`, each decides at its own time what lies too far ahead; `start_ingest` decides once for both."""
    rows = layers.bronze(valid_stream(messages, cfg), cfg)
    writer = rows.writeStream.format("parquet").partitionBy("ingestion_date")
    return _run(writer, checkpoint, every).start(path)


def start_quarantine(
    messages: DataFrame, path: str, checkpoint: str, cfg: Config = DEFAULT, every: str | None = None
) -> StreamingQuery:
    """Append a dead-letter record for every malformed or invalid message, and for valid ones whose event time is
    not plausible."""
    rejected = judged(messages, cfg).filter(F.col("failure_reason").isNotNull())
    records = layers.quarantine_records(rejected.select("topic", "partition", "offset", "value", "failure_reason"), cfg)
    return _run(records.writeStream.format("parquet"), checkpoint, every).start(path)


def record_duplicates(
    spark: SparkSession, bronze_path: str, path: str, cfg: Config = DEFAULT, since: str | None = None
) -> int:
    """Append a dead-letter record for each row of Bronze whose transaction id was already taken; the number of new
    records. Bronze keeps duplicates, which the Silver stream drops, so this is a batch job; with `since`, over the ids
    that were ingested since that date, whenever they were taken first. Running it again adds nothing. `path` is a table
    of its own: the folder of a stream's file sink shows only what that stream wrote."""
    rows = spark.read.schema(BRONZE_SCHEMA).parquet(bronze_path)
    if since:
        recent = rows.filter(F.col("ingestion_date") >= F.lit(since).cast("date"))
        rows = rows.join(recent.select("transaction_id").distinct(), "transaction_id", "left_semi")
    found = layers.quarantine_records(layers.duplicate_rows(rows, cfg), cfg)
    position = ["source_topic", "partition", "offset"]
    known = read_or_empty(spark, path, QUARANTINE_SCHEMA).select(*position)
    new = staged(found.join(known, position, "left_anti"), "duplicates")
    new.write.mode("append").parquet(path)
    return new.count()


# --------------------------------------------------------------------------- late rows


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped behind the watermark, over the progress that a running query still reports (the last hundred
    batches); `LateRows` keeps the whole account."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


class LateRows(StreamingQueryListener):
    """Counts the rows that arrive after their watermark and are dropped, in a table that outlives the query.

    Every batch that drops some writes its number below `query=<id>/batch=<n>`, where a batch that is repeated after a
    restart replaces itself. Add it with `spark.streams.addListener`."""

    SCHEMA = "query string, batch long, dropped long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        dropped = sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
        if dropped:
            self.spark.createDataFrame([(dropped,)], "dropped long").coalesce(1).write.mode("overwrite").parquet(
                f"{self.path}/query={progress.id}/batch={progress.batchId}")

    def counted(self) -> DataFrame:
        """(query, batch, dropped), of all that was reported so far."""
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        return read_or_empty(self.spark, self.path, self.SCHEMA)


def late_records(bronze: DataFrame, silver: DataFrame, closed_before: datetime | None = None) -> DataFrame:
    """The Bronze rows whose transaction never reached Silver: those that came after their watermark. Only events before
    `closed_before` (hours that the watermark has passed) are looked at; a copy of a row that did get through is none."""
    if closed_before is not None:
        before = F.col("event_ts") < F.timestamp_micros(F.lit(int(closed_before.timestamp() * 1_000_000)))
        bronze, silver = bronze.filter(before), silver.filter(before)
    return bronze.join(silver.select("transaction_id"), "transaction_id", "left_anti")


def dedup_state(spark: SparkSession, checkpoint: str, steps: int = 1) -> DataFrame:
    """(step, transaction_id, salt, expires): what a `dedup_stream` query remembers, read from its checkpoint. `steps` is
    2 with `stream_dedup_salts`: the salted step is numbered below."""
    found = []
    for step in range(steps):
        stored = spark.read.format("statestore").option("operatorId", step).load(checkpoint)
        names = stored.schema["key"].dataType.fieldNames()
        salt = F.col("key._salt").cast("long") if "_salt" in names else F.lit(None).cast("long")
        found.append(stored.select(
            F.lit(step).alias("step"), F.col("key.transaction_id").alias("transaction_id"), salt.alias("salt"),
            F.col("value.expiresAtMicros").alias("expires")))
    return reduce(DataFrame.unionByName, found)


def bronze_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(BRONZE_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


# --------------------------------------------------------------------------- stateful operators


def dedup_stream(valid: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """First arrival of each transaction id; ids are remembered for the watermark delay.

    A flood of copies of one id is thinned out over `stream_dedup_salts` tasks first.
    """
    rows = valid.withWatermark("event_ts", cfg.watermark)
    if cfg.stream_dedup_salts > 1:
        salt = F.pmod(F.xxhash64("partition", "offset"), F.lit(cfg.stream_dedup_salts))
        rows = rows.withColumn("_salt", salt).dropDuplicatesWithinWatermark(["transaction_id", "_salt"]).drop("_salt")
    return rows.dropDuplicatesWithinWatermark(["transaction_id"])


def window_stats_stream(valid: DataFrame, cfg: Config = DEFAULT, distinct: str = "approx") -> DataFrame:
    """Sliding-window statistics, emitted once a window is closed by the watermark.

    Distinct aggregates are not available on streams. "approx" keeps a sketch of fixed size per window;
    "exact" keeps the values themselves, so use it only where an account has few devices and cities.
    """

    def how_many(name: str):
        if distinct == "approx":
            return F.approx_count_distinct(name)
        return F.size(F.collect_set(name)).cast("long")

    return (
        valid.withWatermark("event_ts", cfg.watermark)
        .groupBy(
            F.window("event_ts", f"{cfg.window_minutes} minutes", f"{cfg.slide_minutes} minutes"), "account_id"
        )
        .agg(
            F.count(F.lit(1)).alias("window_txn_count"),
            F.sum(money(F.col("amount"))).cast("double").alias("window_total_amount"),
            count_if(F.col("status") == "FAILED").alias("window_failed_count"),
            how_many("device_id").alias("window_distinct_devices"),
            how_many("city").alias("window_distinct_cities"),
        )
        .select(
            "account_id",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *features.STATS,
        )
    )


def start_window_stats(
    valid: DataFrame,
    path: str,
    checkpoint: str,
    cfg: Config = DEFAULT,
    distinct: str = "approx",
    every: str | None = None,
) -> StreamingQuery:
    writer = window_stats_stream(valid, cfg, distinct).writeStream.format("parquet")
    return _run(writer, checkpoint, every).start(path)


def with_history(rows: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Rows of a stream, and before them, for each account that has some, its last `trailing_rows` earlier amounts.

    `_current` tells the rows of the stream from these, of which only account, time (`_micros`), id and amount are set.
    The amounts are Spark's own keyed state, so checkpoints, restarts and replays are its business. Rows pass through in
    pieces and only as many as the state holds are kept, so a very busy account needs time in its task, but no memory.
    With `account_state_ttl` accounts are forgotten that were silent for so long, by event time.
    """
    size = cfg.trailing_rows
    known = rows.withColumn("_micros", F.unix_micros("event_ts"))
    columns = known.columns
    keeps = GroupStateTimeout.EventTimeTimeout if cfg.account_state_ttl else GroupStateTimeout.NoTimeout
    keep_ms = _millis(cfg.account_state_ttl) if cfg.account_state_ttl else 0

    def step(key: tuple, pieces: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        newest = list(zip(*state.get)) if state.exists else []
        if newest:
            told = pd.DataFrame(newest, columns=["_micros", "transaction_id", "amount"])
            yield told.assign(account_id=key[0], _current=False).reindex(columns=[*columns, "_current"])
        for piece in pieces:
            yield piece.assign(_current=True)
            last = piece.sort_values(["_micros", "transaction_id"]).tail(size)
            newest = sorted(newest + list(zip(last["_micros"].tolist(), last["transaction_id"].tolist(), last["amount"].tolist())))[-size:]
        state.update(tuple(list(column) for column in zip(*newest)))
        if keep_ms:
            state.setTimeoutTimestamp(max(newest[-1][0] // 1000, state.getCurrentWatermarkMs()) + keep_ms)

    return known.groupBy("account_id").applyInPandasWithState(
        step, T.StructType([*known.schema.fields, T.StructField("_current", T.BooleanType())]),
        "micros array<long>, ids array<string>, amounts array<double>", "append", keeps,
    )


def _millis(interval: str) -> int:
    """Length of an interval of a fixed length, such as "10 minutes"."""
    return int(pd.Timedelta(interval).total_seconds() * 1000)


# --------------------------------------------------------------------------- Silver


class SilverJob:
    """Scores deduplicated rows batch by batch and writes Silver.

    A row is scored on the rows that arrived up to its own batch, so a batch that is replayed gives the same
    rows, and they replace the earlier ones: every output is keyed by the batch. What a batch needs of the past are the
    last amounts of its accounts, which `with_history` keeps, and the rows of its own windows.

    Tables below `folder`:

    * `clean`, by event hour and batch: the deduplicated rows. A batch reads back the hours of its own windows; hours
      that no row after the watermark can reach are removed.
    * `silver`, by event date and batch.

    A row that comes later than a newer row of its account sees that account's stored last amounts only as far
    as they precede it; rows already scored are not revised.
    """

    def __init__(self, spark: SparkSession, folder: str, cfg: Config = DEFAULT):
        # Tables are read with this session; the one of the micro-batch has adaptive execution switched off.
        self.spark = spark
        self.folder = folder
        self.cfg = cfg

    @property
    def silver_path(self) -> str:
        return f"{self.folder}/silver"

    def start(self, valid: DataFrame, checkpoint: str, every: str | None = None) -> StreamingQuery:
        rows = with_history(dedup_stream(valid, self.cfg), self.cfg)
        return _run(rows.writeStream.foreachBatch(self.process), checkpoint, every).start()

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """`batch` as `with_history` gives it."""
        batch = batch.persist()
        try:
            own = batch.filter("_current")
            bounds = own.agg(
                F.unix_seconds(F.min("event_ts")).alias("first"), F.unix_seconds(F.max("event_ts")).alias("last")
            ).first()
            if bounds["first"] is None:
                return
            self._trim(batch_id)
            self._replace(
                features.time_features(own.drop("_current", "_micros"))
                .drop("event_minute")
                .withColumns({"event_hour_key": self._hour_key(F.col("event_ts")), "batch_id": F.lit(batch_id)}),
                "clean",
                "event_hour_key",
            )
            past = batch.filter("NOT _current").select(
                "account_id", F.timestamp_micros("_micros").alias("event_ts"), "transaction_id", "amount")
            history = self._stage(past, "history")
        finally:
            batch.unpersist()

        around = self._clean_rows(bounds["first"], bounds["last"], batch_id)
        windowed = features.txn_window_stats(around, self.cfg).filter(F.col("batch_id") == batch_id)
        known = windowed.withColumn("_current", F.lit(True)).unionByName(
            history.withColumn("_current", F.lit(False)), allowMissingColumns=True
        )
        with_mean = features.rolling_mean_amount(known, self.cfg, self._stage).filter("_current").drop("_current")
        scored = scoring.score(with_mean, self.cfg)
        self._replace(to_silver(scored).withColumn("batch_id", F.lit(batch_id)), "silver", "event_date")

    # -- tables

    def _replace(self, rows: DataFrame, table: str, first_partition: str) -> None:
        """Write the partitions of a batch; a replay of the batch overwrites just those."""
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(first_partition, "batch_id")
            .parquet(f"{self.folder}/{table}")
        )

    def _stage(self, rows: DataFrame, name: str) -> DataFrame:
        """A table that each batch writes again."""
        path = f"{self.folder}/stage/{name}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    @staticmethod
    def _hour_key(ts):
        """Hours since 1970."""
        return block_of(F.unix_seconds(ts), 3600)

    def _clean_rows(self, first: int, last: int, batch_id: int) -> DataFrame:
        """Rows up to this batch that lie in a window of one of its rows; other hours are pruned by their folder."""
        reach = self.cfg.window_minutes * 60
        return (
            self.spark.read.parquet(f"{self.folder}/clean")
            .filter(
                (F.col("batch_id") <= batch_id)
                & F.col("event_hour_key").between((first - reach) // 3600, last // 3600)
                & (F.col("event_ts") >= F.timestamp_seconds(F.lit(first - reach)))
                & (F.col("event_ts") < F.timestamp_seconds(F.lit(last + 1)))
            )
        )

    def _trim(self, batch_id: int) -> None:
        """Remove hours of `clean` that no row of this or a later batch can reach. The batches before this one are
        committed, so the newest hour that they wrote bounds the watermark from below."""
        hours = {int(name.split("=")[1]): f"{self.folder}/clean/{name}" for name in folder_names(self.spark, f"{self.folder}/clean")
                 if name.startswith("event_hour_key=")}
        committed = [h for h, path in hours.items() if any(
            int(n.split("=")[1]) < batch_id for n in folder_names(self.spark, path) if n.startswith("batch_id="))]
        if committed:
            oldest = (max(committed) * 3600 - _millis(self.cfg.watermark) // 1000 - self.cfg.window_minutes * 60) // 3600
            for hour, path in hours.items():
                if hour < oldest:
                    remove_folder(self.spark, path)
