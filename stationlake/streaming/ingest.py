"""Structured Streaming jobs.

* ``poll_stream``: status snapshot files -> reading messages (A01, B01 as a
  stream-static join, C01-C05), the poller's work;
* ``enrich_stream``: reading messages -> enriched readings (C06-C15), the ingest
  pipeline's work; the same ``enrich`` runs on batch frames;
* ``write_days``: enriched stream -> day-partitioned Parquet store, each micro-batch
  under a name of its own that a retry replaces (A06, W03);
* ``topic_to_store``, ``snapshots_to_store``: the whole way from raw input to the store,
  with what doesn't parse in a corrupt store;
* ``fan_out``: one stream to the store and to a second sink per micro-batch (W04);
* ``live_hourly``: watermarked 1-hour windows for the live line panel (W05);
  ``hours_to_table``: the same with corrections by late readings, kept as a table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stationlake.functions.columns import count_when, mean_2dp, parse_utc, round2
from stationlake.operators.asof import join_status_info_asof
from stationlake.operators.enrich import enrich, to_reading
from stationlake.operators.join import join_status_info
from stationlake.session import checkpoint_path
from stationlake.sources import kafka
from stationlake.sources.feeds import corrupt_snapshots, read_snapshots, read_status, status_rows
from stationlake.sources.store import BATCH, write_store

DEFAULT_TRIGGER = "60 seconds"  # the poller's cycle
HOURS_BATCH = "batch"           # number of the micro-batch in the table of corrected hours


def _trigger(writer, trigger):
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    if trigger:
        return writer.trigger(processingTime=trigger)
    return writer


def poll_stream(spark: SparkSession, snapshot_dir: str, info: DataFrame,
                max_stations: int | None = None) -> DataFrame:
    """W06 + A01: streaming status snapshots joined to static station info -> readings.

    The info side is a static DataFrame; each micro-batch joins against it without state.
    """
    status = read_status(spark, snapshot_dir, max_stations, streaming=True)
    return to_reading(join_status_info(status, info))


def enrich_stream(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsed messages -> (enriched readings, corrupt messages).

    Event time falls back to the record timestamp when ``collected_at`` does not parse.
    """
    good = messages.filter(~kafka.is_corrupt()).drop(kafka.CORRUPT)
    bad = messages.filter(kafka.is_corrupt()).select(kafka.CORRUPT)
    return enrich(good, kafka.ingest_time(good)), bad


def observe_quality(messages: DataFrame) -> DataFrame:
    """Delivery counters per micro-batch, read from the query progress."""
    return messages.observe("quality", count_when(~kafka.is_corrupt()).alias("ok"),
                            count_when(kafka.is_corrupt()).alias("bad"))


def observe_cycle(readings: DataFrame) -> DataFrame:
    """E23 (live): bikes and docks summed per micro-batch, read from the query progress."""
    return readings.observe("cycle", F.sum("num_bikes_available").alias("total_bikes"),
                            F.sum("num_docks_available").alias("total_docks"))


def _batch_name(name: str, checkpoint: str, batch_id: int) -> str:
    """Name of a micro-batch in the store: the same for every retry, different for every stream."""
    stream = hashlib.sha1(checkpoint.encode()).hexdigest()[:12]
    return f"{name}-{stream}-{batch_id:08d}"


def _each_batch(df: DataFrame, write, name: str, checkpoint: str | None, trigger) -> StreamingQuery:
    """Starts ``write(batch, batch name, batch id)`` for every micro-batch."""
    cp = checkpoint or checkpoint_path(df.sparkSession, name)
    w = (df.writeStream.foreachBatch(lambda batch, i: write(batch, _batch_name(name, cp, i), i))
         .option("checkpointLocation", cp))
    return _trigger(w, trigger).start()


def write_days(enriched: DataFrame, path: str, checkpoint: str | None = None,
               trigger=DEFAULT_TRIGGER, name: str = "store") -> StreamingQuery:
    """A06 + W03: append into day partitions; checkpoint and batch names make restarts exactly-once."""
    return _each_batch(enriched, lambda batch, own, _: write_store(batch, path, own), name, checkpoint, trigger)


def console(enriched: DataFrame, checkpoint: str | None = None, trigger=DEFAULT_TRIGGER,
            rows: int = 2**31 - 1) -> StreamingQuery:
    """Debug output of every row of each micro-batch (the rows pass through the driver)."""
    cp = checkpoint or checkpoint_path(enriched.sparkSession, "console")
    w = (enriched.writeStream.format("console").option("truncate", False).option("numRows", rows)
         .option("checkpointLocation", cp))
    return _trigger(w, trigger).start()


def fan_out(enriched: DataFrame, path: str, second, checkpoint: str | None = None,
            trigger=DEFAULT_TRIGGER, name: str = "fanout") -> StreamingQuery:
    """Each micro-batch goes to the day store and to ``second(batch_df, batch_id)``.

    The batch is persisted once so both sinks read it without recomputing it. If the second
    sink fails, the retry replaces the batch's own rows in the store; the second sink can
    tell a retry by its ``batch_id``.
    """
    def both(batch: DataFrame, own: str, batch_id: int) -> None:
        batch.persist()
        try:
            write_store(batch, path, own)
            second(batch, batch_id)
        finally:
            batch.unpersist()

    return _each_batch(enriched, both, name, checkpoint, trigger)


def _append_corrupt(bad: DataFrame, path: str, own: str) -> None:
    (bad.withColumn(BATCH, F.lit(own)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BATCH).parquet(path))


def topic_to_store(raw: DataFrame, path: str, corrupt_path: str, checkpoint: str | None = None,
                   trigger=DEFAULT_TRIGGER, name: str = "topic") -> StreamingQuery:
    """A02 + W01: raw messages -> parse -> enrich -> day store; unparsable ones to the corrupt store."""
    def write(batch: DataFrame, own: str, _: int) -> None:
        parsed = kafka.parse_messages(batch).persist()
        try:
            enriched, bad = enrich_stream(parsed)
            write_store(enriched, path, own)
            _append_corrupt(bad, corrupt_path, own)
        finally:
            parsed.unpersist()

    return _each_batch(raw, write, name, checkpoint, trigger)


def snapshots_to_store(spark: SparkSession, snapshot_dir: str, info: DataFrame | Callable[[], DataFrame], path: str, corrupt_path: str,
                       checkpoint: str | None = None, trigger=DEFAULT_TRIGGER,
                       max_stations: int | None = None, name: str = "snapshots") -> StreamingQuery:
    """A01 + W06: status snapshot files -> readings -> day store; broken files to the corrupt store.

    ``info``: one frame for the stream's whole life, or a function without arguments that gives
    the versions known now (:func:`stationlake.sources.feeds.read_info_versions`). The function
    is asked for every micro-batch, and each reading meets the version valid at its time.
    """
    def joined(rows: DataFrame) -> DataFrame:
        if isinstance(info, DataFrame):
            return join_status_info(rows, info)
        timed = rows.withColumn("_at", parse_utc("collected_at"))
        return join_status_info_asof(timed, info(), "_at").drop("_at")

    def write(batch: DataFrame, own: str, _: int) -> None:
        batch.persist()
        try:
            rows = status_rows(batch, max_stations)
            write_store(enrich(to_reading(joined(rows))), path, own)
            _append_corrupt(corrupt_snapshots(batch), corrupt_path, own)
        finally:
            batch.unpersist()

    return _each_batch(read_snapshots(spark, snapshot_dir, streaming=True), write, name, checkpoint, trigger)


def live_hourly(enriched: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """1-hour windows of the line panel, final once the watermark passes.

    The state is one row per open hour; readings later than the watermark are
    dropped from this aggregate (they still reach the store).
    """
    return (enriched.withWatermark("ts", watermark)
            .groupBy(F.window("ts", "1 hour").alias("w"))
            .agg(F.count(F.lit(1)).alias("doc_count"),
                 round2(F.avg("num_bikes_available")).alias("avg_bikes"),
                 round2(mean_2dp("occupation_rate")).alias("avg_occupation"))
            .select(F.col("w.start").alias("bucket"), "doc_count", "avg_bikes", "avg_occupation"))


def corrected_hourly(enriched: DataFrame, horizon: str = "30 days") -> DataFrame:
    """W05 with corrections, for update mode: a late reading brings its hour out again, corrected.

    The state is one row per hour of the horizon (720 for 30 days), which is the watermark;
    only readings that are later than that are left out here.
    """
    return live_hourly(enriched, horizon)


def hours_to_table(enriched: DataFrame, path: str, horizon: str = "30 days", checkpoint: str | None = None,
                   trigger=DEFAULT_TRIGGER, name: str = "hours") -> StreamingQuery:
    """The hours that a micro-batch has changed go to the table under its number; a retry replaces them."""
    cp = checkpoint or checkpoint_path(enriched.sparkSession, name)

    def write(batch: DataFrame, i: int) -> None:
        # a shuffle, no coalesce: that would run every partition of the state in the one task that writes the hours
        batch.repartition(1).write.mode("overwrite").parquet(f"{path}/{HOURS_BATCH}={i}")

    return _trigger(corrected_hourly(enriched, horizon).writeStream.outputMode("update").foreachBatch(write)
                    .option("checkpointLocation", cp), trigger).start()


def read_hours(spark: SparkSession, path: str) -> DataFrame:
    """The last state of every hour of the table of :func:`hours_to_table`."""
    rows = spark.read.parquet(path)
    last = F.max_by(F.struct("doc_count", "avg_bikes", "avg_occupation"), HOURS_BATCH).alias("_h")
    return rows.groupBy("bucket").agg(last).select("bucket", "_h.*")


def live_latest(enriched: DataFrame) -> DataFrame:
    """G01 on a stream: each station's latest reading, emitted in update mode.

    The state is one row per station (``max_by`` keeps the newest reading), however old
    a late reading is.
    """
    cols = ["name", "latitude", "longitude", "occupation_rate", "num_bikes_available", "num_docks_available",
            "station_status", "is_installed", "is_renting", "ts"]
    latest = F.max_by(F.struct(*cols), F.struct("ts", "last_reported", "num_bikes_available"))
    return enriched.groupBy("station_id").agg(latest.alias("r")).select("station_id", "r.*")


def write_memory(df: DataFrame, name: str, mode: str = "append", checkpoint: str | None = None,
                 trigger=DEFAULT_TRIGGER) -> StreamingQuery:
    """Debug/dashboard sink: an in-memory table queryable as ``name`` (driver-side, small results only)."""
    cp = checkpoint or checkpoint_path(df.sparkSession, name)
    w = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", cp))
    return _trigger(w, trigger).start()
