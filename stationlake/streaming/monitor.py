"""Delivery counters of streams kept as a table (E24, E23 live).

``ProgressLog`` listens to the progress of all streams of the session and puts one small
JSON file per stream and micro-batch in a folder: the batch, its rows and what the stream
observes (:func:`stationlake.streaming.ingest.observe_quality`, ``observe_cycle``). A
micro-batch that runs again after a restart replaces its own file, so totals don't count
twice.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from stationlake.sources.compaction import _opened

SCHEMA = ("query string, name string, run string, batch_id bigint, at timestamp, input_rows bigint, "
          "quality struct<ok: bigint, bad: bigint>, cycle struct<total_bikes: bigint, total_docks: bigint>")


class ProgressLog(StreamingQueryListener):
    """``start()`` begins, ``stop()`` waits for what is under way and ends."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        fs, root = _opened(path)
        fs.create_dir(root, recursive=True)

    def start(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def stop(self) -> None:
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        observed = {k: {c: v for c, v in row.asDict().items()} for k, row in (p.observedMetrics or {}).items()}
        if p.numInputRows == 0 and not observed:
            return  # an idle trigger
        record = {"query": str(p.id), "name": p.name, "run": str(p.runId), "batch_id": p.batchId, "at": p.timestamp,
                  "input_rows": p.numInputRows, **{k: observed[k] for k in ("quality", "cycle") if k in observed}}
        fs, root = _opened(self.path)
        with fs.open_output_stream(f"{root}/{p.id}-{p.batchId:012d}.json") as out:
            out.write(json.dumps(record, default=str).encode())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def delivery_log(spark: SparkSession, path: str) -> DataFrame:
    """One row per stream and micro-batch."""
    return spark.read.schema(SCHEMA).json(path)


def delivery_counters(log: DataFrame) -> DataFrame:
    """E24 per stream: micro-batches, readings that parsed and that didn't, and their share (percent, 2 decimals)."""
    ok, bad = F.sum("quality.ok"), F.sum("quality.bad")
    return (log.groupBy("name").agg(F.count(F.lit(1)).alias("batches"), F.coalesce(ok, F.lit(0)).alias("ok"),
                                    F.coalesce(bad, F.lit(0)).alias("bad"),
                                    F.round(100 * F.try_divide(bad, ok + bad), 2).alias("bad_percent")))
