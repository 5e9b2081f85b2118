"""The reading topic (JSON values, no key).

The Kafka connector jar is not part of a plain Spark install; ``read_topic`` and
``write_topic`` only set the format and options. The parse and encode steps are
plain column expressions and run on any source (tests use file streams).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.schema import READING

CORRUPT = "_corrupt_record"
TOPIC = "station-readings"

# ---- fixed values: the producer settings to keep, as Kafka sink options -------------
PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.retries": "3",
    "kafka.max.in.flight.requests.per.connection": "1",
    "kafka.max.request.size": "10485760",
    "kafka.buffer.memory": "33554432",
    "kafka.compression.type": "gzip",
}
# ------------------------------------------------------------------------------------


def read_topic(spark: SparkSession, servers: str, topic: str = TOPIC, starting_offsets: str = "earliest",
               streaming: bool = True, max_offsets: int | None = 5_000_000) -> DataFrame:
    """The topic as a (streaming) DataFrame; committed progress lives in the checkpoint.

    ``max_offsets`` splits a backlog into micro-batches of so many messages; none is left out.
    """
    r = spark.readStream if streaming else spark.read
    if streaming and max_offsets:
        r = r.option("maxOffsetsPerTrigger", max_offsets)
    return (r.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", starting_offsets).load())


def parse_messages(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON values -> reading columns plus event metadata and ``_corrupt_record``.

    Unparsable values keep their text in ``_corrupt_record`` (all fields NULL)
    instead of failing the batch. Kafka metadata (topic, partition, offset,
    timestamp) is kept under ``kafka`` when present.
    """
    schema = T.StructType(READING.fields + [T.StructField(CORRUPT, T.StringType())])
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(F.col(value_col).cast("string"), schema, opts).alias("m")
    meta = [c for c in ("topic", "partition", "offset", "timestamp") if c in raw.columns]
    cols = [parsed]
    if meta:
        cols.append(F.struct(*meta).alias("kafka"))
    out = raw.select(*cols).select("m.*", *(["kafka"] if meta else []))
    return out


def is_corrupt() -> Column:
    return F.col(CORRUPT).isNotNull()


def ingest_time(df: DataFrame) -> Column | None:
    """The record timestamp (Kafka) as the fallback event time, when there is one."""
    return F.col("kafka.timestamp") if "kafka" in df.columns else None


def encode_messages(readings: DataFrame) -> DataFrame:
    """One JSON value per reading, no key."""
    return readings.select(F.to_json(F.struct(*readings.columns)).alias("value"))


def write_topic(messages: DataFrame, servers: str, checkpoint: str, topic: str = TOPIC,
                trigger_seconds: int | None = 60):
    """A03 sink: stream encoded readings to the topic with the producer's settings."""
    w = (messages.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("topic", topic).option("checkpointLocation", checkpoint).options(**PRODUCER_OPTIONS))
    if trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()
