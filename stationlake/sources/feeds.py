"""Station feed snapshots (JSON documents with a ``data.stations`` list).

The reference polls two HTTP feeds; here each poll result is a file dropped in a
directory, read in batch or as a file stream with the same code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.functions.columns import iso_utc, utc_text
from stationlake.operators.asof import versions
from stationlake.operators.join import dedup_last
from stationlake.schema import INFO_FEED, STATUS_FEED

CORRUPT = "_corrupt_record"


def _snapshots(spark: SparkSession, schema, path: str, streaming: bool) -> DataFrame:
    """Snapshot files parsed whole, with ``_file`` and ``_corrupt_record`` (the text of a file that doesn't parse).

    The text is parsed as a column: every field counts for "corrupt", whichever ones a query reads.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    r = spark.readStream.option("maxFilesPerTrigger", 1000) if streaming else spark.read
    parsed = F.from_json("value", with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return (r.option("wholetext", True).text(path)
            .select(parsed.alias("s"), F.col("_metadata.file_path").alias("_file")).select("s.*", "_file"))


def corrupt_snapshots(feed: DataFrame) -> DataFrame:
    """Side output: file and text of snapshots that are broken or hold a field of a wrong type."""
    return feed.filter(F.col(CORRUPT).isNotNull()).select(F.col("_file").alias("file"), F.col(CORRUPT).alias("value"))


def unnest_stations(feed: DataFrame, max_stations: int | None = None, with_position: bool = False) -> DataFrame:
    """Explode ``data.stations``; keep only the first ``max_stations`` of each snapshot.

    ``slice`` before the explode keeps the feed order (a ``limit`` would not).
    ``None`` or 0 means no cap. ``with_position`` adds the index in the list.
    """
    stations = F.col("data.stations")
    if max_stations:
        stations = F.slice(stations, 1, max_stations)
    cols = [c for c in feed.columns if c != "data"]
    if with_position:
        return feed.select(*cols, F.posexplode(stations).alias("pos", "s")).select(*cols, "pos", "s.*")
    return feed.select(*cols, F.explode(stations).alias("s")).select(*cols, "s.*")


def status_rows(feed: DataFrame, max_stations: int | None = None) -> DataFrame:
    """Whole status snapshots -> one row per station per snapshot, with ``collected_at``.

    ``collected_at`` is the snapshot's own ``last_updated`` when present, else the
    time the rows are read (one value per micro-batch in a stream).
    """
    good = feed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, "_file")
    stamp = F.coalesce(iso_utc(utc_text(F.timestamp_seconds("last_updated"))), iso_utc(utc_text(F.current_timestamp())))
    return unnest_stations(good.withColumn("collected_at", stamp), max_stations).drop("last_updated")


def read_snapshots(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Status snapshot files, broken ones included (:func:`corrupt_snapshots`, :func:`status_rows`)."""
    return _snapshots(spark, STATUS_FEED, path, streaming)


def read_status(spark: SparkSession, path: str, max_stations: int | None = None,
                streaming: bool = False) -> DataFrame:
    """Rows of the whole status snapshots; broken ones are left to :func:`corrupt_snapshots`."""
    return status_rows(read_snapshots(spark, path, streaming), max_stations)


def read_info_versions(spark: SparkSession, path: str) -> DataFrame:
    """Information snapshots -> a row per station and interval in which its entry stayed the same.

    For :func:`stationlake.operators.asof.join_status_info_asof`. A snapshot without
    ``last_updated`` counts as the oldest.
    """
    feed = _snapshots(spark, INFO_FEED, path, False).filter(F.col(CORRUPT).isNull()).drop(CORRUPT, "_file")
    rows = unnest_stations(feed.withColumn("_seen", F.timestamp_seconds(F.coalesce("last_updated", F.lit(0)))))
    return versions(rows.select("station_id", "_seen", "name", "lat", "lon", "capacity"), "station_id", "_seen")


def read_info(spark: SparkSession, path: str) -> DataFrame:
    """Information snapshot(s) -> one row per station; a repeated id keeps its last entry."""
    feed = _snapshots(spark, INFO_FEED, path, False).filter(F.col(CORRUPT).isNull()).drop(CORRUPT, "_file")
    rows = unnest_stations(feed.withColumn("_snap", F.coalesce("last_updated", F.lit(0))), with_position=True)
    return dedup_last(rows.drop("last_updated"), "station_id", "_snap", "pos").drop("_snap", "pos")
