"""The day-partitioned reading store and its upkeep.

The store is a Parquet dataset partitioned by ``dt`` (the UTC day of event time),
the counterpart of one search index per day, and below it by ``batch``, the write that
brought the rows. Reading the root path is the wildcard over all days; a predicate on
``dt`` prunes whole days. Batch jobs and streams write in the same way: a write replaces
only its own ``dt``/``batch`` folders, so different writes add up and a repeated one
(a retried micro-batch) leaves its rows once.
"""

from __future__ import annotations

import datetime as _dt
import uuid

import pyarrow.fs
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.functions.cells import cell_key
from stationlake.functions.columns import parse_utc, utc_date
from stationlake.operators.predicates import store_days
from stationlake.schema import ENRICHED
from stationlake.sources import compaction
from stationlake.sources.compaction import BATCH, CELL


def write_store(enriched: DataFrame, path: str, batch: str | None = None,
                max_records_per_file: int = 5_000_000, spread: bool = False, cells: bool = False) -> str:
    """Append readings as write ``batch`` (default: a new name); returns the name.

    Writing the same ``batch`` again replaces the days it holds, nothing else; days whose
    rows of this batch a compaction has taken in are left out. By default
    there is no shuffle: each task sorts its own rows by (day, station) and writes one file
    per day it holds (split beyond ``max_records_per_file``). ``spread`` rebalances by day
    first, for a backfill of many days by many tasks: fewer files, and adaptive execution
    splits a day that holds most of the rows. ``cells`` adds the quad-key of each reading's
    place and sorts by it instead, for searches by place.
    """
    name = batch or uuid.uuid4().hex
    rows = enriched.hint("rebalance", F.col("dt")) if spread else enriched
    taken = compaction.days_taken(path, name) if batch else []
    if taken:
        rows = rows.filter(F.coalesce(~F.col("dt").isin([F.lit(d).cast("date") for d in taken]), F.lit(True)))
    if cells:
        rows = rows.withColumn(CELL, cell_key("latitude", "longitude"))
    order = ["dt", BATCH, *([CELL, "ts"] if cells else ["station_id"])]  # the writer would sort by its folders itself, and lose the rest
    (rows.withColumn(BATCH, F.lit(name)).sortWithinPartitions(*order).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", max_records_per_file)
     .partitionBy("dt", BATCH).parquet(path))
    return name


def read_store(spark: SparkSession, path: str, columns=None, exclude=(), schema=ENRICHED,
               batches: bool = False, cells: bool = False) -> DataFrame:
    """Every day of the store; ``columns`` prunes, ``exclude`` drops fields.

    The schema is given, not inferred, so no file footer is opened to plan the scan
    (``schema=None`` infers it). ``batches`` keeps the name of the write as a column, ``cells``
    reads the quad-keys (null where a file has none). What a compaction has replaced, or one
    that died has left, isn't read (:mod:`stationlake.sources.compaction`).
    A file that goes missing while it is read is an error, never a short result.
    """
    reader = spark.read.option("basePath", path)
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField(CELL, T.LongType()), T.StructField(BATCH, T.StringType())]))
    df = reader.parquet(path)
    visible = compaction.visible(path)
    df = df if visible is None else df.filter(visible)
    df = df if batches else df.drop(BATCH)
    df = df if cells else df.drop(CELL)
    if columns:
        df = df.select(*columns)
    return df.drop(*exclude) if exclude else df


def distinct_readings(df: DataFrame) -> DataFrame:
    """One row per (station_id, collected_at), for stores that were fed the same snapshots twice."""
    return df.dropDuplicates(["station_id", "collected_at"])


def preview(df: DataFrame, n: int = 5,
            columns=("name", "num_bikes_available", "num_docks_available", "occupation_rate",
                     "station_status")) -> DataFrame:
    """A10: the five-column projection, first ``n`` rows in event-time order.

    On a day-partitioned store only the earliest days that hold ``n`` rows together are read:
    the rows per day come from file footers, the day bound is a subquery that prunes folders.
    """
    if len(store_days(df)) > 1:
        so_far = F.sum("doc_count").over(Window.orderBy("dt"))  # a row per day
        enough = day_counts(df).withColumn("so_far", so_far).filter(F.col("so_far") >= n).agg(F.min("dt")).scalar()
        df = df.filter(F.col("dt") <= F.coalesce(enough, F.lit("9999-12-31").cast("date")))
    return df.orderBy("ts", "station_id").select(*columns).limit(n)


def cache_base(df: DataFrame) -> DataFrame:
    """Keep the base table for many analyses (spills to disk if memory is short)."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def day_counts(df: DataFrame) -> DataFrame:
    """Readings per day partition (the per-index document count)."""
    return df.groupBy("dt").agg(F.count(F.lit(1)).alias("doc_count"))


def _cutoff(df: DataFrame, days: int, as_of) -> Column:
    if as_of is None:
        today = utc_date(F.current_timestamp())
    elif isinstance(as_of, str) and as_of == "latest":
        known = store_days(df)
        today = F.lit(known[-1]).cast("date") if known else df.agg(F.max("dt")).scalar()
    elif isinstance(as_of, str):
        today = utc_date(parse_utc(F.lit(as_of)))
    else:
        today = F.lit(as_of).cast("date")
    return F.date_sub(today, days)


def retain(df: DataFrame, days: int, as_of=None) -> DataFrame:
    """Readings of the last ``days`` days (``as_of`` day included)."""
    return df.filter(F.col("dt") >= _cutoff(df, days, as_of))


def expired_days(df: DataFrame, days: int, as_of=None) -> DataFrame:
    """Day partitions older than the retention window."""
    return df.select("dt").distinct().filter(F.col("dt") < _cutoff(df, days, as_of))


def drop_expired(spark: SparkSession, path: str, days: int, as_of: _dt.date | None = None) -> list[str]:
    """Delete the expired day folders of the store; returns the deleted days.

    The days are those of the store's folders (no file is opened); "today" is the UTC day.
    """
    today = as_of or _dt.datetime.now(_dt.timezone.utc).date()
    cutoff = (today - _dt.timedelta(days=days)).isoformat()
    victims = [d for d in store_days(read_store(spark, path)) if d < cutoff]
    fs, root = pyarrow.fs.FileSystem.from_uri(path) if "://" in path else (pyarrow.fs.LocalFileSystem(), path)
    for d in victims:
        fs.delete_dir(f"{root.rstrip('/')}/dt={d}")
        compaction.forget_day(path, d)
    return victims
