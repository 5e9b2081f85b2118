"""The latest reading of every station as a kept table (G01, E22): "now" costs the stations, not the history.

A micro-batch is reduced to its newest reading per station and merged into the buckets it
touches; buckets are written anew under the next version, others stay where they are. A
manifest (one small file per version) says in which version's folder each bucket lies. It
appears whole or not at all, so a reader sees one version, and a job that dies before it
leaves the table as it was.

The newest reading is the greatest of a total order, so merging is repeatable: late,
repeated and reordered readings give what a batch over all of them gives. One writer at a
time; the folders of all but the last ``KEEP`` versions are removed as they are replaced.
"""

from __future__ import annotations

import json
import uuid

import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stationlake.operators.panels import latest_rows
from stationlake.sources.compaction import _children, _opened

BUCKETS, KEEP = 64, 2  # buckets of stations; manifests whose folders stay
MANIFESTS = "_manifests"


def _versions(path: str) -> list[int]:
    fs, root = _opened(path)
    return sorted(int(f.base_name.removesuffix(".json")) for f in _children(fs, f"{root}/{MANIFESTS}")
                  if f.base_name.endswith(".json") and not f.base_name.startswith("_"))


def manifest(path: str, version: int | None = None) -> dict:
    """version, buckets (bucket -> folder), n_buckets and schema; an empty one where nothing is written yet."""
    fs, root = _opened(path)
    known = _versions(path)
    if not known:
        return {"version": 0, "buckets": {}, "n_buckets": None, "schema": None}
    with fs.open_input_file(f"{root}/{MANIFESTS}/{version or known[-1]:012d}.json") as f:
        return json.loads(f.read())


def _commit(path: str, new: dict) -> None:
    fs, root = _opened(path)
    fs.create_dir(f"{root}/{MANIFESTS}", recursive=True)
    temporary = f"{root}/{MANIFESTS}/_{uuid.uuid4().hex}"
    with fs.open_output_stream(temporary) as out:
        out.write(json.dumps(new).encode())
    fs.move(temporary, f"{root}/{MANIFESTS}/{new['version']:012d}.json")


def _clean(path: str) -> None:
    """Removes manifests but the last ``KEEP``, and folders that none of those names."""
    fs, root = _opened(path)
    known = _versions(path)
    kept = [manifest(path, v) for v in known[-KEEP:]]
    used = {f for m in kept for f in m["buckets"].values()}
    for v in known[:-KEEP]:
        fs.delete_file(f"{root}/{MANIFESTS}/{v:012d}.json")
    for top in _children(fs, root):
        if top.base_name.startswith("v"):
            own = [f.base_name for f in _children(fs, top.path) if f.base_name.startswith("bucket=")]
            left = [b for b in own if f"{top.base_name}/{b}" in used]
            if not left:
                fs.delete_dir(top.path)
                continue
            for b in own:
                if b not in left:
                    fs.delete_dir(f"{top.path}/{b}")


def upsert_latest(readings: DataFrame, path: str, buckets: int = BUCKETS) -> int:
    """Merges the newest reading per station of ``readings`` into the table; returns the version that counts."""
    spark = readings.sparkSession
    now = manifest(path)
    n = now["n_buckets"] or buckets
    newest = latest_rows(readings).withColumn("bucket", F.pmod(F.xxhash64("station_id"), F.lit(n)).cast("int")).persist()
    try:
        touched = sorted(r.bucket for r in newest.select("bucket").distinct().collect())  # at most ``n`` numbers
        if not touched:
            return now["version"]
        old = [f"{path.rstrip('/')}/{now['buckets'][str(b)]}" for b in touched if str(b) in now["buckets"]]
        rows = newest.drop("bucket")
        if old:
            rows = latest_rows(spark.read.schema(rows.schema).parquet(*old).unionByName(rows))
        folder = f"v{now['version'] + 1:012d}-{uuid.uuid4().hex[:8]}"
        (rows.withColumn("bucket", F.pmod(F.xxhash64("station_id"), F.lit(n)).cast("int"))
         .repartition(len(touched), "bucket").sortWithinPartitions("bucket", "station_id")
         .write.partitionBy("bucket").parquet(f"{path.rstrip('/')}/{folder}"))
        _commit(path, {"version": now["version"] + 1, "n_buckets": n, "schema": rows.schema.json(),
                       "buckets": {**now["buckets"], **{str(b): f"{folder}/bucket={b}" for b in touched}}})
    finally:
        newest.unpersist()
    _clean(path)
    return now["version"] + 1


def read_latest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """G01 from the table: the same columns as ``latest_per_station`` gives over all readings."""
    from stationlake.operators.panels import LATEST_COLUMNS

    now = manifest(path, version)
    if not now["buckets"]:
        raise FileNotFoundError(f"no latest readings are kept at {path}")
    files = [f"{path.rstrip('/')}/{f}" for f in now["buckets"].values()]
    rows = spark.read.schema(T.StructType.fromJson(json.loads(now["schema"]))).parquet(*files)
    return rows.select("station_id", *LATEST_COLUMNS)


def latest_to_table(enriched: DataFrame, path: str, checkpoint: str | None = None, trigger="60 seconds",
                    name: str = "latest", buckets: int = BUCKETS) -> StreamingQuery:
    """Keeps the table up to date from a stream of enriched readings."""
    from stationlake.streaming.ingest import _each_batch

    return _each_batch(enriched, lambda batch, own, i: upsert_latest(batch, path, buckets), name, checkpoint, trigger)
