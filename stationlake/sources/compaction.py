"""Compaction of a day's write folders (A06, W03): many small writes become a few sorted files.

A stream with a trigger of a minute leaves 1,440 ``batch`` folders a day. ``compact_day``
rewrites a day as one write, range-partitioned and sorted by cell, and swaps it in by two steps:

1. the rows of all folders that count are written to a folder ``batch=compact-<id>``;
   readers leave out such folders until they are committed;
2. one small file ``_compactions/<id>.json`` is put in place. It names the folders that
   the new one replaces; from here on readers see the new folder and leave those out.

Then the replaced folders are deleted. A job that dies between any two of these leaves a
store that reads the same; the next compaction of the day removes what is left over. Writes
that arrive meanwhile aren't in the list, so they stay visible. A batch that is written again
after it was taken in (a stream that died before its checkpoint) leaves out the days that
hold its rows already, so the names stay in the list for good.

One compaction of a day may run at a time. The store must be read with
:func:`stationlake.sources.store.read_store`.
"""

from __future__ import annotations

import json
import uuid

import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.functions.cells import cell_key
from stationlake.schema import ENRICHED

BATCH, CELL = "batch", "cell"
PREFIX, COMMITS = "compact-", "_compactions"
TARGET_BYTES, ROW_GROUP_BYTES = 256 << 20, 16 << 20  # of a file; of a row group
PAGE_ROWS = 2000  # rows of a page, the smallest unit that a search by place skips


def _opened(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if "://" in path:
        fs, root = pyarrow.fs.FileSystem.from_uri(path)
    else:
        fs, root = pyarrow.fs.LocalFileSystem(), path.removeprefix("file:")
    return fs, root.rstrip("/")


def _children(fs, folder: str) -> list[pyarrow.fs.FileInfo]:
    return fs.get_file_info(pyarrow.fs.FileSelector(folder, allow_not_found=True))


def commits(path: str) -> list[dict] | None:
    """The committed compactions (id, day, replaces, clean); None where none was ever begun."""
    fs, root = _opened(path)
    folder = f"{root}/{COMMITS}"
    if fs.get_file_info(folder).type == pyarrow.fs.FileType.NotFound:
        return None
    out = []
    for f in _children(fs, folder):
        if f.base_name.endswith(".json"):
            with fs.open_input_file(f.path) as file:
                out.append(json.loads(file.read()))
    return sorted(out, key=lambda c: c["id"])


def visible(path: str) -> Column | None:
    """Which (dt, batch) folders count; None: all. Spark prunes folders by it."""
    known = commits(path)
    if known is None:
        return None
    name = F.col(BATCH).cast("string")
    keep = ~name.startswith(PREFIX)
    if known:
        keep = keep | name.isin([c["id"] for c in known])
    for c in known:
        if not c["clean"]:
            keep = keep & ~((F.col("dt") == F.lit(c["day"]).cast("date")) & name.isin(c["replaces"]))
    return keep


def days_taken(path: str, batch: str) -> list[str]:
    """Days whose rows of write ``batch`` a committed compaction holds."""
    return sorted({c["day"] for c in commits(path) or () if batch in c["replaces"]})


def _folders(path: str, day: str) -> list[str]:
    fs, root = _opened(path)
    return sorted(f.base_name.removeprefix(f"{BATCH}=") for f in _children(fs, f"{root}/dt={day}")
                  if f.base_name.startswith(f"{BATCH}="))


def _put(path: str, commit: dict) -> None:
    """The commit file appears whole or not at all."""
    fs, root = _opened(path)
    new = f"{root}/{COMMITS}/_{uuid.uuid4().hex}"
    with fs.open_output_stream(new) as out:
        out.write(json.dumps(commit).encode())
    fs.move(new, f"{root}/{COMMITS}/{commit['id']}.json")


def begin(path: str) -> None:
    fs, root = _opened(path)
    fs.create_dir(f"{root}/{COMMITS}", recursive=True)


def write_step(spark: SparkSession, path: str, day: str, batches: list[str], target_bytes: int = TARGET_BYTES,
               row_group_bytes: int = ROW_GROUP_BYTES) -> str:
    """Step 1: the rows of the day's ``batches`` as one write that doesn't count yet; returns its id."""
    fs, root = _opened(path)
    name = f"{PREFIX}{uuid.uuid4().hex}"
    size = sum(f.size or 0 for b in batches for f in _children(fs, f"{root}/dt={day}/{BATCH}={b}"))
    rows = _rows(spark, path, day, batches).withColumn(CELL, cell_key("latitude", "longitude")).withColumn(BATCH, F.lit(name))
    (rows.repartitionByRange(max(1, -(-size // target_bytes)), CELL, "ts", "station_id")
     .sortWithinPartitions("dt", BATCH, CELL, "ts", "station_id").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").option("parquet.block.size", row_group_bytes)
     .option("parquet.page.row.count.limit", PAGE_ROWS)
     .partitionBy("dt", BATCH).parquet(path))
    return name


def _rows(spark: SparkSession, path: str, day: str, batches: list[str]) -> DataFrame:
    schema = T.StructType([*ENRICHED.fields, T.StructField(CELL, T.LongType()), T.StructField(BATCH, T.StringType())])
    base = path.rstrip("/")
    return spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/dt={day}/{BATCH}={b}" for b in batches])


def commit_step(path: str, day: str, batches: list[str], name: str) -> None:
    """Step 2: from now on ``name`` counts and ``batches`` don't."""
    earlier = [b for c in commits(path) or () if c["day"] == day for b in c["replaces"]]
    _put(path, {"id": name, "day": day, "replaces": sorted({*batches, *earlier}), "clean": False})


def clean_step(path: str, day: str) -> None:
    """Deletes what a committed compaction of the day replaces and what an uncommitted one left."""
    fs, root = _opened(path)
    known = commits(path) or []
    own = [c for c in known if c["day"] == day]
    gone = {b for c in own for b in c["replaces"]}
    current = {c["id"] for c in own} - gone
    for b in _folders(path, day):
        if b in gone or (b.startswith(PREFIX) and b not in current):
            fs.delete_dir(f"{root}/dt={day}/{BATCH}={b}")
    for c in own:
        if c["id"] in gone:  # taken in by a later one, which has its list
            fs.delete_file(f"{root}/{COMMITS}/{c['id']}.json")
        elif not c["clean"]:
            _put(path, {**c, "clean": True})


def forget_day(path: str, day: str) -> None:
    """Drops the lists of a day that is deleted."""
    fs, root = _opened(path)
    for c in commits(path) or ():
        if c["day"] == day:
            fs.delete_file(f"{root}/{COMMITS}/{c['id']}.json")


def compact_day(spark: SparkSession, path: str, day: str, target_bytes: int = TARGET_BYTES,
                row_group_bytes: int = ROW_GROUP_BYTES, min_batches: int = 2, clean: bool = True) -> str | None:
    """Rewrites a day of at least ``min_batches`` folders as one; returns its name (None: nothing to do).

    Without ``clean`` the replaced folders stay until the next compaction of the day: queries
    that were planned before still read them.
    """
    begin(path)
    clean_step(path, day)
    batches = _folders(path, day)
    if len(batches) < min_batches:
        return None
    name = write_step(spark, path, day, batches, target_bytes, row_group_bytes)
    commit_step(path, day, batches, name)
    if clean:
        clean_step(path, day)
    return name


def compact_store(spark: SparkSession, path: str, before: str | None = None, **options) -> dict[str, str]:
    """Compacts every day (earlier than ``before``, 'yyyy-MM-dd'); day -> name of the new write."""
    fs, root = _opened(path)
    days = sorted(f.base_name[3:] for f in _children(fs, root) if f.base_name.startswith("dt="))
    done = {d: compact_day(spark, path, d, **options) for d in days if before is None or d < before}
    return {d: n for d, n in done.items() if n}
