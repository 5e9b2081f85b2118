"""Command-line jobs: ingest snapshots or the topic into the day store, analyses, retention.

    python -m stationlake.cli ingest  --status DIR --info DIR --store PATH [--stream] [--trigger "60 seconds"]
    python -m stationlake.cli topic   --servers HOST:PORT --store PATH --corrupt PATH [--topic NAME]
    python -m stationlake.cli analyze --store PATH --out DIR [--single-file]
    python -m stationlake.cli retain  --store PATH --days 2

On a cluster, submit the same module with spark-submit; the session settings
(``spark.checkpoint.dir`` for the streaming checkpoint, shuffle sizes) come from
the deployment.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from stationlake.operators.enrich import enrich, to_reading
from stationlake.operators.join import join_status_info
from stationlake.session import checkpoint_path, get_spark
from stationlake.sources.compaction import compact_store
from stationlake.sources.feeds import corrupt_snapshots, read_info, read_snapshots, status_rows
from stationlake.sources.store import drop_expired, read_store, write_store


def ingest(args) -> None:
    spark = get_spark()
    info = read_info(spark, args.info)
    corrupt = args.corrupt or f"{args.store.rstrip('/')}-corrupt"
    if args.stream:
        from stationlake.streaming.ingest import snapshots_to_store

        trigger = "availableNow" if args.once else args.trigger
        snapshots_to_store(spark, args.status, info, args.store, corrupt,
                           args.checkpoint or checkpoint_path(spark, "ingest"), trigger,
                           args.max_stations).awaitTermination()
    else:
        feed = read_snapshots(spark, args.status)
        write_store(enrich(to_reading(join_status_info(status_rows(feed, args.max_stations), info))), args.store)
        corrupt_snapshots(feed).write.mode("append").parquet(corrupt)


def topic(args) -> None:
    from stationlake.sources.kafka import read_topic
    from stationlake.streaming.ingest import topic_to_store

    spark = get_spark()
    raw = read_topic(spark, args.servers, args.topic, max_offsets=args.max_offsets)
    topic_to_store(raw, args.store, args.corrupt, args.checkpoint or checkpoint_path(spark, "topic"),
                   "availableNow" if args.once else args.trigger).awaitTermination()


def analyze(args) -> None:
    from stationlake.plans.batch_job import release, run_analysis

    spark = get_spark()
    release(run_analysis(read_store(spark, args.store), args.out, single_file=args.single_file))


def retain(args) -> None:
    spark = get_spark()
    as_of = dt.date.fromisoformat(args.as_of) if args.as_of else None
    print(json.dumps({"deleted_days": drop_expired(spark, args.store, args.days, as_of)}))


def compact(args) -> None:
    spark = get_spark()
    print(json.dumps({"compacted_days": compact_store(spark, args.store, args.before)}))


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="stationlake")
    sub = p.add_subparsers(dest="cmd", required=True)
    i = sub.add_parser("ingest", help="status + info snapshots -> enriched day store")
    i.add_argument("--status", required=True)
    i.add_argument("--info", required=True)
    i.add_argument("--store", required=True)
    i.add_argument("--corrupt", default=None, help="folder of broken snapshots (default: STORE-corrupt)")
    i.add_argument("--max-stations", type=int, default=None)
    i.add_argument("--stream", action="store_true")
    i.add_argument("--once", action="store_true", help="stream: process what is there, then stop")
    i.add_argument("--trigger", default="60 seconds")
    i.add_argument("--checkpoint", default=None)
    i.set_defaults(fn=ingest)
    t = sub.add_parser("topic", help="reading topic -> enriched day store")
    t.add_argument("--servers", required=True)
    t.add_argument("--topic", default="station-readings")
    t.add_argument("--store", required=True)
    t.add_argument("--corrupt", required=True)
    t.add_argument("--max-offsets", type=int, default=5_000_000, help="messages per micro-batch")
    t.add_argument("--once", action="store_true")
    t.add_argument("--trigger", default="60 seconds")
    t.add_argument("--checkpoint", default=None)
    t.set_defaults(fn=topic)
    a = sub.add_parser("analyze", help="day store -> CSV analyses + JSON summary")
    a.add_argument("--store", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--single-file", action="store_true")
    a.set_defaults(fn=analyze)
    r = sub.add_parser("retain", help="delete day partitions older than --days")
    r.add_argument("--store", required=True)
    r.add_argument("--days", type=int, required=True)
    r.add_argument("--as-of", default=None)
    r.set_defaults(fn=retain)
    c = sub.add_parser("compact", help="rewrite the many writes of a day as a few files sorted by place")
    c.add_argument("--store", required=True)
    c.add_argument("--before", default=None, help="only days earlier than this one")
    c.set_defaults(fn=compact)
    args = p.parse_args(argv)
    args.fn(args)


if __name__ == "__main__":
    main()
