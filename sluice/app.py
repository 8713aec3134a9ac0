"""Command line for the streaming jobs.

    spark-submit --py-files sluice.zip sluice/app.py log-split --servers h:9092 --checkpoint s3://b/cp
    spark-submit ... sluice/app.py change-split --servers h:9092 --checkpoint s3://b/cp \\
        --control s3://b/control --dims s3://b/dims
    ... daily-active --dau s3://b/dau [--dims s3://b/dims]      page topic to one row a device and day
    ... order-enrich --dims s3://b/dims                         order topic with looked-up columns
    ... order-wide --wide s3://b/wide [--details TOPIC]         orders merged with their details
    ... order-merge --wide s3://b/merged [--details TOPIC]      the same, unmatched and late records accounted for
    ... dim-state --control s3://b/control                      newest dimension images in the stream's state

With ``--replay PATH`` topics are read from parquet files, and with ``--out PATH`` messages are
written to parquet files instead of Kafka. ``--progress PATH`` keeps a table of what every batch has read,
``--counts PATH`` one of what the split jobs routed, dropped and set aside. A job runs until it is stopped; ``--once`` takes what is
there and ends. Where a job starts counts for the first run of a checkpoint only.
"""

from __future__ import annotations

import argparse
import json
from dataclasses import replace

from sluice.operators.change_routes import ChangeTopics
from sluice.operators.log_routes import LogTopics
from sluice.session import build_session
from sluice.sources.control import control_files
from sluice.sources.keyed_table import KeyedTable
from sluice.sources.sinks import FileSink, KafkaSink
from sluice.sources.topics import EARLIEST, LATEST, KafkaTopic, ReplayTopic
from sluice.streaming import derived, jobs
from sluice.streaming.dim_state import start_dim_state
from sluice.streaming.progress import ProgressListener
from sluice.streaming.wide import start_order_merge

# Source topic of each job.
SOURCES = {
    "log-split": LogTopics.source,
    "change-split": ChangeTopics.source,
    "daily-active": LogTopics.page,
    "order-enrich": "DWD_ORDER_INFO_I_1018",
    "order-wide": derived.ENRICHED_ORDERS,
    "order-merge": derived.ENRICHED_ORDERS,
    "dim-state": ChangeTopics.source,
}
# What a job needs besides its source and checkpoint.
NEEDS = {
    "log-split": ["sink"], "change-split": ["sink", "control", "dims"], "daily-active": ["dau"],
    "order-enrich": ["sink", "dims"], "order-wide": ["wide"], "order-merge": ["wide"], "dim-state": ["control"],
}


def parser() -> argparse.ArgumentParser:
    cli = argparse.ArgumentParser(prog="sluice")
    cli.add_argument("job", choices=list(SOURCES))
    cli.add_argument("--servers", help="Kafka bootstrap servers")
    cli.add_argument("--topic", help="source topic, if not the default")
    cli.add_argument("--start", choices=[LATEST, EARLIEST], help="Kafka only; latest if not given")
    cli.add_argument("--start-offsets", type=json.loads, help='Kafka only: first offsets, as {"0": 17, "3": 5}')
    cli.add_argument("--partitions", type=int, help="of the topic; those --start-offsets leaves out start at their earliest record, and with --replay progress names their offsets")
    cli.add_argument("--max-offsets", type=int, help="bound on a micro-batch, in offsets")
    cli.add_argument("--min-partitions", type=int)
    cli.add_argument("--replay", help="read topics from parquet files below this path, from the first on")
    cli.add_argument("--out", help="write messages to parquet files below this path")
    cli.add_argument("--suffix", help="ending of fact topics, if not the default")
    cli.add_argument("--quarantine", help="topic for records set aside, if not the default")
    cli.add_argument("--checkpoint", required=True)
    cli.add_argument("--control", help="folder of published control tables")
    cli.add_argument("--dims", help="path of the dimension table")
    cli.add_argument("--dau", help="path of the table of daily actives")
    cli.add_argument("--wide", help="path of the wide orders")
    cli.add_argument("--salts", type=int, default=4, help="tasks that one order's details are spread over; fixed by the first run")
    cli.add_argument("--progress", help="folder for the table of what each batch has read")
    cli.add_argument("--counts", help="folder for the split jobs' table of counts per batch")
    cli.add_argument("--details", default="DWD_ORDER_DETAIL_I_1018", help="topic of order details")
    cli.add_argument("--keep-unmatched", action="store_true", help="wide orders: also details without an order")
    cli.add_argument("--state-partitions", type=int, help="of a job with state; fixed by the first run")
    cli.add_argument("--time-zone", default="UTC", help="of the days of daily actives")
    cli.add_argument("--buckets", type=int, help="of the keyed table that is written, per space; can be changed")
    cli.add_argument("--on-delete", choices=["keep", "remove"], default="keep")
    cli.add_argument("--on-malformed", choices=["quarantine", "fail"], default="quarantine")
    cli.add_argument("--key-by-id", action="store_true", help="key fact messages by row id")
    cli.add_argument("--interval", default="5 seconds", help="between micro-batches")
    cli.add_argument("--once", action="store_true")
    return cli


def source(args: argparse.Namespace, topic: str):
    """The topic as the options want it read."""
    if args.replay:
        if args.start == LATEST or args.start_offsets:
            raise SystemExit("--replay reads all files; a start position is for Kafka")
        return ReplayTopic(args.replay, topic, partitions=args.partitions)
    if not args.servers:
        raise SystemExit("name --servers or --replay")
    start = args.start or LATEST
    if args.start_offsets:
        start = {int(p): o for p, o in args.start_offsets.items()}
    return KafkaTopic(args.servers, topic, start, args.min_partitions, args.partitions, args.max_offsets)


def start(spark, args: argparse.Namespace):
    """The query ``args`` ask for, started."""
    records = source(args, args.topic or SOURCES[args.job])
    sink = FileSink(args.out) if args.out else args.servers and KafkaSink(args.servers)
    given = {**vars(args), "sink": sink}
    if missing := [n for n in NEEDS[args.job] if not given[n]]:
        raise SystemExit(f"{args.job} needs " + ", ".join(f"--{n}".replace("--sink", "--servers or --out") for n in missing))
    trigger = jobs.ONCE if args.once else {"processingTime": args.interval}
    args.listener = ProgressListener(spark, args.progress) if args.progress else None
    if args.listener:
        spark.streams.addListener(args.listener)
    counts = jobs.count_log(spark, args.counts) if args.counts else None
    writes_dims = args.buckets if args.job == "change-split" else None
    dims = KeyedTable(spark, args.dims, on_delete=args.on_delete, buckets=writes_dims) if args.dims else None
    names = {"source": args.topic, "suffix": args.suffix, "quarantine": args.quarantine}
    if args.job == "log-split":
        topics = replace(LogTopics(), **{k: v for k, v in names.items() if v and k != "suffix"})
        return jobs.start_log_split(spark, records, sink, args.checkpoint, topics, args.on_malformed, trigger, counts)
    if args.job == "change-split":
        topics = replace(ChangeTopics(), **{k: v for k, v in names.items() if v})
        return jobs.start_change_split(
            spark, records, control_files(spark, args.control), sink, dims, args.checkpoint, topics,
            args.on_malformed, args.key_by_id, trigger, counts,
        )
    if args.job == "dim-state":
        rules = control_files(spark, args.control)()
        return start_dim_state(spark, records, rules, args.checkpoint, trigger, args.state_partitions)
    if args.job == "daily-active":
        table = derived.dau_table(spark, args.dau, buckets=args.buckets)
        return derived.start_daily_active(spark, records, table, args.checkpoint, trigger, dims, args.time_zone)
    if args.job == "order-enrich":
        return derived.start_order_enrich(spark, records, dims, sink, args.checkpoint, trigger)
    sides = (records, source(args, args.details), args.wide, args.checkpoint, trigger, args.state_partitions)
    if args.job == "order-merge":
        return start_order_merge(spark, *sides, salts=args.salts)
    return derived.start_order_wide(spark, *sides, keep_unmatched=args.keep_unmatched, salts=args.salts)


def finish(spark, args: argparse.Namespace, query) -> None:
    """Returns when the query has ended and its last batch is in the progress table."""
    query.awaitTermination()
    if args.listener:
        args.listener.settled(query)
        spark.streams.removeListener(args.listener)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"sluice {args.job}")
    finish(spark, args, start(spark, args))


if __name__ == "__main__":
    main()
