"""Command line: ``python -m docflow run|redeliver|publish``."""

from __future__ import annotations

import argparse
import os
from collections.abc import Callable, Sequence
from importlib import import_module

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from docflow.functions.paging import check_cap
from docflow.functions.retry import STEEP_TEXT_MS, STRATEGIES
from docflow.operators.lookup import table_fetcher
from docflow.operators.pages import python_extractor
from docflow.operators.previews import python_renderer
from docflow.plans.stages import preview_stage, register, text_stage
from docflow.schemas import BUCKET, DEFAULT_PAGE_CAP
from docflow.session import build_session
from docflow.sources.notifications import publish, stream_bodies
from docflow.sources.objects import read_objects, store_fetcher
from docflow.streaming.runner import RetryPolicy, StreamConfig, redeliver, start


def page_cap(text: str) -> int | None:
    """A page cap from the command line; ``all`` for none."""
    return None if text == "all" else check_cap(int(text))


def named(target: str) -> Callable:
    """The function that ``module:function`` names; workers have to be able to import it."""
    module, _, function = target.partition(":")
    return getattr(import_module(module), function)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="docflow", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    run = commands.add_parser("run", help="process the notifications of an inbox")
    run.add_argument("--inbox", required=True)
    run.add_argument("--out", required=True)
    run.add_argument("--checkpoint", required=True)
    where = run.add_mutually_exclusive_group(required=True)
    where.add_argument("--store", help="URI with objects at Bucket/Key, read one by one")
    where.add_argument("--objects", help="parquet table with Bucket, Key and content")
    run.add_argument("--stages", default="text,previews")
    run.add_argument("--layout", default="nested", choices=["nested", "flat"])
    run.add_argument(
        "--max-pages",
        default=os.environ.get("MAX_EXTRACT_PAGES", str(DEFAULT_PAGE_CAP)),
        help="pages of a document to read, or 'all'",
    )
    run.add_argument("--extractor", help="module:function that opens a document's content")
    run.add_argument("--renderer", help="module:function that draws a page's text")
    run.add_argument("--put", help="URI to store texts and previews under their output keys")
    run.add_argument("--max-files", type=int, default=1000, help="inbox files per micro-batch")
    run.add_argument("--poll", help="interval such as '20 seconds'; without it, run once")
    run.add_argument("--dedup-within", help="drop copies within this time, such as '10 minutes'")
    run.add_argument("--retry", default="exponential", choices=sorted(STRATEGIES))
    run.add_argument("--retry-base", type=int, default=STEEP_TEXT_MS, help="ms, for exponential")
    run.add_argument("--retry-no-reset", action="store_true", help="never start delays over")
    run.add_argument(
        "--subscribe",
        action="append",
        metavar="TOPIC=QUEUE",
        help="route messages by topic; may be repeated; without it every stage gets all",
    )
    run.add_argument("--archive", help="move inbox files here once they were read")

    again = commands.add_parser("redeliver", help="publish failed messages that are due")
    again.add_argument("--out", required=True)
    again.add_argument("--inbox", required=True)

    send = commands.add_parser("publish", help="publish a notification per stored object")
    send.add_argument("--store", required=True, help="folder of one bucket's objects")
    send.add_argument("--bucket", default=BUCKET)
    send.add_argument("--inbox", required=True)
    return parser


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = spark or build_session()
    if args.command == "publish":
        objects = read_objects(spark, args.store, args.bucket).select(
            F.md5(F.concat_ws("/", "Bucket", "Key")).alias("uid"), "Bucket", "Key"
        )
        publish(objects, args.inbox)
    elif args.command == "redeliver":
        redeliver(spark, args.out, args.inbox)
    else:
        cap = page_cap(args.max_pages)
        render = python_renderer(named(args.renderer)) if args.renderer else None
        extract = python_extractor(named(args.extractor)) if args.extractor else None
        register(text_stage(cap, args.layout))
        register(preview_stage(cap, args.layout, render))
        fetch = (
            store_fetcher(args.store)
            if args.store
            else table_fetcher(lambda: spark.read.parquet(args.objects))
        )
        config = StreamConfig(
            stages=tuple(args.stages.split(",")),
            poll_interval=args.poll,
            dedup_within=args.dedup_within,
            retry=RetryPolicy(args.retry, args.retry_base, not args.retry_no_reset),
            put=args.put,
            subscriptions=tuple(tuple(s.split("=", 1)) for s in args.subscribe) if args.subscribe else None,
        )
        bodies = stream_bodies(spark, args.inbox, args.max_files, archive=args.archive)
        start(bodies, fetch, args.out, args.checkpoint, config, extract).awaitTermination()


if __name__ == "__main__":
    main()
