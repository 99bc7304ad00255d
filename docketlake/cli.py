"""Command line: ``python -m docketlake.cli COMMAND ...`` over a folder of stored datasets."""

from __future__ import annotations

import argparse
import sys
from datetime import datetime, timezone

from pyspark.sql import functions as F

from docketlake import schema
from docketlake.api import TOOLS, Trackers
from docketlake.operators import feeds, store
from docketlake.session import build_session
from docketlake.sources import delimited, registry


def _now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="docketlake", description=__doc__)
    parser.add_argument("--store", required=True, help="folder of stored datasets")
    parser.add_argument("--master", help="Spark master; spark-submit sets it on a cluster")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("status")
    add = commands.add_parser("import")
    add.add_argument("dataset", choices=sorted(schema.DATASETS))
    add.add_argument("paths", nargs="+")
    out = commands.add_parser("export")
    out.add_argument("folder")
    ask = commands.add_parser("query")
    ask.add_argument("tool", choices=sorted(TOOLS))
    ask.add_argument("filters", nargs="*", help="name=value")
    for name in ("analyze", "backtest"):
        study = commands.add_parser(name)
        study.add_argument("prices")
        study.add_argument("--window-days", type=int, default=30)
        study.add_argument("--search-days", type=int, default=7)
        study.add_argument("--events", choices=("trades", "insiders"), default="trades")
        study.add_argument("--ticker")
    walk = commands.add_parser("sync", help="read landed files from each source's cursor on")
    walk.add_argument("landing")
    walk.add_argument("sources", nargs="*", help="all, unless named")
    past = commands.add_parser("backfill", help="read landed files of a range of days, in chunks")
    past.add_argument("landing")
    past.add_argument("source", choices=sorted(registry.SOURCES))
    past.add_argument("since")
    past.add_argument("until")
    past.add_argument("--chunk-days", type=int, default=30)
    past.add_argument("--budget", type=int)
    commands.add_parser("canary", help="the latest run of each source")
    fill = commands.add_parser("resolve", help="fill a missing value from a JSON file of (key, value) rows")
    fill.add_argument("dataset", choices=sorted(schema.DATASETS))
    fill.add_argument("key")
    fill.add_argument("value")
    fill.add_argument("known")
    args = parser.parse_args(argv)
    spark = build_session(master=args.master)
    trackers = Trackers.at(spark, args.store)

    if args.command == "status":
        trackers.freshness(_now()).orderBy("dataset").show(len(schema.DATASETS), truncate=False)
    elif args.command == "import":
        rows = store.read_dump(spark, args.paths, schema.DATASETS[args.dataset].ddl)
        good, bad = schema.validate(schema.conformed(rows, args.dataset), args.dataset)
        if bad.head(1):
            bad.select("id", "reasons").show(truncate=False)
            return 1
        ranked = good.withColumn("_at", F.col("provenance.retrieved_at"))
        store.VersionedTable(spark, f"{args.store}/{args.dataset}").upsert(ranked, ["id"], ["_at"])
    elif args.command == "sync":
        failed = {k: v for k, v in registry.Lake(spark, args.store, args.landing).sync(registry.checked(args.sources) or None).items() if v}
        for name, error in failed.items():
            print(f"{name}: {error}", file=sys.stderr)
        return 1 if failed else 0
    elif args.command == "backfill":
        walked = registry.Lake(spark, args.store, args.landing).backfill(args.source, args.since, args.until, args.chunk_days, args.budget)
        print(f"done until {walked.done_until}" + (f", stopped: {walked.stopped}" if walked.stopped else ""))
        return 0 if walked.stopped in (None, "limit", "deadline") else 1
    elif args.command == "canary":
        found = registry.Lake(spark, args.store, "").canary()
        found.show(len(registry.SOURCES), truncate=False)
        return 0 if found.where(~F.col("ok")).isEmpty() else 1
    elif args.command == "resolve":
        known = spark.read.schema(f"{args.key} string, {args.value} string").json(args.known)
        print(registry.Lake(spark, args.store, "").resolve(args.dataset, args.key, args.value, known))
    elif args.command == "export":
        for name, df in trackers.tables.items():
            event = schema.DATASETS[name].event_date()
            store.write_shards(df, f"{args.folder}/{name}/snapshot", event)
            store.write_shards(df, f"{args.folder}/{name}/parquet", event, form="parquet")
            store.write_snapshot(df, f"{args.folder}/{name}/combined", event)
            items = [r["item"] for r in feeds.feed_items(df, name).collect()]  # a hundred at most
            store.write_text(spark, f"{args.folder}/{name}/feed.xml", feeds.feed_document(items, name, f"Newest rows of {name}", _now()))
    elif args.command == "query":
        filters = dict(f.split("=", 1) for f in args.filters)
        found = TOOLS[args.tool](trackers, **{k: int(v) if v.isdigit() and k in ("limit", "congress", "cycle", "since_year", "window_days") else v for k, v in filters.items()})
        for name, df in (found if isinstance(found, dict) else {args.tool: found}).items():
            print(name)
            df.show(50, truncate=False)
    else:
        prices, warnings = delimited.prices(spark, args.prices)
        events = trackers.trade_events(ticker=args.ticker) if args.events == "trades" else trackers.insider_events(args.ticker)
        if args.command == "backtest" and (not prices.head(1) or not events.head(1)):
            print("a backtest needs at least one price and one event", file=sys.stderr)
            return 1
        found = getattr(trackers, args.command)(events, prices, args.window_days, args.search_days)
        found["summary"].show(truncate=False)
        warnings.show(20, truncate=False)
        print(found["disclaimer"])
    return 0


if __name__ == "__main__":
    sys.exit(main())
