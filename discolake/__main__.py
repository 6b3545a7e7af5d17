"""Command line: ``python -m discolake <step> ...`` or through spark-submit.

Storage end points and credentials come from the Spark configuration.
"""

from __future__ import annotations

import argparse

from discolake.operators.quality import completeness, gate
from discolake.plans import bronze, increment, layers
from discolake.schemas import PLAYLIST, PLAYLIST_ITEMS
from discolake.session import build_session
from discolake.sinks.exports import export_csv, export_tables, write_documents
from discolake.sinks.tables import overwrite
from discolake.sinks.topics import publish
from discolake.sources.documents import ORD, read_category_map, read_documents
from discolake.sources.tables import read_date
from discolake.sources.topics import TOPIC, read_topic
from discolake.streaming import events


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="discolake")
    steps = root.add_subparsers(dest="step", required=True)

    def step(name: str, *arguments: str, layout: str | None = None) -> argparse.ArgumentParser:
        sub = steps.add_parser(name)
        for argument in arguments:
            sub.add_argument(f"--{argument}", required=True)
        if layout:
            sub.add_argument("--layout", default=layout, choices=["lines", "indented", "array", "any"])
        return sub

    validate = step("validate", "source", layout="indented")
    land = step("land", "source", "bronze", "date", layout="indented")
    for sub in (validate, land):
        sub.add_argument("--lines", nargs="*", default=[], help="tables with one document per line")
    land.add_argument("--ungated", action="store_true")
    step("owners", "playlists", "target", layout="indented")
    artists = step("artists", "categories", "target")
    artists.add_argument("--layout", default="indented", choices=["indented", "whole"])
    for name in ("silver", "links"):
        sub = step(name, "bronze", "silver", "date", layout="lines")
        sub.add_argument("--tolerance", type=int, default=0, help="damaged documents of a dataset at most")
        sub.add_argument("--metrics", help="table that the results of the run are appended to")
    step("gold", "silver", "gold", "date").add_argument("--metrics")
    for domain in increment.PARENTS:
        load = step(f"load-{domain}", "parents", "found", "children", "keys", "summary", layout="indented")
        load.add_argument("--tolerance", type=int, help="damaged candidates at most; any number without it")
        load.add_argument("--buckets", type=int, help="buckets of the tables that grow, the same in every run")
        load.add_argument("--rejects", help="table of the damaged candidates")
        load.add_argument("--per-parent", type=int, help="children of a parent at most; all without it")
        if domain == "albums":
            load.add_argument("--sample", type=int, help="pending parents of this run; all without it")
        if domain == "playlists":
            load.add_argument("--album-keys", required=True)
    step("export-csv", "silver", "target", "date")
    step("export-gold", "gold", "target")
    step("land-events", "servers", "target", "rejected", "checkpoint").add_argument("--topic", default=TOPIC)
    dedup = step("dedup-events", "source", "target", "untimed", "checkpoint")
    dedup.add_argument("--delay", default="1 day")
    dedup.add_argument("--slices", type=int, default=1, help="input slices for events sent very many times")
    again = step("rebuild-events", "source", "target", "untimed")
    for sub in (dedup, again):
        sub.add_argument("--skew", default=events.SKEW, help="how far the time of an event may be ahead of its arrival")
    step("publish-events", "pages", "servers", layout="lines").add_argument("--topic", default=TOPIC)
    return root


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session()
    match args.step:
        case "validate":
            found = bronze.crawl_output(spark, args.source, args.layout, args.lines)
            print(*gate(completeness(spark, found)), sep="\n")
        case "land":
            landed = bronze.land(
                spark, args.source, args.bronze, args.date, args.layout, not args.ungated, args.lines
            )
            for table, rows in landed.items():
                print(f"{table}: {'missing, skipped' if rows is None else rows}")
        case "owners":
            docs = read_documents(spark, args.playlists, PLAYLIST, args.layout, ordered=True)
            write_documents(bronze.owners_from_playlists(docs, [ORD]), args.target)
        case "artists":
            categories = read_category_map(spark, args.categories, args.layout)
            write_documents(bronze.artists_from_categories(categories), args.target)
        case "silver":
            paths = args.bronze, args.silver, args.date, args.layout, args.tolerance, args.metrics
            print(*layers.build_silver(spark, *paths), sep="\n")
        case "links":
            paths = args.bronze, args.silver, args.date, args.layout, args.tolerance, args.metrics
            print(*layers.build_links(spark, *paths), sep="\n")
        case "gold":
            print(*layers.build_gold(spark, args.silver, args.gold, args.date, args.metrics), sep="\n")
        case "load-albums" | "load-tracks" | "load-playlists":
            row = increment.run(
                spark, args.step.removeprefix("load-"), args.parents, args.found, args.children, args.keys,
                per_parent=args.per_parent, sample=getattr(args, "sample", None),
                album_keys=getattr(args, "album_keys", None), layout=args.layout, summary=args.summary,
                rejects=args.rejects, tolerance=args.tolerance, buckets=args.buckets,
            )
            print(row.first().asDict())
        case "export-csv":
            export_csv(read_date(spark, f"{args.silver}/tracks", args.date).drop("ingest_date"), args.target)
        case "export-gold":
            export_tables(spark, args.gold, args.target, list(layers.gold.TABLES))
        case "land-events":
            stream = read_topic(spark, args.servers, args.topic)
            refused = events.append_to(events.rejected(stream), args.rejected, f"{args.checkpoint}/rejected")
            events.land(stream, args.target, f"{args.checkpoint}/landed").awaitTermination()
            refused.awaitTermination()
        case "dedup-events":
            stream = events.with_arrival(spark.readStream.schema(events.EVENT).parquet(args.source))
            aside = events.append_to(events.set_aside(stream, args.skew), args.untimed, f"{args.checkpoint}/untimed")
            kept = events.deduplicate(stream, args.delay, slices=args.slices, skew=args.skew)
            dropped = events.follow(events.append_to(kept, args.target, f"{args.checkpoint}/timed"))
            aside.awaitTermination()
            print(f"late rows dropped: {sum(dropped.values())} in {len(dropped)} batches")
        case "rebuild-events":
            landed = events.with_arrival(spark.read.schema(events.EVENT).parquet(args.source))
            kept = overwrite(events.rebuild(events.timed(landed, args.skew)), args.target)
            aside = overwrite(events.rebuild(events.set_aside(landed, args.skew)), args.untimed)
            print(f"events: {kept}, set aside: {aside}")
        case "publish-events":
            pages = read_documents(spark, args.pages, PLAYLIST_ITEMS, args.layout)
            publish(bronze.normalize_events(pages), args.servers, args.topic)


if __name__ == "__main__":
    main()
