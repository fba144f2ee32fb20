"""Jobs: ``python -m placewell <job> ...``, from the folder that holds the package."""

from __future__ import annotations

import argparse
from datetime import timedelta

from pyspark.sql import DataFrame

from placewell.operators.joins import attach_key, point_keys
from placewell.plans import checks
from placewell.plans.places import regional_top_with_latest
from placewell.plans.readings import (
    INSTANT, READING_YEAR, latest_report, reading_fields, readings_latest,
)
from placewell.plans.refresh import refresh, refresh_changed
from placewell.session import build_session
from placewell.sources.buckets import BUCKETS
from placewell.sources.compaction import compact, vacuum
from placewell.sources.datasets import DATASETS
from placewell.sources.ingest import ingest_table, ingest_variant, load_history, read_table
from placewell.sources.landing import (
    TIME_FIELD, land_dataset, land_readings, read_json_lines,
)
from placewell.sources.tables import stored_table
from placewell.streaming.latest import fold_changes, follow_latest


PRINTED = 1_000  # rows at most; longer results need a folder


def deliver(result: DataFrame, output: str | None) -> None:
    """The whole result: to a Parquet folder if one is named, else printed, if it is short."""
    if output:
        result.write.mode("overwrite").parquet(output)
        print(f"written to {output}: {result.sparkSession.read.parquet(output).count()} rows")
        return
    head = result.limit(PRINTED + 1).collect()
    if len(head) > PRINTED:
        raise SystemExit(f"more than {PRINTED} rows: name a folder for them with --output")
    print("\t".join(result.columns))
    for row in head:
        print("\t".join("" if v is None else str(v) for v in row))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="placewell")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, text: str, *arguments: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=text, description=text)
        for argument in arguments:
            sub.add_argument(argument)
        return sub

    job("land", "JSON lines to Parquet", "source", "target").add_argument(
        "--dataset", choices=DATASETS, required=True)
    polls = job("land-readings", "polled responses (JSON lines) to dated Parquet", "source", "target")
    polls.add_argument("--city", required=True)
    polls.add_argument("--point", action="append", default=[], metavar="LAT,LON=KEY",
                       help="key of a polled point; responses then need no business_id")
    job("ingest", "load new Parquet files into a raw table", "source", "target").add_argument(
        "--dataset", choices=[d for d, s in DATASETS.items() if s.ddl] + ["business"], required=True)
    job("ingest-readings", "load new reading files as variants", "source", "target")
    for name in ("ingest", "ingest-readings"):
        jobs.choices[name].add_argument(
            "--interval", help="such as '1 minute'; without it the job ends when done")
        jobs.choices[name].add_argument("--archive", help="folder that loaded files move to")
    job("history", "load history per file", "target").add_argument("--within", default="14 days")
    clean = job("refresh", "rebuild the clean tables from the raw ones", "places", "reviews", "checkins")
    clean.add_argument("--location", required=True, help="folder of the clean tables")
    clean.add_argument("--checkin-lists", action="store_true", help="also the table of lists")
    changed = job("refresh-changed", "take new batches into clean tables kept in buckets of their keys",
                  "places", "reviews", "checkins")
    changed.add_argument("--location", required=True, help="folder of the bucketed clean tables")
    changed.add_argument("--buckets", type=int, default=BUCKETS, help="counts at the first refresh")
    look = job("check", "null profiles, row counts and monthly trend", "places", "reviews")
    look.add_argument("--location", required=True, help="folder of the clean tables")
    look.add_argument("--checkins", help="raw check-ins, to count what cannot be read")
    top_places = job("top", "best places of the region with their latest reading", "raw")
    top_places.add_argument("--location", required=True, help="folder of the clean tables")
    top_places.add_argument("--year", type=int, default=READING_YEAR)
    small = job("compact", "rewrite published batches of a raw table as few large files", "target")
    small.add_argument("--leave", type=int, default=1, help="newest batches that stay as they are")
    small.add_argument("--sort-by", action="append", default=[], metavar="COLUMN")
    small.add_argument("--retain-hours", type=float, default=24, help="age at which replaced folders are deleted")
    job("fold", "fold the changes that watch has written", "target")
    report = job("latest", "latest reading per place", "raw")
    report.add_argument("--year", type=int, default=READING_YEAR)
    for name in ("history", "check", "latest", "top"):
        jobs.choices[name].add_argument("--output", help=f"folder for the result; without it up to {PRINTED} rows are printed")
    stream = job("watch", "keep the latest reading per place from arriving raw files", "raw", "target")
    stream.add_argument("--year", type=int, default=READING_YEAR)
    stream.add_argument("--interval", help="such as '20 minutes'; without it the job ends when done")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"placewell-{args.job}")
    if args.job == "land":
        land_dataset(spark, args.dataset, args.source, args.target)
    elif args.job == "land-readings":
        polls = read_json_lines(spark, args.source, timestamps={"polled_at": "polled_at"})
        if args.point:
            points, keys = zip(*(p.rsplit("=", 1) for p in args.point))
            polls = attach_key(polls.drop("business_id"), point_keys(spark, points, keys), "coord", len(points))
        land_readings(polls, args.target, args.city)
    elif args.job == "ingest":
        schema = DATASETS[args.dataset].table_schema or spark.read.options(
            mergeSchema="true", ignoreCorruptFiles="true").parquet(args.source).schema
        ingest_table(spark, args.source, args.target, schema,
                     interval=args.interval, archive=args.archive).awaitTermination()
    elif args.job == "ingest-readings":
        ingest_variant(spark, args.source, args.target, TIME_FIELD,
                       interval=args.interval, archive=args.archive).awaitTermination()
    elif args.job == "history":
        deliver(load_history(spark, args.target, args.within), args.output)
    elif args.job == "refresh":
        refresh(*(read_table(spark, t) for t in (args.places, args.reviews, args.checkins)),
                args.location, args.checkin_lists).show(truncate=False)
    elif args.job == "refresh-changed":
        raw = {"places": args.places, "reviews": args.reviews, "checkins": args.checkins}
        for name, number in refresh_changed(spark, raw, args.location, args.buckets).items():
            print(f"{name}\t{number} buckets rewritten")
    elif args.job == "check":
        clean = {t: stored_table(spark, args.location, t)
                 for t in ("entity_clean", "regional_top", "checkin_events", "review_clean")}
        raw = (read_table(spark, t) for t in (args.places, args.reviews))
        for number, (title, result) in enumerate(checks.report(
                *raw, clean, read_table(spark, args.checkins) if args.checkins else None), 1):
            print(title)
            deliver(result, args.output and f"{args.output}/{number:02d}")
    elif args.job == "latest":
        deliver(latest_report(readings_latest(read_table(spark, args.raw), args.year)), args.output)
    elif args.job == "top":
        clean = stored_table(spark, args.location, "entity_clean")
        deliver(regional_top_with_latest(clean, read_table(spark, args.raw), args.year).orderBy(
            "primary_category", "rank_in_category"), args.output)
    elif args.job == "compact":
        done = compact(spark, args.target, args.leave, sort_by=args.sort_by)
        gone = vacuum(spark, args.target, timedelta(hours=args.retain_hours))
        print(f"segment up to batch {done}" if done is not None else "too few batches", f"{gone} folders deleted", sep=", ")
    elif args.job == "fold":
        fold_changes(spark, args.target, "business_id", INSTANT)
    elif args.job == "watch":
        follow_latest(spark, args.raw, args.target, "business_id", INSTANT,
                      lambda raw: reading_fields(raw, args.year), args.interval).awaitTermination()


if __name__ == "__main__":
    main()
