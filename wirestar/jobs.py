"""Command line: the jobs of the pipeline, singly or in order.

    spark-submit --py-files wirestar.zip wirestar/jobs.py load --lake s3a://b/lake \\
        --warehouse s3a://b/warehouse --day 2025-03-25
    python -m wirestar.jobs pipeline @settings.txt      # one argument per line
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from wirestar.operators import aggregates, checks
from wirestar.operators.slices import day_slice
from wirestar.plans import ingest, warehouse_load
from wirestar.session import SETTINGS
from wirestar.sources.staging import Staging
from wirestar.sources.tables import Warehouse, daily_aggregate, raw_packets
from wirestar.sources.traffic_files import archive_traffic
from wirestar.streaming import capture


def print_all(df: DataFrame) -> None:
    """Every row as tab-separated text, fetched partition by partition."""
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("NULL" if v is None else str(v) for v in row))


def archive(spark: SparkSession, args: argparse.Namespace) -> None:
    archive_traffic(spark, args.files, args.archive)


def ingest_files(spark: SparkSession, args: argparse.Namespace) -> None:
    ingest.ingest_files(spark, args.files, args.lake, args.replace)


def load(spark: SparkSession, args: argparse.Namespace) -> None:
    added = warehouse_load.run_day(
        spark,
        raw_packets(spark, args.lake).read(),
        Warehouse(spark, args.warehouse),
        args.day,
        half_open=args.half_open,
        scope=args.scope,
        null_safe=args.null_safe,
        allow_back_dated=args.allow_back_dated,
    )
    for table, rows in added.items():
        print(f"{table}: {rows} added")


def backfill(spark: SparkSession, args: argparse.Namespace) -> None:
    """The days ``--day`` to ``--last-day``, with the result of one ``load`` for each."""
    added = warehouse_load.run_history(
        spark,
        raw_packets(spark, args.lake).read(),
        Warehouse(spark, args.warehouse),
        args.day,
        args.last_day,
        half_open=args.half_open,
        scope=args.scope,
        null_safe=args.null_safe,
        allow_back_dated=args.allow_back_dated,
    )
    for table, rows in added.items():
        print(f"{table}: {rows} added")


def replace(spark: SparkSession, args: argparse.Namespace) -> None:
    """One day, or ``--day`` to ``--last-day``, in place of its facts, in any order."""
    added = warehouse_load.replace_days(
        spark,
        raw_packets(spark, args.lake).read(),
        Warehouse(spark, args.warehouse),
        args.day,
        args.last_day,
        half_open=args.half_open,
        scope=args.scope,
        at_hour=args.at_hour,
    )
    for table, rows in added.items():
        print(f"{table}: {rows} added")


def count(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    warehouse = Warehouse(spark, args.warehouse)
    warehouse.create()
    rows = warehouse_load.counts(warehouse).collect()  # five rows
    report = spark.createDataFrame(rows, "table_name string, n_rows long")
    report.show(truncate=False)
    return report


def check(spark: SparkSession, args: argparse.Namespace) -> None:
    found = warehouse_load.violations(
        Warehouse(spark, args.warehouse), args.day, args.last_day or args.day
    )
    with Staging(spark) as staging:
        staged = staging.write(found, "violations")
        print_all(staged.df)
    if staged.rows:
        raise SystemExit("the warehouse breaks its rules")


def publish(spark: SparkSession, args: argparse.Namespace) -> None:
    ingest.publish_day(spark, args.lake, args.day, half_open=args.half_open)
    stored = daily_aggregate(spark, args.lake).read()
    print_all(stored.where(stored.date == args.day.isoformat()))


def totals(spark: SparkSession, args: argparse.Namespace) -> None:
    """All users' KB of a day: into the folder ``--out``, else as text."""
    packets = raw_packets(spark, args.lake).read()
    sums = aggregates.user_totals(day_slice(packets, args.day, half_open=args.half_open))
    if args.out:
        sums.write.mode("overwrite").parquet(args.out)
    else:
        print_all(sums.orderBy("user_name"))


def pipeline(spark: SparkSession, args: argparse.Namespace) -> None:
    """Archive, count, ingest, load, count again, publish."""
    if args.archive:
        archive(spark, args)
    before = count(spark, args)
    ingest_files(spark, args)
    load(spark, args)
    after = count(spark, args)
    checks.count_changes(before, after).show(truncate=False)
    publish(spark, args)


def watch(spark: SparkSession, args: argparse.Namespace) -> None:
    """Minute files of new traffic files, until stopped."""
    packets = capture.read_capture_stream(
        spark, args.files[0], max_files=args.max_files, when_done=args.when_done
    )
    writer = capture.write_minute_files(
        packets, args.user, args.out, args.checkpoint, args.lateness
    )
    spark.streams.addListener(capture.LateRows())
    writer.trigger(processingTime="1 minute").start().awaitTermination()


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    """The minute files of a finished day as few files in ``--out``."""
    capture.compact_minute_files(spark, args.files[0], args.day, args.out)


def top(spark: SparkSession, args: argparse.Namespace) -> None:
    """The busiest pairs of new traffic files, until stopped. Never deletes files, as
    another job may still have to read them."""
    packets = capture.read_capture_stream(spark, args.files[0], max_files=args.max_files)
    writer = capture.write_top_pairs(
        packets, lambda df, _: df.show(truncate=False), args.checkpoint
    )
    writer.trigger(processingTime="1 minute").start().awaitTermination()


JOBS = {
    "archive": (archive, ["files", "archive"]),
    "ingest": (ingest_files, ["files", "lake"]),
    "load": (load, ["lake", "warehouse", "day"]),
    "replace": (replace, ["lake", "warehouse", "day"]),
    "backfill": (backfill, ["lake", "warehouse", "day", "last_day"]),
    "count": (count, ["warehouse"]),
    "check": (check, ["warehouse"]),
    "publish": (publish, ["lake", "day"]),
    "totals": (totals, ["lake", "day"]),
    "pipeline": (pipeline, ["files", "lake", "warehouse", "day"]),
    "compact": (compact, ["files", "day", "out"]),
    "watch": (watch, ["files", "user", "out", "checkpoint"]),
    "top": (top, ["files", "checkpoint"]),
}


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(fromfile_prefix_chars="@", description=__doc__)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--files", action="append", help="traffic files or folders")
    parser.add_argument("--archive", help="folder for gzip copies of the files")
    parser.add_argument("--lake", help="folder, or schema of the catalog, of raw packets and daily aggregate")
    parser.add_argument("--warehouse", help="location of the star schema")
    parser.add_argument("--day", type=dt.date.fromisoformat, help="yyyy-MM-dd")
    parser.add_argument("--last-day", type=dt.date.fromisoformat, help="yyyy-MM-dd")
    parser.add_argument("--replace", action="store_true", help="upsert by id, not append")
    parser.add_argument("--scope", default="per_user", choices=["per_user", "batch_latest"])
    parser.add_argument("--null-safe", action="store_true")
    parser.add_argument("--half-open", action="store_true")
    parser.add_argument("--allow-back-dated", action="store_true")
    parser.add_argument("--at-hour", action="store_true", help="facts get the user row of their hour")
    parser.add_argument("--user", help="user name in minute files")
    parser.add_argument("--out", help="folder for minute files or totals")
    parser.add_argument("--checkpoint", help="folder for stream checkpoints")
    parser.add_argument("--lateness", default="10 minutes")
    parser.add_argument("--max-files", type=int)
    parser.add_argument("--when-done", default="off", choices=["off", "delete"])
    args = parser.parse_args(argv)
    missing = [name for name in JOBS[args.job][1] if getattr(args, name) is None]
    if missing:
        parser.error(f"{args.job} needs --{' --'.join(missing)}".replace("_", "-"))
    return args


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    builder = SparkSession.builder.appName(f"wirestar-{args.job}")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    JOBS[args.job][0](builder.getOrCreate(), args)


if __name__ == "__main__":
    main()
