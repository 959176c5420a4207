"""Raw ingest and the serving aggregate."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from wirestar.operators import aggregates
from wirestar.operators.packet_ids import with_file_ids
from wirestar.operators.slices import day_slice
from wirestar.sources.staging import Staging
from wirestar.sources.tables import ItemWriter, daily_aggregate, put_items, raw_packets
from wirestar.sources.traffic_files import read_traffic

class NullsInPackets(ValueError):
    """A required packet column holds NULLs."""


def ingest_files(
    spark: SparkSession, path: str | list[str], lake: str, replace: bool = False
) -> None:
    """Traffic files into the raw table. Appends, so ingesting a file twice doubles its
    rows; ``replace`` updates rows of equal id instead. A NULL in a required column
    fails the job before anything is written."""
    table = raw_packets(spark, lake)
    table.create()
    with Staging(spark) as staging:
        packets = with_file_ids(read_traffic(spark, path, positions=True), staging)
        broken = {column: n for column, n in packets.seen.items() if n}
        if broken:
            raise NullsInPackets(f"NULLs in required columns: {broken}")
        if replace:
            table.upsert(packets.df, ["partition_date", "id"], staging)
        else:
            table.append(packets.df)


def publish_day(
    spark: SparkSession,
    lake: str,
    day: dt.date,
    open_writer: Callable[[], ItemWriter] | None = None,
    half_open: bool = False,
) -> None:
    """KB per user of a day into the daily aggregate, replacing items of the same user
    and day; with ``open_writer`` into an external store as well. ``half_open`` is that of
    ``day_slice``."""
    packets = day_slice(raw_packets(spark, lake).read(), day, half_open=half_open)
    totals = aggregates.totals_of_day(packets, day)
    table = daily_aggregate(spark, lake)
    table.create()
    with Staging(spark) as staging:
        table.upsert(totals, ["date", "user_name"], staging)
    if open_writer is not None:
        stored = table.read().where(F.col("date") == day.isoformat())
        put_items(stored, open_writer, ["user_name", "date"])
