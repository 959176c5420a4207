"""Minute sums on the live capture feed.

New files in a folder are a stream: each is read once (the checkpoint's log is the seen
list) and a restart resumes open minutes from the state store, so nothing is counted
twice. Files must appear by rename, finished: the source reads a file when it sees it.

Windows go by event time. The watermark needs a zoned timestamp, so times pass as UTC
instants between ``with_event_time`` and ``closed_minutes`` and the session must be in UTC.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.readwriter import DataStreamWriter

from wirestar.functions import columns as C
from wirestar.operators.aggregates import address_pairs, minute_report, top_pairs
from wirestar.schemas import TRAFFIC_CSV
from wirestar.sources.traffic_files import CSV_OPTIONS

# Zone names without an offset from UTC.
UTC_NAMES = {"UTC", "Etc/UTC", "Z", "GMT", "+00:00"}


def read_capture_stream(
    spark: SparkSession,
    path: str,
    pattern: str | None = None,
    max_files: int | None = None,
    when_done: str = "off",
    archive: str | None = None,
) -> DataFrame:
    """Packets of the traffic files that appear under ``path``, oldest first.

    ``when_done`` is what happens to a processed file: ``off``, ``delete`` or
    ``archive`` (into that folder).
    """
    reader = spark.readStream.schema(TRAFFIC_CSV).options(**CSV_OPTIONS)
    reader = reader.option("latestFirst", "false").option("cleanSource", when_done)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("sourceArchiveDir", archive)
    return reader.csv(path).drop("total_bandwidth_kb")


def with_event_time(packets: DataFrame, lateness: str) -> DataFrame:
    zone = packets.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        raise ValueError(f"set spark.sql.session.timeZone to UTC for streams, not {zone}")
    timed = packets.withColumn("_event", F.col("time_stamp").cast("timestamp"))
    return timed.withWatermark("_event", lateness)


def _minute() -> Column:
    return F.window("_event", "1 minute").alias("_window")


def closed_minutes(sums: DataFrame) -> DataFrame:
    start = F.col("_window.start").cast("timestamp_ntz").alias("minute")
    return sums.select(start, *(c for c in sums.columns if c != "_window"))


def minute_pairs_stream(packets: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    """KB per minute and address pair, emitted when a minute closes."""
    return closed_minutes(
        address_pairs(with_event_time(packets, lateness))
        .groupBy(_minute(), "source_ip", "destination_ip")
        .agg(F.sum("bandwidth_kb").alias("kb_bandwidth"))
    )


def minute_totals_stream(packets: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    """KB per minute of all traffic, emitted when a minute closes."""
    return closed_minutes(
        with_event_time(packets, lateness)
        .groupBy(_minute())
        .agg(F.sum("bandwidth_kb").alias("total_kb_bandwidth"))
    )


def write_minute_files(
    packets: DataFrame,
    user_name: str,
    path: str,
    checkpoint: str,
    lateness: str = "10 minutes",
    rows_per_file: int = 1_000_000,
) -> DataStreamWriter:
    """A writer of closed minutes as traffic files (CSV, by day), to be started by the
    caller. A minute closes in one batch, so its total is known there. A batch writes one file
    for about ``rows_per_file`` rows, not one per task, into its own folder, which a repeated
    batch overwrites: no row is written twice."""

    def write(batch: DataFrame, batch_id: int) -> None:
        pairs = batch.persist()
        files = -(-max(1, pairs.count()) // rows_per_file)
        try:
            (
                minute_report(pairs)
                .select(
                    F.lit(user_name).alias("user_name"),
                    C.minute_text(F.col("minute")).alias("time_stamp"),
                    "source_ip",
                    "destination_ip",
                    F.col("kb_bandwidth").alias("bandwidth_kb"),
                    F.col("total_kb_bandwidth").alias("total_bandwidth_kb"),
                    F.to_date("minute").alias("partition_date"),
                    F.lit(batch_id).alias("batch"),
                )
                .repartitionByRange(files, "partition_date", "time_stamp")
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .option("header", "true")
                .partitionBy("partition_date", "batch")
                .csv(path)
            )
        finally:
            pairs.unpersist()

    return (
        minute_pairs_stream(packets, lateness)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )


def write_top_pairs(
    packets: DataFrame, show: Callable[[DataFrame, int], None], checkpoint: str, n: int = 15
) -> DataStreamWriter:
    """A writer that hands the busiest pairs of each batch of new files to ``show``."""

    def report(batch: DataFrame, batch_id: int) -> None:
        show(top_pairs(batch, n), batch_id)

    return packets.writeStream.option("checkpointLocation", checkpoint).foreachBatch(report)


class LateRows(StreamingQueryListener):
    """Counts, per query, the rows that came later than its lateness allows. Such rows are in
    no minute; each batch that has some says so."""

    def __init__(self, tell: Callable[[str], None] = print):
        self.tell, self.rows = tell, {}

    def onQueryStarted(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        late = sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)
        if late:
            query = str(event.progress.id)
            self.rows[query] = self.rows.get(query, 0) + late
            self.tell(f"batch {event.progress.batchId}: {late} rows too late, in no minute")

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...


def late_rows(query: StreamingQuery) -> int:
    """Rows that a query's recent batches left out as too late."""
    states = (s for p in query.recentProgress for s in p["stateOperators"])
    return sum(s["numRowsDroppedByWatermark"] for s in states)


def compact_minute_files(spark: SparkSession, path: str, day: dt.date, into: str) -> None:
    """The minute files of a finished day as few files under ``into``."""
    rows = spark.read.schema(TRAFFIC_CSV).options(**CSV_OPTIONS).csv(
        f"{path}/partition_date={day.isoformat()}/*"
    )
    rows = rows.hint("rebalance")
    target = f"{into}/partition_date={day.isoformat()}"
    rows.write.mode("overwrite").option("header", "true").csv(target)


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Process what is there and stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query
