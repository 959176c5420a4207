"""Minute sums with state of our own: what is open, what has closed, and what was left out.

Spark's windowed sums drop rows behind the watermark and rows without a time, show a minute only
when it closes, and start from nothing without their checkpoint. Here one stateful operator keeps
the pairs of a minute, by minute and lane (a hash of the pair, so that a busy minute is many
states), and gives rows of several kinds:

- ``running``: a pair's sum so far, after each batch that changes it, and by how much it grew
- ``closed``: a pair's sum when the watermark passes its minute's end; the state is dropped
- ``late``, ``timeless``: packets behind the watermark, or without a time, as they came
- ``read``: how many rows of which file the batch had

So every packet is in a closed minute, in an open one, or left out, and can be counted there.

``write_minute_state`` writes each batch's rows into a folder of its own, which a repeated batch
overwrites. From these a stream that has lost its checkpoint goes on: open sums become the initial
state, the watermark is known from the newest time seen, and the files read are not read again.
The busiest pairs of a minute so far are merged from those held and those that changed: traffic
is not negative, so a pair that did not change cannot rise.
"""

from __future__ import annotations

import contextlib
import threading
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.window import Window

from wirestar.operators.aggregates import address_pairs
from wirestar.streaming.capture import with_event_time

MINUTE = 60
#: States of one minute.
LANES = 16
#: What stands for the minute of packets without a time.
NO_TIME = -(2**63)

_OUT = (
    "kind string, start_us long, file_name string, user_name string, time_us long,"
    " source_ip string, destination_ip string, kb double, delta double, latest_us long"
)
_COLUMNS = [field.split()[0] for field in _OUT.split(", ")]
_TEXT = ["kind", "file_name", "user_name", "source_ip", "destination_ip"]
_WHOLE = ["start_us", "time_us", "latest_us"]
_REAL = ["kb", "delta"]
_STATE = "sources array<string>, destinations array<string>, kb array<double>"


def _plus(a: float | None, b: float | None) -> float | None:
    """As SQL sums: what is missing adds nothing, and the sum of nothing is missing. Pandas shows
    missing numbers as NaN."""
    a, b = (None if x is None or x != x else x for x in (a, b))
    return b if a is None else a if b is None else a + b


class MinuteSums(StatefulProcessor):
    """State of one minute and lane. ``floor_us`` is a watermark from before this stream."""

    def __init__(self, length_us: int, floor_us: int):
        self.length_us, self.floor_us = length_us, floor_us

    def init(self, handle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", _STATE)

    def _held(self) -> dict[tuple[str, str], float | None]:
        if not self.sums.exists():
            return {}
        sources, destinations, kb = self.sums.get()
        return dict(zip(zip(sources, destinations), kb))

    def _hold(self, start_us: int, sums: dict[tuple[str, str], float | None], new: bool) -> None:
        self.sums.update(([a for a, _ in sums], [b for _, b in sums], list(sums.values())))
        if new:
            self.handle.registerTimer((start_us + self.length_us) // 1000)

    @staticmethod
    def _rows(kind: str, columns) -> pd.DataFrame:
        """Rows in the shape of ``_OUT``; what a kind does not have is NULL."""
        found = pd.DataFrame(columns).assign(kind=kind).reindex(columns=_COLUMNS)
        text = found[_TEXT].astype(object)
        return found.assign(
            **text.where(text.notna(), None), **found[_WHOLE].astype("Int64"),
            **found[_REAL].astype("float64"),
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        start_us = int(key[0])
        closed_us = max(self.floor_us, 1000 * timerValues.getCurrentWatermarkInMs())
        if start_us == NO_TIME:
            kind = "timeless"
        else:
            kind = "late" if start_us + self.length_us <= closed_us else None
        grown: dict[tuple[str, str], float | None] = {}
        latest, read = NO_TIME, pd.Series(dtype="int64")
        for part in rows:
            read = read.add(part.groupby("file_name", dropna=False).size(), fill_value=0)
            if kind:
                yield self._rows(kind, part.drop(columns="lane"))
                continue
            latest = max(latest, int(part["time_us"].max()))
            for a, b, kb in zip(part["source_ip"], part["destination_ip"], part["kb"]):
                grown[a, b] = _plus(grown.get((a, b)), kb)
        yield self._rows(
            "read", {"file_name": list(read.index), "delta": read.to_numpy(dtype="float64")}
        )
        if kind:
            return
        held = self._held()
        new = not held
        for pair, kb in grown.items():
            held[pair] = _plus(held.get(pair), kb)
        self._hold(start_us, held, new)
        yield self._rows("running", {
            "source_ip": [a for a, _ in grown], "destination_ip": [b for _, b in grown],
            "kb": [held[pair] for pair in grown], "delta": list(grown.values()),
            "start_us": start_us, "latest_us": latest,
        })

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self._held()
        self.sums.clear()
        yield self._rows("closed", {
            "source_ip": [a for a, _ in held], "destination_ip": [b for _, b in held],
            "kb": list(held.values()), "start_us": int(key[0]),
        })

    def handleInitialState(self, key, initialState, timerValues) -> None:
        held = zip(initialState["source_ip"], initialState["destination_ip"], initialState["kb"])
        self._hold(int(key[0]), {(a, b): _plus(None, kb) for a, b, kb in held}, True)

    def close(self) -> None: ...


def _lane(lanes: int) -> Column:
    """Packets without a time have no state and may go anywhere."""
    of_pair = F.pmod(F.xxhash64("source_ip", "destination_ip"), F.lit(lanes)).cast("int")
    anywhere = (F.rand(0) * lanes).cast("int")
    return F.when(F.col("start_us") == NO_TIME, anywhere).otherwise(of_pair).alias("lane")


@dataclass(frozen=True)
class ResumePoint:
    """Where a stream that wrote under some path had come to: open sums, the watermark its next
    batch would have had, and the files it had read."""

    open_sums: DataFrame
    floor_us: int
    files: DataFrame


def minute_states(
    packets: DataFrame,
    lateness: str = "10 minutes",
    seconds: int = MINUTE,
    resume: ResumePoint | None = None,
    lanes: int = LANES,
) -> DataFrame:
    """The rows of all kinds, of a stream of packets. ``seconds`` is a minute's length; a row is
    late if its minute's end is not after the watermark."""
    if "file_name" not in packets.columns:
        packets = packets.withColumn("file_name", F.lit(None).cast("string"))
    length = 1_000_000 * seconds
    timed = with_event_time(address_pairs(packets), lateness)
    time_us = F.unix_micros("_event")
    start = F.coalesce(time_us - F.pmod(time_us, F.lit(length)), F.lit(NO_TIME))
    rows = timed.select(
        start.alias("start_us"), "file_name", "user_name", time_us.alias("time_us"), "source_ip",
        "destination_ip", F.col("bandwidth_kb").cast("double").alias("kb"),
    )
    rows = rows.withColumn("lane", _lane(lanes))
    initial = None
    if resume:
        held = resume.open_sums.select(F.unix_micros(
            F.col("minute").cast("timestamp")).alias("start_us"), "source_ip", "destination_ip", "kb")
        initial = held.withColumn("lane", _lane(lanes)).groupBy("start_us", "lane")
    return rows.groupBy("start_us", "lane").transformWithStateInPandas(
        statefulProcessor=MinuteSums(length, resume.floor_us if resume else NO_TIME),
        outputStructType=_OUT,
        outputMode="Update",
        timeMode="EventTime",
        initialState=initial,
    )


def _time(column: str) -> Column:
    return F.timestamp_micros(column).cast("timestamp_ntz")


class MinuteTables:
    """What ``write_minute_state`` has written under ``path``: a folder per batch, in it one per
    kind, and the busiest pairs so far."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self, kind: str) -> DataFrame:
        everything = self.spark.read.schema(_OUT + ", batch long").option("basePath", f"{self.path}/rows")
        return everything.parquet(f"{self.path}/rows").where(F.col("kind") == kind)

    def closed(self) -> DataFrame:
        """KB per closed minute and address pair."""
        return self.rows("closed").select(
            _time("start_us").alias("minute"), "source_ip", "destination_ip",
            F.col("kb").alias("kb_bandwidth"),
        )

    def left_out(self) -> DataFrame:
        """Packets that are in no minute, with the reason."""
        both = self.rows("late").unionByName(self.rows("timeless"))
        return both.select(
            "batch", F.col("kind").alias("reason"), "user_name", _time("time_us").alias("time_stamp"),
            "source_ip", "destination_ip", F.col("kb").alias("bandwidth_kb"),
        )

    def packets_read(self) -> DataFrame:
        """Rows read of each file."""
        return self.rows("read").groupBy("file_name").agg(
            F.sum("delta").cast("long").alias("n_rows")
        )

    def open_sums(self) -> DataFrame:
        """The last running sum of each pair whose minute has not closed."""
        keys = ["start_us", "source_ip", "destination_ip"]
        last = self.rows("running").groupBy(*keys).agg(F.max_by("kb", "batch").alias("kb"))
        done = self.rows("closed").select("start_us").distinct()
        return last.join(done, "start_us", "left_anti").select(
            _time("start_us").alias("minute"), "source_ip", "destination_ip", "kb"
        )

    def resume_point(self, lateness: str) -> ResumePoint:
        behind = self.spark.range(1).select(
            F.expr(f"unix_micros(timestamp'1970-01-01 00:00:00Z' + interval {lateness})")
        ).first()[0]
        latest = self.rows("running").agg(F.max("latest_us")).first()[0]
        files = self.rows("read").select("file_name").where("file_name is not null").distinct()
        return ResumePoint(self.open_sums(), NO_TIME if latest is None else latest - behind, files)

    def top(self, batch: int | None = None) -> DataFrame:
        """Batch, minute, place, pair, KB so far, and the minute's KB so far: of the open minutes
        after each batch."""
        found = self.spark.read.schema(_TOP + ", batch long").option("basePath", f"{self.path}/top")
        found = found.parquet(f"{self.path}/top")
        if batch is not None:
            found = found.where(F.col("batch") == batch)
        return found.withColumn("minute", _time("start_us")).drop("start_us")


_TOP = (
    "start_us long, place int, source_ip string, destination_ip string, kb_bandwidth double,"
    " total_kb_bandwidth double"
)


def _merge_top(tables: MinuteTables, batch_id: int, n: int) -> None:
    """The ``n`` busiest pairs of every open minute after a batch: from those held after the batch
    before, and the pairs that changed, of which only ``n`` a minute travel."""
    spark, folder = tables.spark, f"{tables.path}/top"
    now = tables.rows("running").where(F.col("batch") == batch_id)
    closed = tables.rows("closed").where(F.col("batch") == batch_id).select("start_us").distinct()
    held = spark.createDataFrame([], _TOP)
    if batch_id:
        held = spark.read.schema(_TOP).parquet(f"{folder}/batch={batch_id - 1}")
    pair = ["start_us", "source_ip", "destination_ip"]
    order = [F.desc("kb_bandwidth"), "source_ip", "destination_ip"]
    place = F.row_number().over(Window.partitionBy("start_us").orderBy(*order))
    changed = now.select(*pair, F.col("kb").alias("kb_bandwidth"))
    busiest = changed.withColumn("place", place).where(F.col("place") <= n).drop("place")
    # A held pair that changed is in ``now`` with its new sum, however it ranks there.
    unchanged = held.select(*pair, "kb_bandwidth").join(changed.select(*pair), pair, "left_anti")
    ranked = unchanged.unionByName(busiest).withColumn("place", place).where(F.col("place") <= n)
    grown = now.groupBy("start_us").agg(F.sum("delta").alias("kb"))
    before = held.where("place = 1").select("start_us", F.col("total_kb_bandwidth").alias("kb"))
    totals = grown.unionByName(before).groupBy("start_us").agg(
        F.sum("kb").alias("total_kb_bandwidth")
    )
    ranked = ranked.join(totals, "start_us").join(closed, "start_us", "left_anti")
    ranked = ranked.select(*(field.split()[0] for field in _TOP.split(", ")))
    ranked.repartition(1).write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")


#: Where Spark holds state of our own. Its default keeps one kind of state a store; timers are a
#: second.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
DEFAULT_STORE = (
    "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
)
ROCKS_DB_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_one_start = threading.Lock()


@contextlib.contextmanager
def _store_with_timers(spark: SparkSession) -> Iterator[None]:
    """RocksDB as the state store of a stream started in the block, where the session has the
    default. A stream takes its settings when it starts, so the session gets its own back."""
    with _one_start:
        before = spark.conf.get(STATE_STORE, None)
        if before not in (None, DEFAULT_STORE):
            yield
            return
        spark.conf.set(STATE_STORE, ROCKS_DB_STORE)
        try:
            yield
        finally:
            if before is None:
                spark.conf.unset(STATE_STORE)
            else:
                spark.conf.set(STATE_STORE, before)


class MinuteStateWriter(DataStreamWriter):
    """A writer whose stream finds a state store that holds timers, whatever the session has."""

    def start(self, *args, **options) -> StreamingQuery:
        with _store_with_timers(self._spark):
            return super().start(*args, **options)


def write_minute_state(
    packets: DataFrame,
    path: str,
    checkpoint: str,
    lateness: str = "10 minutes",
    seconds: int = MINUTE,
    resume: ResumePoint | None = None,
    show: Callable[[DataFrame, int], None] | None = None,
    n: int = 15,
) -> DataStreamWriter:
    """A writer of the rows of all kinds under ``path``, to be started by the caller. With
    ``show`` the ``n`` busiest pairs of the open minutes are kept too, and shown after each
    batch."""
    tables = MinuteTables(packets.sparkSession, path)

    def write(batch: DataFrame, batch_id: int) -> None:
        target = f"{path}/rows/batch={batch_id}"
        batch.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
            "kind").parquet(target)
        if show:
            _merge_top(tables, batch_id, n)
            show(tables.top(batch_id), batch_id)

    return (
        MinuteStateWriter(minute_states(packets, lateness, seconds, resume))
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )


def run_until_idle(writer: DataStreamWriter) -> None:
    """Process what there is, batch by batch, and stop."""
    query = writer.start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
