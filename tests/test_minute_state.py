"""The stateful minutes against batches over the same packets."""

import gzip
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tests.conftest import HEADER, rows
from tests.oracle_check import oracle_rows, spark_rows
from tests.test_streaming import line
from wirestar.operators import aggregates
from wirestar.sources.traffic_files import read_traffic
from wirestar.streaming import held_back, minute_state
from wirestar.streaming.minute_state import MinuteTables

NEWEST = 0


def put(folder, name, *lines):
    """A file newer than all before it, written where it stands."""
    global NEWEST
    folder.mkdir(exist_ok=True)
    data = (HEADER + "".join(text + "\n" for text in lines)).encode()
    (folder / name).write_bytes(gzip.compress(data) if name.endswith(".gz") else data)
    NEWEST += 1
    os.utime(folder / name, (1_700_000_000 + NEWEST, 1_700_000_000 + NEWEST))


class Feed:
    def __init__(self, spark, tmp_path):
        self.spark, self.folder = spark, tmp_path / "in"
        self.out, self.log = str(tmp_path / "out"), str(tmp_path / "log")
        self.checkpoint, self.shown = str(tmp_path / "checkpoint"), []
        self.tables = MinuteTables(spark, self.out)

    def run(self, hold=0, resume=None, show=False):
        packets = held_back.read_held_back(self.spark, str(self.folder), self.log, hold, 1)
        keep = (lambda df, n: self.shown.append((n, rows(df)))) if show else None
        minute_state.run_until_idle(minute_state.write_minute_state(
            packets, self.out, self.checkpoint, resume=resume, show=keep))


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


FIRST = [line("10:00:10"), line("10:00:50", "10.0.0.2", "10.0.0.1", "2"), line("10:01:05")]
SECOND = [line("10:01:30", kb="4"), line("10:30:00"), line("10:30:10", "10.0.0.7", kb="9")]
THIRD = [line("10:00:20", kb="5"), line("10:30:20", kb="8"), "ann,,10.0.0.1,10.0.0.2,7,0",
         line("11:30:00", kb="3")]


def test_newest_files_wait_for_newer_ones(feed):
    put(feed.folder, "c.csv", *FIRST)
    put(feed.folder, "b.csv.gz", *SECOND)
    feed.run(hold=2)
    assert feed.tables.packets_read().count() == 0
    put(feed.folder, "a.csv", *THIRD)
    feed.run(hold=2)
    assert rows(feed.tables.packets_read()) == [("c.csv", 3)]
    put(feed.folder, "d.csv", line("12:00:00"))
    feed.run(hold=2)
    feed.run(hold=2)
    assert rows(feed.tables.packets_read()) == [("b.csv.gz", 3), ("c.csv", 3)]
    feed.run(hold=0)
    assert rows(feed.tables.packets_read()) == [
        ("a.csv", 4), ("b.csv.gz", 3), ("c.csv", 3), ("d.csv", 1)]


def test_a_file_still_growing_is_read_when_whole(feed):
    put(feed.folder, "a.csv", *FIRST[:1])
    put(feed.folder, "b.csv", *SECOND)
    feed.run(hold=2)
    put(feed.folder, "a.csv", *FIRST)
    put(feed.folder, "c.csv", *THIRD)
    put(feed.folder, "d.csv", *THIRD)
    feed.run(hold=2)
    assert rows(feed.tables.packets_read()) == [("a.csv", 3), ("b.csv", 3)]


def test_log_repeats_a_batch_and_skips_what_it_names(tmp_path):
    folder = tmp_path / "in"
    put(folder, "a.csv", *FIRST)
    put(folder, "b.csv", *SECOND)
    held_back.AdmissionLog(str(tmp_path / "log")).write(0, ["b.csv"])

    def reader():
        return held_back.HeldBackReader(
            {"path": str(folder), "log": str(tmp_path / "log"), "hold": "0", "header": "true"})

    first = reader()
    assert first.initialOffset() == {"n": 0} and first.latestOffset() == {"n": 1}
    put(folder, "0.csv", *THIRD)
    again = reader()  # after a failure, with a file that sorts first
    part, = again.partitions({"n": 0}, {"n": 1})
    assert part.name == "a.csv"
    assert [v for b in again.read(part) for v in b["value"].to_pylist()] == FIRST
    assert again.latestOffset() == {"n": 2}
    assert [p.name for p in again.partitions({"n": 1}, {"n": 2})] == ["0.csv"]
    assert again.latestOffset() == {"n": 2} and again.partitions({"n": 2}, {"n": 2}) == []


def test_every_packet_is_closed_open_or_left_out(feed, spark):
    for name, lines in zip("abc", (FIRST, SECOND, THIRD)):
        put(feed.folder, f"{name}.csv", *lines)
    feed.run()
    left = feed.tables.left_out()
    assert rows(left, "reason", "bandwidth_kb") == [("late", 5.0), ("timeless", 7.0)]
    packets = read_traffic(spark, str(feed.folder))
    kept = packets.where("time_stamp is not null and bandwidth_kb != 5")
    want = aggregates.minute_pairs(kept)
    is_open = F.col("minute") >= F.lit("2024-01-02 11:20:00").cast("timestamp_ntz")
    assert rows(feed.tables.closed()) == rows(want.where(~is_open))
    assert rows(feed.tables.open_sums()) == rows(want.where(is_open))
    total = packets.agg(F.sum("bandwidth_kb")).first()[0]
    parts = feed.tables.closed().agg(F.sum("kb_bandwidth")), left.agg(F.sum("bandwidth_kb")), (
        feed.tables.open_sums().agg(F.sum("kb")))
    assert sum(p.first()[0] for p in parts) == total
    assert feed.tables.packets_read().agg(F.sum("n_rows")).first()[0] == packets.count()


def test_without_its_checkpoint_a_stream_goes_on(spark, tmp_path):
    whole, first, second = (Feed(spark, tmp_path / name) for name in ("whole", "first", "second"))
    for f in (whole, first, second):
        f.folder.parent.mkdir()
        f.folder = tmp_path / "in"
    put(whole.folder, "a.csv", *FIRST)
    put(whole.folder, "b.csv", *SECOND)
    first.run()
    put(whole.folder, "c.csv", *THIRD)
    whole.run()
    point = first.tables.resume_point("10 minutes")
    assert point.open_sums.count() == 2
    names = [r[0] for r in point.files.collect()]
    held_back.AdmissionLog(second.log).write(0, names)
    second.run(resume=point)
    both = first.tables.closed().unionByName(second.tables.closed())
    assert rows(both) == rows(whole.tables.closed())
    assert rows(second.tables.open_sums()) == rows(whole.tables.open_sums())
    assert rows(second.tables.left_out().drop("batch")) == rows(whole.tables.left_out().drop("batch"))


def test_busiest_pairs_of_the_minute_so_far(feed):
    many = [line("10:00:10", f"10.1.0.{i}", kb=str(i)) for i in range(1, 31)]
    more = [line("10:00:20", "10.1.0.3", kb="100"), line("10:00:30", "10.1.0.9", kb="1"),
            line("10:00:40", "10.2.0.1", kb="20")]
    put(feed.folder, "a.csv", *many)
    put(feed.folder, "b.csv", *more)
    put(feed.folder, "c.csv", line("10:20:00"))
    feed.run(show=True)
    sums = {f"10.1.0.{i}": float(i) for i in range(1, 31)}
    for batch, extra in ((0, {}), (1, {"10.1.0.3": 100.0, "10.1.0.9": 1.0, "10.2.0.1": 20.0})):
        for address, kb in extra.items():
            sums[address] = sums.get(address, 0.0) + kb
        want = sorted(sums.items(), key=lambda item: (-item[1], item[0]))[:15]
        top = feed.tables.top(batch).orderBy("place").collect()
        assert [(r["source_ip"], r["kb_bandwidth"]) for r in top] == want
        assert {r["total_kb_bandwidth"] for r in top} == {sum(sums.values())}
    minutes = {str(r["minute"]) for r in feed.tables.top(2).collect()}
    assert "2024-01-02 10:20:00" in minutes
    assert [n for n, _ in feed.shown][:3] == [0, 1, 2]


STREAMS = ["stream_held_back", "stream_left_out", "stream_resumed_minutes", "stream_top_pairs"]


@pytest.mark.parametrize("name", STREAMS)
def test_a_session_with_the_default_state_store_will_do(spark, tmp_path, name):
    """Days without KB, and events without a time, are in it."""
    events = spark.range(1, 1200).selectExpr(
        "id as event_id",
        "case when id % 41 > 0 then timestamp_ntz'2024-01-01 13:00:00'"
        " + make_dt_interval(0, 0, 0, id * 2160) end as ts",
        "id % 7 as user_id", "'view' as event_type",
        "case when id % 40 >= 5 then cast(id % 100 as double) end as value", "'{}' as props")
    events.write.parquet(str(tmp_path / "events.parquet"))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    before = spark.conf.get(minute_state.STATE_STORE)
    spark.conf.set(minute_state.STATE_STORE, minute_state.DEFAULT_STORE)
    try:
        got = spark_rows(contract.queries()[name](spark, str(tmp_path)))
        assert spark.conf.get(minute_state.STATE_STORE) == minute_state.DEFAULT_STORE
    finally:
        spark.conf.set(minute_state.STATE_STORE, before)
    assert got[1] and got == oracle_rows(duck, contract.oracle_sql()[name])


def test_a_pair_without_kb_has_no_sum(feed, spark):
    put(feed.folder, "a.csv", line("10:00:10", kb=""), line("10:00:10", "10.0.0.9", kb=""))
    put(feed.folder, "b.csv", line("10:00:20", "10.0.0.9", kb="3"), line("10:30:00"))
    put(feed.folder, "c.csv", line("11:00:00"))
    feed.run()
    packets = read_traffic(spark, str(feed.folder)).where("time_stamp < timestamp_ntz'2024-01-02 10:10'")
    closed = feed.tables.closed().where("minute < timestamp_ntz'2024-01-02 10:10'")
    assert rows(closed) == rows(aggregates.minute_pairs(packets))
    assert {r.kb_bandwidth for r in closed.collect()} == {None, 3.0}
