"""Streams give the same minutes as batches over the same packets."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import HEADER, at, rows
from wirestar.operators import aggregates
from wirestar.sources.traffic_files import CSV_OPTIONS, read_traffic
from wirestar.streaming import capture


def drop(folder, name, *lines):
    """A finished file, by rename."""
    folder.mkdir(exist_ok=True)
    part = folder.parent / f".{name}"
    part.write_text(HEADER + "".join(line + "\n" for line in lines))
    part.rename(folder / name)


def line(ts, source="10.0.0.1", destination="10.0.0.2", kb="1"):
    return f"ann,2024-01-02 {ts},{source},{destination},{kb},0"


@pytest.fixture
def feed(tmp_path):
    folder = tmp_path / "in"
    drop(
        folder,
        "a.csv",
        line("10:00:10"),
        line("10:00:50", "10.0.0.2", "10.0.0.1", "2"),
        line("10:00:20", "10.0.0.3"),
        line("10:01:05"),
    )
    drop(folder, "b.csv", line("10:01:30", kb="4"), line("10:30:00"))
    return folder


def run(spark, writer, checkpoint):
    capture.run_available(writer.option("checkpointLocation", str(checkpoint)))


def to_table(spark, sums, tmp_path, name):
    out = str(tmp_path / name)
    writer = sums.writeStream.outputMode("append").format("parquet").option("path", out)
    run(spark, writer, tmp_path / f"{name}-checkpoint")
    return spark.read.schema(sums.schema).parquet(out)


def closed(df):
    return df.where(F.col("minute") < F.lit(at("2024-01-02 10:19")).cast("timestamp_ntz"))


def test_closed_minutes_equal_the_batch(spark, feed, tmp_path):
    batch = read_traffic(spark, str(feed))
    for name, stream, whole in (
        ("pairs", capture.minute_pairs_stream, aggregates.minute_pairs),
        ("totals", capture.minute_totals_stream, aggregates.minute_totals),
    ):
        source = capture.read_capture_stream(spark, str(feed), "*.csv")
        got = to_table(spark, stream(source), tmp_path, name)
        want = closed(whole(batch))
        assert rows(got) == rows(want.select(*got.columns)), name
        assert got.count() > 0


def test_restart_goes_on_where_it_stopped(spark, feed, tmp_path):
    def go():
        source = capture.read_capture_stream(spark, str(feed), max_files=1)
        return to_table(spark, capture.minute_pairs_stream(source), tmp_path, "out")

    go()
    # 10:30 was still open: its sum must go on from the state, not start again.
    drop(feed, "c.csv", line("10:30:20", kb="8"), line("11:30:00"))
    out = go()
    whole = aggregates.minute_pairs(read_traffic(spark, str(feed)))
    want = whole.where(F.col("minute") < F.lit(at("2024-01-02 11:19")).cast("timestamp_ntz"))
    assert rows(out) == rows(want.select(*out.columns))
    assert out.where("kb_bandwidth = 9").count() == 1


def test_processed_files_can_be_deleted(spark, feed, tmp_path):
    def go():
        source = capture.read_capture_stream(spark, str(feed), when_done="delete", max_files=1)
        return to_table(spark, capture.minute_pairs_stream(source), tmp_path, "out")

    go()
    drop(feed, "d.csv", line("11:30:00"))
    go()
    left = {p.name for p in feed.iterdir()}
    assert not {"a.csv", "b.csv"} & left


def test_minute_files_read_back_as_traffic(spark, feed, tmp_path):
    out = str(tmp_path / "files")
    for _ in range(2):  # a second run finds no new files and writes nothing
        source = capture.read_capture_stream(spark, str(feed))
        capture.run_available(
            capture.write_minute_files(source, "ann", out, str(tmp_path / "checkpoint"))
        )
    back = read_traffic(spark, out)
    batch = closed(aggregates.minute_pairs(read_traffic(spark, str(feed))))
    assert rows(back, "user_name", "time_stamp", "source_ip", "destination_ip", "bandwidth_kb") == rows(
        batch, F.lit("ann"), "minute", "source_ip", "destination_ip", "kb_bandwidth"
    )
    written = (
        spark.read.options(**CSV_OPTIONS)
        .schema("user string, ts string, s string, d string, kb double, total double")
        .csv(out)
    )
    assert rows(written, "ts", "total") == sorted(
        [
            ("2024-01-02 10:00", 4.0),
            ("2024-01-02 10:00", 4.0),
            ("2024-01-02 10:01", 5.0),
        ],
        key=repr,
    )
    folders = {p.name for p in (tmp_path / "files").iterdir() if p.is_dir()}
    assert folders == {"partition_date=2024-01-02"}


def test_top_pairs_of_each_batch(spark, feed, tmp_path):
    seen = []

    def show(top, batch_id):
        seen.append([tuple(r) for r in top.collect()])

    source = capture.read_capture_stream(spark, str(feed))
    capture.run_available(capture.write_top_pairs(source, show, str(tmp_path / "c"), n=1))
    assert seen == [[("10.0.0.2", "10.0.0.1", 9.0, 10.0)]]


def test_streams_need_a_utc_session(spark, feed):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        source = capture.read_capture_stream(spark, str(feed))
        with pytest.raises(ValueError, match="UTC"):
            capture.minute_pairs_stream(source)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_swapped_addresses_give_the_same_pairs(spark, sf_dir):
    from wirestar.sources.event_feed import read_packets

    packets = read_packets(spark, sf_dir)
    swapped = packets.withColumns(
        {"source_ip": F.col("destination_ip"), "destination_ip": F.col("source_ip")}
    )
    assert rows(aggregates.pair_totals(packets)) == rows(aggregates.pair_totals(swapped))
    day = dt.date(2024, 1, 2)
    totals = aggregates.totals_of_day(packets.where(F.to_date("time_stamp") == F.lit(day)), day)
    by_day = aggregates.totals_by_day(packets).where(F.col("date") == "2024-01-02")
    assert rows(totals) == rows(by_day)


def test_late_rows_are_counted_and_told(spark, tmp_path):
    folder = tmp_path / "late"
    told = []
    listener = capture.LateRows(told.append)
    spark.streams.addListener(listener)
    try:
        late = 0
        for name, ts in (("a.csv", "12:00:00"), ("b.csv", "10:00:00")):
            drop(folder, name, line(ts), line(ts, "10.0.0.9"))
            source = capture.read_capture_stream(spark, str(folder))
            writer = capture.write_minute_files(
                source, "ann", str(tmp_path / "out"), str(tmp_path / "late-checkpoint")
            )
            late += capture.late_rows(capture.run_available(writer))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    assert late == 2


def test_minute_files_of_a_batch_are_few_and_compact(spark, feed, tmp_path):
    out = str(tmp_path / "out")
    drop(feed, "c.csv", line("12:00:00"))
    source = capture.read_capture_stream(spark, str(feed))
    writer = capture.write_minute_files(source, "ann", out, str(tmp_path / "checkpoint"))
    capture.run_available(writer)
    day = tmp_path / "out" / "partition_date=2024-01-02"
    before = read_traffic(spark, f"{out}/*/*").drop("partition_date")
    batches = [p for p in day.iterdir() if p.is_dir()]
    assert all(len(list(b.glob("part-*"))) == 1 for b in batches)
    capture.compact_minute_files(spark, out, dt.date(2024, 1, 2), str(tmp_path / "compact"))
    after = read_traffic(spark, str(tmp_path / "compact" / "*"))
    assert rows(after) == rows(before) and rows(after)
