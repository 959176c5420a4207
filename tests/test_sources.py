import datetime as dt
import gzip

import pytest
from pyspark.sql import functions as F

from tests.conftest import HEADER, at, rows
from wirestar.operators.packet_ids import RepeatedKeys, with_file_ids
from wirestar.plans.ingest import NullsInPackets, ingest_files, publish_day
from wirestar.schemas import RAW_PACKETS
from wirestar.sources import reports
from wirestar.sources.tables import daily_aggregate, put_items, raw_packets
from wirestar.sources.traffic_files import archive_traffic, read_traffic


def write_gz(folder, name, *lines):
    with gzip.open(folder / name, "wt") as f:
        f.write(HEADER + "".join(line + "\n" for line in lines))
    return str(folder / name)


def line(user="ann", ts="2025-03-25 14:03", source="192.168.0.1", kb="1.5", total="9"):
    return f"{user},{ts},{source},1.1.1.1,{kb},{total}"


def test_read_types_and_nulls(spark, tmp_path):
    path = write_gz(
        tmp_path,
        "ann-2025-03-25.gz",
        line(),
        line(ts="2025-03-25 14:03:07.25", total=""),
        line(user="NULL"),
        line(user=""),
        line(user='""'),
        line(user='"a, b"'),
    )
    df = read_traffic(spark, path, days=True)
    assert dict(df.dtypes)["time_stamp"] == "timestamp_ntz"
    assert dict(df.dtypes)["bandwidth_kb"] == "float"
    got = df.collect()
    assert [r.user_name for r in got] == ["ann", "ann", None, None, None, "a, b"]
    assert got[1].time_stamp == at("2025-03-25 14:03:07.250")
    assert {r.file_day for r in got} == {dt.date(2025, 3, 25)}


@pytest.mark.parametrize("bad", [line(kb="much"), line(ts="yesterday"), "ann,2025-03-25 14:03"])
def test_row_that_does_not_fit_fails(spark, tmp_path, bad):
    path = write_gz(tmp_path, "x.gz", line(), bad)
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_traffic(spark, path).collect()


def test_row_numbers_follow_file_order(spark, staging, tmp_path):
    for user in ("ann", "bo", "cy"):
        write_gz(
            tmp_path,
            f"{user}-2025-03-25.gz",
            *(line(user, f"2025-03-25 14:{59 - i:02d}", kb=str(i)) for i in range(50)),
        )
    df = with_file_ids(read_traffic(spark, str(tmp_path), positions=True), staging).df
    assert rows(df, "id") == sorted(
        (f"{u}-2025-03-25 14:{59 - i:02d}-{i + 1}",) for u in ("ann", "bo", "cy") for i in range(50)
    )


def test_row_numbers_run_through_the_blocks_of_a_file(spark, staging, tmp_path):
    path = tmp_path / "big.csv"
    path.write_text(HEADER + "".join(line(kb=str(i)) + "\n" for i in range(3000)))
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = [spark.conf.get(n) for n in names]
    try:
        for name in names:
            spark.conf.set(name, "16384")
        df = with_file_ids(read_traffic(spark, str(path), positions=True), staging).df
        blocks = read_traffic(spark, str(path), positions=True)
        assert blocks.select("block_start").distinct().count() > 3
        numbers = df.select(
            F.regexp_extract("id", r"-(\d+)$", 1).cast("int").alias("n"), "bandwidth_kb"
        )
        assert sorted(tuple(r) for r in numbers.collect()) == [(i + 1, i) for i in range(3000)]
    finally:
        for name, value in zip(names, old):
            spark.conf.set(name, value)


def test_ingest_appends_or_replaces(spark, tmp_path):
    lake = str(tmp_path / "lake")
    files = tmp_path / "files"
    files.mkdir()
    path = write_gz(files, "ann-2025-03-25.gz", line(), line(ts="2025-03-26 00:00", kb="4"))
    table = raw_packets(spark, lake)
    ingest_files(spark, path, lake)
    assert table.read().count() == 2
    ingest_files(spark, path, lake)
    assert table.read().count() == 4, "appending is not idempotent"

    other = str(tmp_path / "other")
    ingest_files(spark, path, other, replace=True)
    path = write_gz(
        files, "ann-2025-03-25.gz", line(kb="7"), line(ts="2025-03-26 00:00", kb="4"), line()
    )
    ingest_files(spark, path, other, replace=True)
    assert rows(raw_packets(spark, other).read(), "id", "bandwidth_kb") == [
        ("ann-2025-03-25 14:03-1", 7.0),
        ("ann-2025-03-25 14:03-3", 1.5),
        ("ann-2025-03-26 00:00-2", 4.0),
    ]


def test_ingest_refuses_nulls_and_writes_nothing(spark, tmp_path):
    path = write_gz(tmp_path, "x.gz", line(), line(user="NULL"), line(source=""))
    lake = str(tmp_path / "lake")
    with pytest.raises(NullsInPackets, match="'user_name': 1.*'source_ip': 1"):
        ingest_files(spark, path, lake)
    assert raw_packets(spark, lake).read().count() == 0


def test_archive_keeps_the_rows(spark, tmp_path):
    path = tmp_path / "ann-2025-03-25.csv"
    path.write_text(HEADER + line() + "\n" + line(user="bo", ts="2025-03-25 14:04", total="") + "\n")
    archived = str(tmp_path / "archive" / "ann-2025-03-25")
    archive_traffic(spark, str(path), archived)
    assert rows(read_traffic(spark, archived, days=True)) == rows(
        read_traffic(spark, str(path), days=True)
    )


def test_raw_upsert_leaves_other_days_alone(spark, staging, tmp_path):
    table = raw_packets(spark, str(tmp_path))
    table.create()
    made = "SELECT 'ann' user_name, TIMESTAMP_NTZ '{0} 10:00:00' time_stamp, 's' source_ip,"
    made += " 'd' destination_ip, float({2}) bandwidth_kb, '{1}' id, DATE '{0}' partition_date"
    for record in (("2025-03-25", "a", 1), ("2025-03-25", "b", 2), ("2025-03-26", "c", 3)):
        table.append(spark.sql(made.format(*record)))
    untouched = table.read().where("id = 'c'").select("_metadata.file_path").first()[0]
    table.upsert(
        spark.sql(made.format("2025-03-25", "b", 9) + " UNION ALL " + made.format("2025-03-25", "z", 5)),
        ["partition_date", "id"],
        staging,
    )
    assert rows(table.read(), "id", "bandwidth_kb") == [("a", 1.0), ("b", 9.0), ("c", 3.0), ("z", 5.0)]
    assert table.read().where("id = 'c'").select("_metadata.file_path").first()[0] == untouched


def test_publish_day(spark, tmp_path):
    lake = str(tmp_path / "lake")
    path = write_gz(
        tmp_path, "x.gz", line(kb="1.75"), line(kb="2.75"), line(user="bo"), line(ts="2025-03-26 00:00")
    )
    ingest_files(spark, path, lake)
    day = dt.date(2025, 3, 25)
    for _ in range(2):
        publish_day(spark, lake, day)
    stored = daily_aggregate(spark, lake).read()
    assert [(u, d, int(k)) for u, d, k in rows(stored)] == [
        ("ann", "2025-03-25", 4),
        ("bo", "2025-03-25", 1),
    ]


class BufferedFiles:
    """A store of one file per item that holds items back until it is closed."""

    def __init__(self, folder):
        self.folder, self.held = folder, []

    def put(self, item):
        self.held.append(item["user_name"])

    def close(self):
        for name in self.held:
            with open(f"{self.folder}/{name}", "w") as f:
                f.write("x")


def test_put_items_closes_a_writer_that_buffers(spark, tmp_path):
    df = spark.range(300).selectExpr("'u' || id AS user_name").repartition(5)
    folder = str(tmp_path)
    put_items(df, lambda: BufferedFiles(folder), ["user_name"])
    assert {p.name for p in tmp_path.iterdir()} == {f"u{i}" for i in range(300)}


@pytest.mark.parametrize("when", ["open", "put", "close"])
def test_put_items_fails_with_its_writer(spark, when):
    class Broken:
        def __init__(self):
            self.fail("open")

        def fail(self, now):
            if now == when:
                raise OSError("store is away")

        def put(self, item):
            self.fail("put")

        def close(self):
            self.fail("close")

    with pytest.raises(Exception, match="store is away"):
        put_items(spark.range(3).selectExpr("'u' || id AS user_name"), Broken, ["user_name"])


def test_archive_keeps_earlier_days_under_their_names(spark, tmp_path):
    source, archive = tmp_path / "in", tmp_path / "2020-01-01"
    source.mkdir()
    first = write_gz(source, "ann-2025-03-25.gz", line())
    second = write_gz(source, "ann-2025-03-26.csv.gz", line(ts="2025-03-26 10:00"))
    archive_traffic(spark, first, str(archive))
    archive_traffic(spark, second, str(archive))
    archive_traffic(spark, first, str(archive))  # the same file again replaces itself
    names = sorted(p.name for p in archive.iterdir() if not p.name.startswith("."))
    assert names == ["ann-2025-03-25.csv.gz", "ann-2025-03-26.csv.gz"]
    days = read_traffic(spark, str(archive), days=True).select("file_day", "time_stamp").collect()
    assert sorted(str(r.file_day) for r in days) == ["2025-03-25", "2025-03-26"]
    other = tmp_path / "other"
    other.mkdir()
    with pytest.raises(ValueError, match="several files"):
        archive_traffic(spark, [first, write_gz(other, "ann-2025-03-25.gz", line())], str(archive))


def test_day_comes_from_the_file_not_from_its_folder(spark, tmp_path):
    folder = tmp_path / "2025-03-25"
    folder.mkdir()
    path = write_gz(folder, "undated.gz", line())
    assert read_traffic(spark, path, days=True).first().file_day is None


def test_upsert_refuses_a_batch_with_repeated_keys(spark, tmp_path, staging):
    table = raw_packets(spark, str(tmp_path))
    table.create()
    day = dt.date(2025, 3, 25)
    row = ("ann", dt.datetime(2025, 3, 25, 14), "a", "b", 1.0, "ann-1", day)
    batch = spark.createDataFrame([row, row], RAW_PACKETS)
    with pytest.raises(RepeatedKeys, match="ann-1"):
        table.upsert(batch, ["partition_date", "id"], staging)
    assert table.read().count() == 0


CONVERSATIONS = [
    "IPv4 Conversations",
    "                    |       <-      | |       ->      |",
    "10.0.0.2    <-> 10.0.0.9      1 60 bytes   2   120 bytes    3  2048 bytes   0.0",
    "10.0.0.9  \t <-> 10.0.0.2      1 60 bytes   2   120 bytes    3  12 kB   0.0",
    "10.0.0.3    <-> 10.0.0.2      1 60 bytes   2   120 bytes    3  2 MB   0.0",
    "10.0.0.3    <-> 10.0.0.2      1 60 bytes   2   120 bytes    3  2 GB   0.0",
    "10.0.0.3    <-> 10.0.0.2      1 60 bytes   2   120 bytes    3  5 bits   0.0",
    "10.0.0.4    <-> 10.0.0.2      1 60 bytes   2   120 bytes    3  many bytes",
    "10.0.0.5    <-> 10.0.0.2      1",
]


def test_conversation_report(spark, tmp_path):
    (tmp_path / "a.txt").write_text("\n".join(CONVERSATIONS) + "\n")
    parsed = reports.parse_conversations(reports.read_report_lines(spark, str(tmp_path)))
    got = parsed.orderBy("line_no").select("source_ip", "destination_ip", "bandwidth_kb", "unit_known")
    assert [tuple(r) for r in got.collect()] == [
        ("10.0.0.9", "10.0.0.2", 2.0, True),
        ("10.0.0.9", "10.0.0.2", 12.0, True),
        ("10.0.0.3", "10.0.0.2", 2048.0, True),
        ("10.0.0.3", "10.0.0.2", 2097152.0, True),
        ("10.0.0.3", "10.0.0.2", 5.0, False),
        ("10.0.0.4", "10.0.0.2", None, True),
        ("10.0.0.5", "10.0.0.2", None, None),
    ]
    only_bytes = reports.parse_conversations(
        reports.read_report_lines(spark, str(tmp_path)), only_bytes=True
    )
    assert only_bytes.agg(F.sum("bandwidth_kb")).first()[0] == 2.0 + 12 + 2 + 2 + 5


def test_protocol_report(spark, tmp_path):
    text = "Protocol Hierarchy Statistics\n\neth      frames:4 bytes:2048\n  ip  frames:4 bytes:2000\n"
    (tmp_path / "a.txt").write_text(text + "    eth  frames:1 bytes:512\n")
    (tmp_path / "b.txt").write_text("eth frames:1 bytes:100\n")
    lines = reports.read_report_lines(spark, str(tmp_path))
    assert rows(reports.capture_totals(lines), "total_kb_bandwidth") == [(100 / 1024,), (2.0,)]
    assert reports.parse_protocol_totals(lines).count() == 3
