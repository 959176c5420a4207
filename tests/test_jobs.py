import datetime as dt
import gzip

import pytest

from tests.conftest import HEADER, rows
from wirestar import jobs
from wirestar.plans.warehouse_load import violations
from wirestar.sources.tables import Warehouse, daily_aggregate, raw_packets


def test_pipeline(spark, tmp_path, capsys):
    source = tmp_path / "ann-2025-03-25.gz"
    with gzip.open(source, "wt") as f:
        f.write(HEADER)
        for minute in range(10):
            f.write(f"ann,2025-03-25 14:{minute:02d},192.168.0.1,1.1.1.{minute},1.5,9\n")
    settings = tmp_path / "settings.txt"
    lake, warehouse = str(tmp_path / "lake"), str(tmp_path / "warehouse")
    settings.write_text(
        f"--files\n{source}\n--lake\n{lake}\n--warehouse\n{warehouse}\n--day\n2025-03-25\n"
        f"--archive\n{tmp_path / 'archive'}\n"
    )
    jobs.main(["pipeline", f"@{settings}"])
    shown = capsys.readouterr().out
    assert "packets_fact: 10 added" in shown and "PACKETS FACT COUNT" in shown

    tables = Warehouse(spark, warehouse)
    assert violations(tables).isEmpty()
    assert raw_packets(spark, lake).read().count() == 10
    assert [(u, d, int(k)) for u, d, k in rows(daily_aggregate(spark, lake).read())] == [
        ("ann", "2025-03-25", 15)
    ]
    tables.create_views()
    by_direction = spark.sql(
        "SELECT direction, count(*) AS n, sum(kb_bandwidth) AS kb FROM packets_fact"
        " JOIN direction_dim USING (direction_key) JOIN users_dim USING (user_key)"
        " WHERE user_name = 'ann' GROUP BY direction"
    )
    assert rows(by_direction) == [("inbound", 10, 15.0)]

    for job in ("check", "count"):
        jobs.main([job, "--warehouse", warehouse])
    for job in ("totals", "publish"):
        jobs.main([job, "--lake", lake, "--day", "2025-03-25"])
    assert "15.0" in capsys.readouterr().out


def test_missing_arguments_are_named(capsys):
    with pytest.raises(SystemExit):
        jobs.parse(["load", "--lake", "x"])
    assert "--warehouse --day" in capsys.readouterr().err
    args = jobs.parse(["load", "--lake", "x", "--warehouse", "y", "--day", "2025-03-25"])
    assert args.day == dt.date(2025, 3, 25)


def write_day(folder, users, day="2025-03-25", last_second=False):
    path = folder / f"many-{day}.gz"
    with gzip.open(path, "wt") as f:
        f.write(HEADER)
        for u in range(users):
            f.write(f"u{u:02d},{day} 14:00,192.168.0.{u},1.1.1.1,2,9\n")
        if last_second:
            f.write(f"u00,{day} 23:59:59.5,192.168.0.0,1.1.1.1,1,9\n")
    return str(path)


def test_totals_come_out_whole_and_half_open(spark, tmp_path, capsys):
    lake = str(tmp_path / "lake")
    jobs.main(["ingest", "--files", write_day(tmp_path, 50, last_second=True), "--lake", lake])
    capsys.readouterr()
    day = ["--lake", lake, "--day", "2025-03-25"]
    jobs.main(["totals", *day])
    shown = capsys.readouterr().out.splitlines()
    assert shown[1:] == [f"u{u:02d}\t2.0" for u in range(50)]
    jobs.main(["totals", *day, "--half-open", "--out", str(tmp_path / "totals")])
    sums = dict(rows(spark.read.parquet(str(tmp_path / "totals"))))
    assert sums == {f"u{u:02d}": 3.0 if u == 0 else 2.0 for u in range(50)}
    jobs.main(["publish", *day, "--half-open"])
    assert "u00\t2025-03-25\t3" in capsys.readouterr().out.replace("\r", "")


def test_backfill_equals_day_by_day(spark, tmp_path):
    lake, days = str(tmp_path / "lake"), ["2025-03-25", "2025-03-26"]
    files = [write_day(tmp_path, 3, day) for day in days]
    jobs.main(["ingest", "--files", files[0], "--files", files[1], "--lake", lake])
    one, other = str(tmp_path / "one"), str(tmp_path / "other")
    for day in days:
        jobs.main(["load", "--lake", lake, "--warehouse", one, "--day", day])
    jobs.main(["backfill", "--lake", lake, "--warehouse", other, "--day", days[0], "--last-day", days[1]])
    for name, table in Warehouse(spark, one).tables().items():
        assert rows(table) == rows(Warehouse(spark, other).tables()[name])
    jobs.main(["check", "--warehouse", other, "--day", days[1]])


def test_lake_by_table_names(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS traffic_test LOCATION '{tmp_path}/db'")
    try:
        path = write_day(tmp_path, 4)
        jobs.main(["ingest", "--files", path, "--lake", "traffic_test"])
        jobs.main(["ingest", "--files", path, "--lake", "traffic_test", "--replace"])
        assert spark.table("traffic_test.packets").count() == 4
        warehouse = str(tmp_path / "wh")
        day = ["--lake", "traffic_test", "--day", "2025-03-25"]
        jobs.main(["load", *day, "--warehouse", warehouse])
        jobs.main(["publish", *day])
        jobs.main(["publish", *day])
        assert spark.table("traffic_test.daily_aggregate").count() == 4
        assert violations(Warehouse(spark, warehouse)).isEmpty()
    finally:
        spark.sql("DROP DATABASE traffic_test CASCADE")
