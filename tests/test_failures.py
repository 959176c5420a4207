"""What failures leave behind, and loads side by side."""

import datetime as dt
import glob
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wirestar.operators import aggregates
from wirestar.plans import warehouse_load
from wirestar.schemas import STAR_SCHEMA
from wirestar.sources import tables, traffic_files
from wirestar.sources.event_feed import read_packets
from wirestar.sources.staging import Staging
from wirestar.sources.tables import ChangedMeanwhile, Warehouse, raw_packets

KEYS = ["partition_date", "id"]
PACKETS = (
    "user_name string, time_stamp timestamp_ntz, source_ip string, destination_ip string,"
    " bandwidth_kb float, id string, partition_date date"
)


def packet(number, day=1, kb=1.0):
    at = dt.datetime(2024, 1, day, 10)
    return ("ann", at, "10.0.0.1", "10.0.0.2", kb, f"ann-{number}", at.date())


@pytest.fixture
def table(spark, tmp_path):
    """Two days, the first in three files."""
    made = raw_packets(spark, str(tmp_path / "lake"))
    made.create()
    for numbers in ((1, 2), (3, 4), (5, 6)):
        made.append(spark.createDataFrame([packet(n) for n in numbers], PACKETS).coalesce(1))
    made.append(spark.createDataFrame([packet(7, day=2)], PACKETS).coalesce(1))
    return made


def files(table):
    found = glob.glob(f"{table.path}/partition_date=*/*.parquet")
    return {os.path.basename(f) for f in found}


def change(spark, number, kb=9.0):
    return spark.createDataFrame([packet(number, kb=kb)], PACKETS)


def test_one_changed_id_rewrites_one_file(spark, table, staging):
    before = files(table)
    table.upsert(change(spark, 3), KEYS, staging)
    after = files(table)
    assert len(before - after) == 1 and len(before & after) == len(before) - 1
    want = [(f"ann-{n}", 9.0 if n == 3 else 1.0) for n in range(1, 8)]
    assert rows(table.read(), "id", "bandwidth_kb") == want
    assert not glob.glob(f"{table.path}/_swap-*")


def test_a_new_id_rewrites_no_file(spark, table, staging):
    before = files(table)
    table.upsert(change(spark, 8), KEYS, staging)
    assert before < files(table)
    assert table.read().count() == 8


def test_a_failure_before_the_swap_leaves_the_old_rows(spark, table, staging, monkeypatch):
    def fail(*_):
        raise OSError("no room")

    before, old = files(table), rows(table.read())
    with monkeypatch.context() as patched:
        patched.setattr(tables.PartitionedTable, "_plan_swap", fail)
        with pytest.raises(OSError):
            table.upsert(change(spark, 3), KEYS, staging)
    assert files(table) == before and rows(table.read()) == old
    table.upsert(change(spark, 3), KEYS, staging)
    assert table.read().where("bandwidth_kb = 9").count() == 1


@pytest.mark.parametrize("moves", [0, 1])
def test_a_swap_that_broke_off_is_completed(spark, table, staging, monkeypatch, moves):
    done, rename = [], tables._rename

    def breaks(fs, source, target):
        if "_plan" not in source.getName() and len(done) == moves:
            raise OSError("lost")
        if "_plan" not in source.getName():
            done.append(source)
        rename(fs, source, target)

    batch = change(spark, 3).unionByName(spark.createDataFrame([packet(7, 2, 9.0)], PACKETS))
    with monkeypatch.context() as patched:
        patched.setattr(tables, "_rename", breaks)
        with pytest.raises(OSError):
            table.upsert(batch, KEYS, staging)
    found = raw_packets(spark, os.path.dirname(table.path)).read()
    want = [(f"ann-{n}", 9.0 if n in (3, 7) else 1.0) for n in range(1, 8)]
    assert rows(found, "id", "bandwidth_kb") == want
    assert not glob.glob(f"{table.path}/_swap-*")


def test_staging_stays_after_an_error(spark):
    with pytest.raises(ValueError):
        with Staging(spark) as area:
            staged = area.write(spark.range(3), "rows")
            raise ValueError
    assert staged.df.count() == 3
    area.clear()


def test_a_failed_move_keeps_the_old_file_and_the_new_rows(spark, tmp_path, monkeypatch):
    out, move = str(tmp_path / "archive"), traffic_files._move
    name = F.lit("ann-2024-01-01")
    traffic_files.write_named(spark.range(2), name, out)

    def fail(fs, source, target):
        if source.getName().startswith("part-"):
            raise OSError("lost")
        move(fs, source, target)

    with monkeypatch.context() as patched:
        patched.setattr(traffic_files, "_move", fail)
        with pytest.raises(OSError):
            traffic_files.write_named(spark.range(5).coalesce(1), name, out)
    kept = spark.read.option("header", "true").csv(f"{out}/*.csv")
    assert kept.count() == 2
    assert spark.read.option("header", "true").csv(glob.glob(f"{out}/_work-*/*/part-*")).count() == 5
    traffic_files.write_named(spark.range(5), name, out)
    assert spark.read.option("header", "true").csv(glob.glob(f"{out}/*.csv")).count() == 5


def test_claims_of_many_loads_do_not_overlap(spark, tmp_path):
    handles = [Warehouse(spark, str(tmp_path / "warehouse")) for _ in range(8)]
    handles[0].create()

    def claim(handle):
        return [(handle.claim_keys("ip_dim", n), n) for n in range(1, 11)]

    with ThreadPoolExecutor(8) as pool:
        claims = sorted(c for found in pool.map(claim, handles) for c in found)
    assert claims[0][0] == 0
    assert [first + n for first, n in claims[:-1]] == [first for first, _ in claims[1:]]
    assert handles[0].last_key("ip_dim") == 8 * 55


def test_two_loads_at_once_use_no_key_twice(spark, sf_dir, tmp_path):
    packets, where = read_packets(spark, sf_dir), str(tmp_path / "warehouse")
    Warehouse(spark, where).create()

    def load(day):
        return warehouse_load.run_day(
            spark, packets, Warehouse(spark, where), day, allow_back_dated=True)

    days = [dt.date(2024, 1, 4), dt.date(2024, 1, 5)]
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(load, days))
    held = Warehouse(spark, where).tables()
    for name in Warehouse.KEYED:
        key = STAR_SCHEMA[name].key
        assert held[name].groupBy(key).count().where("count > 1").isEmpty(), name
    for name, column in (("ip_dim", "ip_address"), ("direction_dim", "direction")):
        assert held[name].groupBy(column).count().where("count > 1").isEmpty()
    day = F.to_date("time_stamp").isin(days)
    hours = aggregates.hourly(packets.where(day)).count()
    assert held["packets_fact"].count() == hours


def test_a_change_of_users_meanwhile_is_refused(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    warehouse.create()
    since = warehouse.users_version()
    warehouse.replace_users(warehouse.current_users(), since)
    with pytest.raises(ChangedMeanwhile):
        warehouse.replace_users(warehouse.current_users(), since)
