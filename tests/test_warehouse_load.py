"""The day load on stored tables: reruns, history, invariants."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from tests.conftest import PACKET_SCHEMA, at, rows
from wirestar.operators import checks
from wirestar.operators.slices import day_slice
from wirestar.plans.warehouse_load import (
    BackDatedBatch,
    counts,
    run_day,
    run_history,
    violations,
)
from wirestar.schemas import STAR_SCHEMA
from wirestar.sources.event_feed import read_packets
from wirestar.sources.tables import Warehouse

DAYS = [dt.date(2024, 1, d) for d in (2, 3)]


@pytest.fixture(scope="module")
def packets(spark, sf_dir):
    return read_packets(spark, sf_dir).persist()


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"))


def test_two_days(spark, packets, warehouse):
    for day in DAYS:
        added = run_day(spark, packets, warehouse, day)
        stored = warehouse.read("packets_fact").where(
            F.col("date_day") == int(f"{day:%Y%m%d}")
        )
        assert stored.count() == added["packets_fact"]
        raw = day_slice(packets, day).agg(F.sum("bandwidth_kb")).first()[0]
        assert stored.agg(F.sum("kb_bandwidth")).first()[0] == pytest.approx(raw)
    assert rows(violations(warehouse)) == []
    table = warehouse.tables()
    for name, rules in STAR_SCHEMA.items():
        assert table[name].schema == rules.schema
        if name != "date_dim":
            n = table[name].count()
            assert rows(table[name], rules.key) == sorted(((k,) for k in range(1, n + 1)), key=repr)


def test_rerun_adds_nothing_when_null_safe(spark, packets, warehouse):
    run_day(spark, packets, warehouse, DAYS[0], null_safe=True)
    before = counts(warehouse).collect()
    again = run_day(spark, packets, warehouse, DAYS[0], null_safe=True)
    assert set(again.values()) == {0}
    assert counts(warehouse).collect() == before


def test_rerun_adds_the_rows_without_user_again(spark, packets, warehouse):
    run_day(spark, packets, warehouse, DAYS[0])
    nobody = warehouse.read("packets_fact").where("user_key IS NULL").count()
    assert nobody > 0
    again = run_day(spark, packets, warehouse, DAYS[0])
    assert again.pop("packets_fact") == nobody
    assert set(again.values()) == {0}


def packet(user, ts, source, kb=1.0, destination="1.1.1.1"):
    return (user, at(ts), source, destination, kb)


def test_later_packets_of_a_loaded_hour_change_nothing(spark, warehouse):
    first = [packet("ann", "2024-01-02 08:05", "192.168.0.1")]
    more = first + [packet("ann", "2024-01-02 08:50", "192.168.0.1", 5.0)]
    for batch in (first, more):
        run_day(spark, spark.createDataFrame(batch, PACKET_SCHEMA), warehouse, DAYS[0])
    assert rows(warehouse.read("packets_fact"), "kb_bandwidth") == [(1.0,)]


def test_changed_address_then_older_day(spark, warehouse):
    feed = spark.createDataFrame(
        [
            packet("ann", "2024-01-02 08:05", "192.168.0.1"),
            packet("ann", "2024-01-03 08:05", "192.168.0.2"),
            packet("ann", "2024-01-03 23:59:59", "192.168.0.2"),
            packet("ann", "2024-01-03 23:59:59.5", "192.168.0.2", 7.0),
        ],
        PACKET_SCHEMA,
    )
    for day in DAYS:
        run_day(spark, feed, warehouse, day)
    users = sorted(warehouse.read("users_dim").collect())
    assert [(u.local_ip, u.start_date, u.end_date, u.current_flag) for u in users] == [
        ("192.168.0.1", at("2024-01-02 08:00"), at("2024-01-03 23:00"), False),
        ("192.168.0.2", at("2024-01-03 23:00"), None, True),
    ]
    # The last half second of a day is in no closed slice.
    assert warehouse.read("packets_fact").agg(F.sum("kb_bandwidth")).first()[0] == 3.0

    before = counts(warehouse).collect()
    with pytest.raises(BackDatedBatch):
        run_day(spark, feed, warehouse, DAYS[0])
    assert counts(warehouse).collect() == before
    # Allowed, it keys the old hours by the user's new row: they are loaded twice.
    added = run_day(spark, feed, warehouse, DAYS[0], allow_back_dated=True)
    assert added["packets_fact"] == 1


def test_several_days_as_one_batch(spark, packets, warehouse):
    added = run_day(spark, packets, warehouse, DAYS[0], DAYS[1])
    assert warehouse.read("packets_fact").select("date_day").distinct().count() == 2
    sliced = day_slice(packets, DAYS[0], DAYS[1])
    assert sliced.count() == day_slice(packets, DAYS[0]).count() + day_slice(packets, DAYS[1]).count()
    assert added["date_dim"] == warehouse.read("date_dim").count()
    assert rows(violations(warehouse)) == []


def test_failed_users_write_keeps_the_current_state(spark, packets, warehouse):
    run_day(spark, packets, warehouse, DAYS[0])
    state = rows(warehouse.read("users_dim"))
    broken = warehouse.read("users_dim").withColumn(
        "user_key", F.raise_error(F.lit("lost")).cast("int")
    )
    with pytest.raises(Exception, match="lost"):
        warehouse.replace_users(broken)
    assert rows(warehouse.read("users_dim")) == state


def test_day_edges(spark):
    feed = spark.createDataFrame(
        [
            packet("ann", ts, "192.168.0.1")
            for ts in (
                "2024-01-02 00:00:00",
                "2024-01-02 23:59:59",
                "2024-01-02 23:59:59.5",
                "2024-01-03 00:00:00",
            )
        ],
        PACKET_SCHEMA,
    )
    assert day_slice(feed, DAYS[0]).count() == 2
    assert day_slice(feed, DAYS[0], half_open=True).count() == 3
    assert day_slice(feed, DAYS[0], DAYS[1]).count() == 3
    assert day_slice(feed, DAYS[0], DAYS[1], half_open=True).count() == 4


def test_fact_days_prune(spark, packets, warehouse):
    run_day(spark, packets, warehouse, DAYS[0], DAYS[1])
    plan = warehouse.facts_between(20240103, 20240103)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_day" in text
    assert checks.table_counts(warehouse.tables()).count() == 5


@pytest.mark.parametrize("scope", ["per_user", "batch_latest"])
def test_history_equals_day_after_day(spark, packets, tmp_path, scope):
    days = [dt.date(2024, 1, d) for d in (2, 3, 4, 5)]
    singly = Warehouse(spark, str(tmp_path / "singly"))
    for day in days:
        run_day(spark, packets, singly, day, scope=scope)
    # Onto a day that is loaded already, and in two parts.
    at_once = Warehouse(spark, str(tmp_path / "at-once"))
    run_day(spark, packets, at_once, days[0], scope=scope)
    run_history(spark, packets, at_once, days[1], days[3], scope=scope)
    for table, df in singly.tables().items():
        assert rows(at_once.tables()[table]) == rows(df), table
    assert rows(violations(at_once)) == []
    with pytest.raises(BackDatedBatch):
        run_history(spark, packets, at_once, days[0], days[1], scope=scope)


def test_days_without_packets_add_nothing(spark, packets, warehouse):
    empty_day = dt.date(2024, 6, 2)
    added = run_day(spark, packets, warehouse, empty_day)
    assert added.pop("direction_dim") == 2
    assert set(added.values()) == {0}
    added = run_history(spark, packets, warehouse, empty_day, empty_day + dt.timedelta(days=2))
    assert set(added.values()) == {0}


def test_day_load_reads_no_other_fact_partition(spark, packets, warehouse):
    first = run_day(spark, packets, warehouse, DAYS[0])["packets_fact"]
    # A load of the next day must not read the facts of the first: make them unreadable.
    for path in glob.glob(f"{warehouse.location}/packets_fact/date_day=20240102/*.parquet"):
        with open(path, "wb") as f:
            f.write(b"not parquet")
    added = run_day(spark, packets, warehouse, DAYS[1])["packets_fact"]
    keys = warehouse.facts_between(20240103, 20240103).agg(F.min("packets_key"), F.max("packets_key"))
    assert added > 0 and tuple(keys.first()) == (first + 1, first + added)


def test_failure_between_mark_and_rows_never_repeats_a_key(spark, packets, warehouse, monkeypatch):
    def fail(self, table, rows, several_days=False):
        if table == "packets_fact":
            raise OSError("lost")
        return whole(self, table, rows, several_days)

    whole = Warehouse.append
    monkeypatch.setattr(Warehouse, "append", fail)
    with pytest.raises(OSError):
        run_day(spark, packets, warehouse, DAYS[0])
    monkeypatch.setattr(Warehouse, "append", whole)
    added = run_day(spark, packets, warehouse, DAYS[0])["packets_fact"]
    run_day(spark, packets, warehouse, DAYS[1])
    assert rows(violations(warehouse)) == []
    first = warehouse.facts_between(20240102, 20240102).agg(F.min("packets_key")).first()[0]
    assert first == added + 1  # a gap, as after a failed insert with a sequence


def test_users_versions_stay_bounded_and_closed_rows_are_written_once(spark, warehouse):
    warehouse.create()
    state = [(1, "ann", "192.168.0.1", at("2025-01-01"), None, True)]
    schema = STAR_SCHEMA["users_dim"].schema
    warehouse.replace_users(spark.createDataFrame(state, schema))
    for n in range(2, 6):
        closed = (n - 1, "ann", f"192.168.0.{n - 1}", at("2025-01-01"), at(f"2025-01-0{n}"), False)
        current = (n, "ann", f"192.168.0.{n}", at(f"2025-01-0{n}"), None, True)
        warehouse.replace_users(spark.createDataFrame([closed, current], schema))
    assert len(warehouse._versions()) == warehouse.keep
    assert [r[0] for r in rows(warehouse.current_users())] == [5]
    assert [r[0] for r in rows(warehouse.read("users_dim"))] == [1, 2, 3, 4, 5]
    newest = warehouse._versions()[-1]
    path = f"{warehouse.location}/users_dim/closed/version={newest}"
    assert spark.read.parquet(path).count() == 1
