"""Loads in any order: day replacement that keeps keys, spliced versions, lookup at the hour."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import PACKET_SCHEMA, USER_SCHEMA, at, rows
from wirestar.operators import facts, history
from wirestar.operators.as_of import as_of
from wirestar.plans.warehouse_load import replace_days, run_day, violations
from wirestar.schemas import PACKETS_FACT
from wirestar.sources.event_feed import read_packets
from wirestar.sources.tables import PartitionedTable, Warehouse

DAYS = [dt.date(2024, 1, d) for d in (2, 3, 4, 5)]


def packet(user, ts, source, kb=1.0, destination="1.1.1.1"):
    return (user, at(ts), source, destination, kb)


@pytest.fixture
def feed(spark):
    """Ann changes her address on the second day and back on the fourth."""
    return spark.createDataFrame(
        [
            packet("ann", "2024-01-02 08:05", "192.168.0.1"),
            packet("ann", "2024-01-03 07:05", "192.168.0.1"),
            packet("ann", "2024-01-03 09:05", "192.168.0.2"),
            packet("ann", "2024-01-03 21:05", "192.168.0.2"),
            packet("ann", "2024-01-04 08:05", "192.168.0.2"),
            packet("ann", "2024-01-05 08:05", "192.168.0.1"),
            packet("bob", "2024-01-04 08:05", "192.168.0.9"),
            packet("guest", "2024-01-03 08:05", "8.8.8.8"),
            packet("other", "2024-01-03 08:05", "8.8.8.8", 2.0),
        ],
        PACKET_SCHEMA,
    )


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"))


def named(warehouse):
    """The star without its own keys."""
    t = warehouse.tables()
    users = t["users_dim"].select("user_key", "user_name", "start_date")
    ips = t["ip_dim"]
    fact = (
        t["packets_fact"]
        .join(users, "user_key", "left")
        .join(ips.toDF("source_ip_key", "source"), "source_ip_key")
        .join(ips.toDF("destination_ip_key", "destination"), "destination_ip_key")
    )
    columns = ["user_name", "start_date", "source", "destination", "date_key", "direction_key", "kb_bandwidth"]
    return rows(t["users_dim"].drop("user_key")), rows(fact.select(*columns))


def test_replay_after_an_address_change(spark, feed, warehouse):
    for day in DAYS[:2]:
        run_day(spark, feed, warehouse, day, null_safe=True)
    stored = rows(warehouse.read("packets_fact"))
    users = rows(warehouse.read("users_dim"))
    for day in DAYS[:2]:
        files = warehouse.facts_between(20240101, 20240131).inputFiles()
        assert set(replace_days(spark, feed, warehouse, day).values()) == {0}
        assert sorted(warehouse.facts_between(20240101, 20240131).inputFiles()) == sorted(files)
    assert rows(warehouse.read("packets_fact")) == stored
    assert rows(warehouse.read("users_dim")) == users


def test_replay_with_more_and_fewer_packets(spark, feed, warehouse):
    run_day(spark, feed, warehouse, DAYS[0], DAYS[1])
    before = {tuple(r)[1:]: r.packets_key for r in warehouse.read("packets_fact").drop("date_day").collect()}
    gone = feed.where("user_name <> 'other'").union(
        spark.createDataFrame([packet("ann", "2024-01-03 21:30", "192.168.0.2", 4.0),
                               packet("ann", "2024-01-03 22:30", "192.168.0.2", 3.0)], PACKET_SCHEMA)
    )
    added = replace_days(spark, gone, warehouse, DAYS[1])
    assert added["packets_fact"] == 1
    now = warehouse.read("packets_fact")
    keys = [r.packets_key for r in now.collect()]
    assert len(keys) == len(set(keys)) == len(before)  # one row gone, one new
    kept = {tuple(r)[1:]: r.packets_key for r in now.drop("date_day").collect()}
    same = set(before) & set(kept)
    assert len(same) == len(before) - 2 and all(before[r] == kept[r] for r in same)
    larger = now.where("kb_bandwidth = 5").first()
    assert larger.packets_key in before.values()  # more bandwidth, the same key
    assert rows(violations(warehouse)) == []


def test_days_in_any_order_give_the_star_of_the_right_order(spark, tmp_path, feed):
    straight = Warehouse(spark, str(tmp_path / "straight"))
    for day in DAYS:
        run_day(spark, feed, straight, day)
    mixed = Warehouse(spark, str(tmp_path / "mixed"))
    for n in (2, 0, 3, 1):
        replace_days(spark, feed, mixed, DAYS[n])
    assert named(mixed)[0] == named(straight)[0]
    replace_days(spark, feed, mixed, DAYS[0], DAYS[-1])
    assert named(mixed) == named(straight)
    assert rows(violations(mixed)) == []


def test_older_batch_into_a_warehouse_of_plain_loads(spark, tmp_path):
    packets = read_packets(spark, "/root/testdata/sf0.001").persist()
    straight, mixed = (Warehouse(spark, str(tmp_path / n)) for n in ("straight", "mixed"))
    for day in DAYS:
        run_day(spark, packets, straight, day)
    for day in (DAYS[0], DAYS[3]):
        run_day(spark, packets, mixed, day)
    replace_days(spark, packets, mixed, DAYS[1], DAYS[2])
    assert named(mixed)[0] == named(straight)[0]
    replace_days(spark, packets, mixed, DAYS[3])
    assert named(mixed) == named(straight)


def test_lookup_at_the_hour(spark, feed, warehouse):
    replace_days(spark, feed, warehouse, DAYS[0], DAYS[-1], at_hour=True)
    users = warehouse.read("users_dim").select("user_key", "local_ip")
    found = warehouse.read("packets_fact").join(users, "user_key", "left")
    got = dict(rows(found.where("local_ip <> '192.168.0.9'"), "date_key", "local_ip"))
    first, second = "192.168.0.1", "192.168.0.2"
    assert got == {2024010208: first, 2024010307: first, 2024010309: second, 2024010321: second,
                   2024010408: second, 2024010508: first}
    assert found.where("user_key IS NULL").count() == 2


def test_broken_swap_of_a_day_is_completed(spark, feed, warehouse, monkeypatch):
    run_day(spark, feed, warehouse, DAYS[1])
    more = feed.union(spark.createDataFrame([packet("ann", "2024-01-03 23:30", "192.168.0.2")], PACKET_SCHEMA))
    finish, calls = PartitionedTable.finish_swaps, []

    def lost(self):
        if calls:
            raise OSError("lost")
        finish(self)

    def planned(self, work, old, plan=PartitionedTable._plan_swap):
        plan(self, work, old)
        calls.append(work)

    monkeypatch.setattr(PartitionedTable, "finish_swaps", lost)
    monkeypatch.setattr(PartitionedTable, "_plan_swap", planned)
    with pytest.raises(OSError):
        replace_days(spark, more, warehouse, DAYS[1])
    monkeypatch.undo()
    now = rows(warehouse.read("packets_fact"), "packets_key")
    assert len(now) == len(set(now)) == 6
    assert set(replace_days(spark, more, warehouse, DAYS[1]).values()) == {0}


def test_days_without_packets_empty_the_day(spark, feed, warehouse):
    run_day(spark, feed, warehouse, DAYS[0])
    replace_days(spark, feed.where("false"), warehouse, DAYS[0])
    assert warehouse.read("packets_fact").count() == 0
    assert warehouse.read("users_dim").count() == 1


def test_runs_equal_a_walk_through_the_observations(spark, staging):
    rng = random.Random(7)
    seen = [
        (u, at(f"2024-01-{d:02d} {rng.randrange(24):02d}:00"), f"192.168.0.{rng.randrange(3)}")
        for u in ("a", "b", None) for d in rng.sample(range(1, 29), 20)
    ]
    rng.shuffle(seen)
    schema = "user_name string, start_date timestamp_ntz, local_ip string, first_seen timestamp_ntz"
    state, key = spark.createDataFrame([], USER_SCHEMA), 0
    loaded = []
    for part in (seen[:20], seen[20:45], seen[45:]):
        loaded += part
        observed = spark.createDataFrame([(*s, s[1]) for s in loaded], schema)
        spliced = history.splice_versions(state, observed, key, staging)
        new = staging.write(spliced.df.drop("since"), "state").df
        lost = state.join(new, "user_key", "left_anti").count()
        assert lost == 0  # a stored version stays, or its key would be missing in facts
        state, key = new, key + spliced.rows
    want = []
    for _, group in itertools.groupby(sorted(seen, key=lambda s: (str(s[0]), s[1])), lambda s: s[0]):
        runs = [next(g) for _, g in itertools.groupby(group, lambda s: s[2])]
        ends = [r[1] for r in runs[1:]] + [None]
        want += [(u, ip, t, end, end is None) for (u, t, ip), end in zip(runs, ends)]
    assert rows(state.drop("user_key")) == sorted(want, key=repr)


def test_as_of_equals_a_search(spark):
    rng = random.Random(3)

    def moment():
        return None if rng.random() < 0.05 else at("2024-01-01") + dt.timedelta(hours=rng.randrange(200))

    users = ["hot"] * 6 + ["a", "b", None]
    versions = [(rng.choice(users), moment(), n) for n in range(60)]
    asked = sorted({(rng.choice([*users, "nobody"]), moment()) for _ in range(400)}, key=repr)
    found = as_of(
        spark.createDataFrame(asked, "u string, h timestamp_ntz"),
        spark.createDataFrame(versions, "u string, since timestamp_ntz, n int"),
        "u", "h", "since", ["n"],
    )

    def search(user, hour):
        begun = [
            (since or dt.datetime.min, n) for u, since, n in versions
            if u == user and (since is None or (hour is not None and since <= hour))
        ]
        return max(begun, default=(None, None))[1]

    assert rows(found) == sorted(((u, h, search(u, h)) for u, h in asked), key=repr)


def test_same_rows_without_a_user_keep_a_key_each(spark):
    schema = PACKETS_FACT.simpleString()[7:-1]
    held = spark.createDataFrame([(n, None, 1, 2, 1, 2024010208, 2, kb) for n, kb in ((1, 9.0), (2, 5.0), (3, 5.0))], schema)
    again = held.drop("packets_key").where("kb_bandwidth < 9").union(
        spark.createDataFrame([(None, 1, 2, 1, 2024010209, 2, 1.0)], held.drop("packets_key").schema)
    )
    got = facts.with_held_keys(held, again)
    assert rows(got, "packets_key", "kb_bandwidth") == sorted([(2, 5.0), (3, 5.0), (None, 1.0)], key=repr)
    larger = again.withColumn("kb_bandwidth", F.col("kb_bandwidth") + 1)
    got = facts.with_held_keys(held, larger)
    assert rows(got, "packets_key", "kb_bandwidth") == sorted([(1, 6.0), (2, 6.0), (None, 2.0)], key=repr)
    none = facts.with_held_keys(held.where(F.lit(False)), again)
    assert none.where("packets_key IS NULL").count() == 3
