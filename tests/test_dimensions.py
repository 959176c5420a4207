"""Golden cases of the incremental dimension loads."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import HOUR_SCHEMA, USER_SCHEMA, at, rows
from wirestar.operators import aggregates, dimensions
from wirestar.schemas import DATE_DIM, DIRECTION_DIM, IP_DIM, USERS_DIM, empty


def hours(spark, *records):
    data = [(at(h), u, s, d, 1.0) for h, u, s, d in records]
    return spark.createDataFrame(data, HOUR_SCHEMA)


def users(spark, *records):
    data = [
        (k, u, ip, at(start), at(end) if end else None, current)
        for k, u, ip, start, end, current in records
    ]
    return spark.createDataFrame(data, USER_SCHEMA)


def latest(batch, scope="per_user"):
    return aggregates.in_scope(aggregates.latest_local_ip(batch), scope)


HELD = [
    (1, "ann", "192.168.0.1", "2024-01-01 20:00", None, True),
    (2, "bo", "192.168.0.2", "2023-12-01 20:00", "2024-01-01 21:00", False),
    (3, "bo", "192.168.0.3", "2024-01-01 21:00", None, True),
]


def test_scd2_new_changed_and_same(spark, staging):
    batch = hours(
        spark,
        ("2024-01-02 08:00", "ann", "192.168.0.1", "1.1.1.1"),  # same
        ("2024-01-02 09:00", "bo", "192.168.0.4", "1.1.1.1"),  # changed
        ("2024-01-02 10:00", "cy", "192.168.0.5", "1.1.1.1"),  # new
        ("2024-01-02 11:00", "di", "8.8.8.8", "192.168.0.6"),  # no private source
    )
    state = dimensions.next_users(users(spark, *HELD), latest(batch), 3, staging)
    assert state.rows == 2
    want = [
        *HELD[:2],
        (3, "bo", "192.168.0.3", "2024-01-01 21:00", "2024-01-02 09:00", False),
        (4, "bo", "192.168.0.4", "2024-01-02 09:00", None, True),
        (5, "cy", "192.168.0.5", "2024-01-02 10:00", None, True),
    ]
    assert rows(state.df) == rows(users(spark, *want))
    again = dimensions.next_users(state.df, latest(batch), 5, staging)
    assert again.rows == 0
    assert rows(again.df) == rows(state.df)


def test_scd2_start_is_the_last_hour_seen(spark):
    batch = hours(
        spark,
        ("2024-01-02 08:00", "ann", "192.168.0.9", "1.1.1.1"),
        ("2024-01-02 17:00", "ann", "192.168.0.9", "1.1.1.1"),
    )
    changes = dimensions.user_changes(users(spark, *HELD), latest(batch))
    assert rows(changes) == [("ann", "192.168.0.9", at("2024-01-02 17:00"), 1)]


def test_ties_go_to_the_smallest_address(spark):
    batch = hours(
        spark,
        ("2024-01-02 17:00", "bo", "192.168.0.7", "1.1.1.1"),
        ("2024-01-02 17:00", "bo", "192.168.0.5", "1.1.1.1"),
        ("2024-01-02 16:00", "bo", "192.168.0.1", "1.1.1.1"),
        ("2024-01-02 17:00", "ann", "192.168.0.9", "1.1.1.1"),
        ("2024-01-02 18:00", "ann", "8.8.8.8", "192.168.0.9"),
    )
    assert rows(aggregates.latest_local_ip(batch)) == [
        ("ann", "192.168.0.9", at("2024-01-02 17:00")),
        ("bo", "192.168.0.5", at("2024-01-02 17:00")),
    ]
    assert rows(latest(batch, "batch_latest")) == [
        ("ann", "192.168.0.9", at("2024-01-02 17:00"))
    ]
    with pytest.raises(ValueError):
        latest(batch, "all")


def test_batch_latest_versions_one_user_only(spark, staging):
    batch = hours(
        spark,
        ("2024-01-02 08:00", "ann", "192.168.0.8", "1.1.1.1"),
        ("2024-01-02 09:00", "bo", "192.168.0.4", "1.1.1.1"),
    )
    state = dimensions.next_users(
        users(spark, *HELD), latest(batch, "batch_latest"), 3, staging
    )
    current = state.df.where("current_flag")
    assert rows(current, "user_name", "local_ip") == [("ann", "192.168.0.1"), ("bo", "192.168.0.4")]


def test_back_dated_batch_is_seen(spark):
    late = hours(spark, ("2023-12-30 08:00", "ann", "192.168.0.8", "1.1.1.1"))
    same = hours(spark, ("2024-01-01 20:00", "ann", "192.168.0.8", "1.1.1.1"))
    held = users(spark, *HELD)
    assert rows(dimensions.back_dated(held, latest(late)), "user_name") == [("ann",)]
    assert dimensions.back_dated(held, latest(same)).isEmpty()


def test_scd2_versions_never_overlap(spark, staging):
    state, last = empty(spark, USERS_DIM), 0
    for day, address in enumerate("1221344"):
        batch = hours(
            spark,
            (f"2024-01-0{day + 1} 08:00", "ann", f"192.168.0.{address}", "1.1.1.1"),
            (f"2024-01-0{day + 1} 09:00", "bo", f"192.168.1.{int(address) % 2}", "1.1.1.1"),
        )
        step = dimensions.next_users(state, latest(batch), last, staging)
        state, last = staging.write(step.df, "state").df, last + step.rows
    assert rows(state, "user_key") == sorted(((k,) for k in range(1, last + 1)), key=repr)
    for user in ("ann", "bo"):
        versions = sorted(
            state.where(F.col("user_name") == user).collect(), key=lambda r: r.start_date
        )
        assert [v.current_flag for v in versions] == [False] * (len(versions) - 1) + [True]
        for one, following in zip(versions, versions[1:]):
            assert one.end_date == following.start_date
            assert one.local_ip != following.local_ip


def test_new_dates_of_a_batch_over_two_days(spark):
    first = hours(spark, ("2024-01-02 23:00", "ann", "a", "b"))
    both = hours(
        spark,
        ("2024-01-02 23:00", "ann", "a", "b"),
        ("2024-01-02 23:00", "bo", "a", "b"),
        ("2024-01-03 00:00", "ann", "a", "b"),
    )
    held = dimensions.new_dates(empty(spark, DATE_DIM), first)
    assert rows(dimensions.new_dates(held, both), "date_key") == [(2024010300,)]
    assert dimensions.new_dates(held, both).schema == held.schema


def test_new_addresses_skip_nulls_and_known_ones(spark, staging):
    batch = hours(
        spark,
        ("2024-01-02 08:00", "ann", "c", "b"),
        ("2024-01-02 08:00", "ann", "b", None),
        ("2024-01-02 08:00", "ann", None, "a"),
        ("2024-01-02 08:00", "ann", "d", "a"),
    )
    held = spark.createDataFrame([(7, "b")], IP_DIM)
    new = dimensions.keyed_addresses(dimensions.new_addresses(held, batch), 7, staging)
    assert sorted(rows(new.df)) == [(8, "a"), (9, "c"), (10, "d")]


@pytest.mark.parametrize(
    "held, want",
    [
        ([], [(1, "inbound"), (2, "outbound")]),
        ([(1, "inbound")], [(2, "outbound")]),
        ([(1, "outbound")], [(2, "inbound")]),
        ([(1, "inbound"), (2, "outbound")], []),
    ],
)
def test_new_directions(spark, held, want):
    table = spark.createDataFrame(held, DIRECTION_DIM)
    assert rows(dimensions.new_directions(table)) == want
