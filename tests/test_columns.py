import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import at
from wirestar.functions import columns as C
from wirestar.operators.dimensions import date_attributes


def one(spark, expr, **values):
    df = spark.range(1)
    for name, (value, kind) in values.items():
        df = df.withColumn(name, F.lit(value).cast(kind))
    return df.select(expr).first()[0]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    # 02:30 does not exist in New York on this day.
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        ts = ("2024-03-10 02:30:45.5", "timestamp_ntz")
        assert one(spark, C.floor_hour(F.col("t")), t=ts) == at("2024-03-10 02:00:00")
        assert one(spark, C.floor_minute(F.col("t")), t=ts) == at("2024-03-10 02:30:00")
        assert one(spark, C.minute_text(F.col("t")), t=ts) == "2024-03-10 02:30"
        assert one(spark, C.date_key(F.col("t")), t=ts) == 2024031002
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "day, week, weekend",
    [
        ("2020-12-31", 53, False),
        ("2021-01-03", 53, True),
        ("2023-01-01", 52, True),
        ("2024-12-30", 1, False),
    ],
)
def test_iso_week_with_calendar_year(spark, day, week, weekend):
    hours = spark.sql(f"SELECT TIMESTAMP_NTZ '{day} 05:00:00' AS time_hour")
    row = date_attributes(hours).first()
    assert (row.date, row.year, row.week, row.hour) == (
        dt.date.fromisoformat(day),
        int(day[:4]),
        week,
        5,
    )
    assert row.is_weekend is weekend
    assert row.date_key == int(day.replace("-", "")) * 100 + 5


@pytest.mark.parametrize(
    "source, destination, key",
    [
        ("8.8.8.8", "192.168.0.1", 1),
        ("192.168.0.1", "8.8.8.8", 2),
        ("8.8.8.8", "1.1.1.1", 1),
        ("192.168.0.1", "192.168.0.2", None),
        ("10.0.0.1", "192.168.0.2", 1),  # 10/8 counts as external
        (None, "8.8.8.8", 2),
    ],
)
def test_external_key(spark, source, destination, key):
    expr = C.external_key(F.col("s"), F.col("d"), F.lit(1), F.lit(2))
    assert one(spark, expr, s=(source, "string"), d=(destination, "string")) == key


def test_direction_is_outbound_unless_the_source_is_the_users_own(spark):
    def label(source, local):
        expr = C.direction_label(F.col("s"), F.col("l"))
        return one(spark, expr, s=(source, "string"), l=(local, "string"))

    assert label("192.168.0.1", "192.168.0.1") == "inbound"
    assert label("192.168.0.1", "192.168.0.2") == "outbound"
    assert label("192.168.0.1", None) == "outbound"


def test_packet_id_is_null_with_any_part(spark):
    ts = ("2025-03-25 14:03:59", "timestamp_ntz")
    expr = C.packet_id(F.col("u"), F.col("t"), F.col("n"))
    assert one(spark, expr, u=("ann", "string"), t=ts, n=(7, "int")) == "ann-2025-03-25 14:03-7"
    assert one(spark, expr, u=(None, "string"), t=ts, n=(7, "int")) is None


@pytest.mark.parametrize("kb, whole", [(12.99, 12), (-12.99, -12), (0.2, 0)])
def test_whole_kb_truncates_toward_zero(spark, kb, whole):
    assert one(spark, C.whole_kb(F.col("k")), k=(kb, "double")) == whole


@pytest.mark.parametrize(
    "path, day",
    [
        ("file:/a/ann-2025-03-25.gz", dt.date(2025, 3, 25)),
        ("s3a://b/2024-01-01/ann-bo-2025-03-25.csv", dt.date(2025, 3, 25)),
        ("file:/a/ann.csv", None),
        ("file:/a/ann-2025-13-45.csv", None),
    ],
)
def test_day_in_name(spark, path, day):
    assert one(spark, C.day_in_name(F.col("p")), p=(path, "string")) == day


def test_rows_without_a_time_stay(spark):
    from tests.conftest import PACKET_SCHEMA, at, rows
    from wirestar.operators import aggregates

    packets = [("ann", None, "a", "b", 1.0), ("ann", at("2025-03-30T02:59:59.9"), "a", "b", 2.0)]
    df = spark.createDataFrame(packets, PACKET_SCHEMA)
    assert rows(aggregates.hourly(df), "time_hour", "bandwidth_kb_sum") == [
        (None, 1.0), (at("2025-03-30T02:00"), 2.0)
    ]
    assert rows(aggregates.minute_totals(df)) == [(None, 1.0), (at("2025-03-30T02:59"), 2.0)]
    report = aggregates.minute_report(aggregates.minute_pairs(df))
    assert rows(report, "minute", "total_kb_bandwidth") == [(None, 1.0), (at("2025-03-30T02:59"), 2.0)]
