"""Counts from the footers of Parquet files against counts of the rows."""

import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import rows
from wirestar.operators import checks
from wirestar.plans.warehouse_load import counts, run_day
from wirestar.sources.event_feed import read_packets
from wirestar.sources.tables import Warehouse, raw_packets


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_warehouse_counts_read_no_column(spark, sf_dir, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    packets = read_packets(spark, sf_dir)
    for day in (2, 3):
        run_day(spark, packets, warehouse, dt.date(2024, 1, day))
    by_footer = counts(warehouse)
    assert plan(by_footer).count("PushedAggregation: [COUNT(*)]") == 6  # users are two parts
    assert rows(by_footer) == rows(checks.table_counts(warehouse.tables()))
    assert all(r.n_rows > 0 for r in by_footer.collect())
    assert "PushedAggregation" not in plan(checks.table_counts(warehouse.tables()))


def test_no_files(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    warehouse.create()
    assert {r.n_rows for r in counts(warehouse).collect()} == {0}
    table = raw_packets(spark, str(tmp_path / "lake"))
    table.create()
    assert table.partition_counts().collect() == []


def test_days_of_a_stored_table(spark, sf_dir, tmp_path):
    table = raw_packets(spark, str(tmp_path / "lake"))
    table.create()
    packets = read_packets(spark, sf_dir).select(
        "*", F.uuid().alias("id"), F.to_date("time_stamp").alias("partition_date")
    )
    table.append(packets.select(*table.schema.names), compact=True)
    by_footer = table.partition_counts()
    assert rows(by_footer) == rows(table.read().groupBy("partition_date").count())
    assert "PushedGroupBy: [partition_date]" in plan(by_footer)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
