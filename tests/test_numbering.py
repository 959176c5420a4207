"""Dense numbers against brute force, over several partitions."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wirestar.operators.numbering import last_key, number_rows


@pytest.fixture
def many_partitions(spark):
    names = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"]
    old = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "7")
    spark.conf.set(names[1], "false")
    yield
    for name, value in zip(names, old):
        spark.conf.set(name, value)


def test_ungrouped(spark, staging, many_partitions):
    df = spark.range(1000).select(((F.col("id") * 37) % 1000).alias("v"))
    numbered = number_rows(df, [F.desc("v")], "n", staging, start=5)
    assert numbered.rows == 1000
    assert rows(numbered.df, "n", "v") == sorted(((6 + i, 999 - i) for i in range(1000)), key=repr)
    staged = numbered.df.select(F.spark_partition_id()).distinct().count()
    assert staged > 1, "the sort must use several tasks"


def test_hot_group_spreads_over_tasks(spark, staging, many_partitions):
    # One group holds most rows, another is NULL.
    group = F.when(F.col("id") % 10 == 0, F.col("id") % 30).when(F.col("id") % 10 > 1, F.lit(7))
    df = spark.range(2000).select(group.alias("g"), "id")
    numbered = number_rows(df, [F.col("id")], "n", staging, group_by=["g"])
    want, seen = [], {}
    for g, i in sorted(((r.g, r.id) for r in df.collect()), key=lambda p: p[1]):
        seen[g] = seen.get(g, 0) + 1
        want.append((g, i, seen[g]))
    assert rows(numbered.df, "g", "id", "n") == sorted(want, key=repr)


def test_last_key(spark):
    assert last_key(spark.range(0), "id") == 0
    assert last_key(spark.range(4), "id") == 3
