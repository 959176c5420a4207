"""Lookups give the same rows whichever way they run."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wirestar.operators.lookups import Sized, hot_keys, left_lookup


@pytest.fixture
def data(spark):
    # A third of the rows share one key, a fifth have none, some match nothing.
    key = (
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 5 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 50))
    )
    facts = spark.range(900).select("id", key.alias("k"))
    dim = spark.range(45).select(F.concat(F.lit("k"), "id").alias("name"), "id").union(
        spark.sql("SELECT 'hot', 99L")
    )
    return facts, dim.withColumnRenamed("id", "v")


def test_broadcast_plain_and_salted_agree(data):
    facts, dim = data
    base = Sized(facts, 900)
    want = rows(facts.join(dim, facts.k == dim.name, "left"))
    ways = {
        "broadcast": left_lookup(facts, Sized(dim, 46), ["k"], ["name"], base),
        "unknown": left_lookup(facts, Sized(dim), ["k"], ["name"], base),
        "salted": left_lookup(
            facts, Sized(dim, 46), ["k"], ["name"], base, broadcast_bytes=0, hot_share=0.1, salts=5
        ),
    }
    for way, df in ways.items():
        assert rows(df) == want, way


def test_hot_keys_are_few_and_include_null(data):
    facts, _ = data
    found = hot_keys(Sized(facts, 900), ["k"], 0.1)
    assert rows(found, "_hot_0") == rows(facts.sparkSession.sql("SELECT 'hot' UNION ALL SELECT NULL"))


def test_salted_plan_shuffles_by_salt(data):
    facts, dim = data
    df = left_lookup(facts, Sized(dim, 46), ["k"], ["name"], Sized(facts, 900), broadcast_bytes=0)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "_row_salt" in plan and "_dim_salt" in plan
