"""Puts are seen whole or not at all."""

import glob

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from wirestar.sources import item_store

SCHEMA = T.StructType([
    T.StructField("user", T.StringType()), T.StructField("date", T.StringType()),
    T.StructField("kb", T.DecimalType(38, 0)),
])
KEY = ["user", "date"]


def items(spark, pairs, date="2024-01-01"):
    made = [(u, date, kb) for u, kb in pairs]
    df = spark.createDataFrame(made, "user string, date string, kb long")
    return df.withColumn("kb", F.col("kb").cast("decimal(38,0)")).repartition(3)


def stored(spark, path):
    return [(u, int(kb)) for u, _, kb in rows(item_store.read_store(spark, path, SCHEMA, KEY))]


def test_last_put_wins_and_a_rerun_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "store")
    assert stored(spark, path) == []
    item_store.put_in_store(items(spark, [("ann", 1), ("bob", 2), ("bob", 2)]), path, KEY)
    item_store.put_in_store(items(spark, [("bob", 5), (None, 7)]), path, KEY)
    want = [("ann", 1), ("bob", 5), (None, 7)]
    assert sorted(stored(spark, path), key=str) == sorted(want, key=str)
    item_store.put_in_store(items(spark, [("bob", 5), (None, 7)]), path, KEY)
    assert sorted(stored(spark, path), key=str) == sorted(want, key=str)
    assert len(item_store.commits(path)) == 3


def test_a_failed_put_leaves_nothing_visible(spark, tmp_path):
    path = str(tmp_path / "store")
    item_store.put_in_store(items(spark, [("ann", 1)]), path, KEY)
    bad = items(spark, [(f"u{i}", i) for i in range(30)])
    bad = bad.withColumn("kb", F.when(F.col("user") == "u29", F.raise_error(F.lit("lost")).cast(
        "decimal(38,0)")).otherwise(F.col("kb")))
    with pytest.raises(Exception, match="lost"):
        item_store.put_in_store(bad, path, KEY)
    assert stored(spark, path) == [("ann", 1)] and len(item_store.commits(path)) == 1
    item_store.put_in_store(items(spark, [(f"u{i}", i) for i in range(30)]), path, KEY)
    assert len(stored(spark, path)) == 31


def test_files_that_no_commit_names_are_not_read(spark, tmp_path):
    path = str(tmp_path / "store")
    writer = item_store.ItemWriter(path)
    killed = writer.write(iter([('{"user":"x","date":"d","kb":1}',)]))
    done = writer.write(iter([('{"user":"y","date":"d","kb":2}',)]))
    assert stored(spark, path) == []
    writer.commit([done, None])
    assert stored(spark, path) == [("y", 2)]
    writer.abort([killed, None])
    assert len(glob.glob(f"{path}/items/*.json")) == 1
