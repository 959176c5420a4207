"""Exact duplicates against grouping on strings, and the splitting of the directory."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from wirestar.llm import exact_dedup as m

ROWS = [
    (9, "a  b\tc"), (3, "a b c"), (4, " a b c"), (7, None), (6, ""), (1, "x" * 200_000),
    (2, "x" * 200_000), (5, "once"), (8, "a\u00a0b c"), (10, "once"), (10, "once"), (None, "once"),
] + [(100 + i, "hot\n\ncopy") for i in range(300)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, True) for i, t in rows], "doc_id long, text string, kept boolean")


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_groups_equal_plain_grouping(spark, staging, monkeypatch, broadcast):
    monkeypatch.setattr(m, "BROADCAST_KEYS", broadcast)
    norm = {t: re.sub(r"[ \t-\r]+", " ", t or "") for _, t in ROWS}
    groups = defaultdict(list)
    for i, t in ROWS:
        groups[norm[t]].append(i)
    got = m.find_duplicates(frame(spark, ROWS), staging).collect()
    assert len(got) == len(ROWS)
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    kept = defaultdict(int)
    for r in got:
        ids = by_hash[r.text_sha256]
        assert r.keep_id == min(i for i in ids if i is not None)
        assert r.group_size == len(ids) and r.doc_id in ids and r.chain_length == 1
        assert not r.kept or r.doc_id == r.keep_id
        kept[r.text_sha256] += r.kept
    assert set(kept.values()) == {1}


def test_rows_that_stay_keep_all_columns(spark, staging):
    df = frame(spark, ROWS)
    stays = m.drop_duplicates(df, staging)
    assert stays.columns == df.columns
    ids = sorted(r.doc_id for r in stays.collect())
    assert ids == [1, 3, 4, 5, 6, 8, 100]


@pytest.mark.parametrize("capacity", [1, 7, 1000])
def test_directory_covers_all_slots_and_splits_overfull_buckets(spark, staging, capacity):
    keys = spark.range(500).select(F.xxhash64("id").alias("key"))
    directory, depth = m.grow_directory(keys, staging, capacity, max_depth=8)
    slots = sorted(r.slot for r in directory.collect())
    assert slots == list(range(2**depth))
    filled = keys.withColumn("slot", m.slot_of(F.col("key"), depth)).join(directory, "slot")
    for r in filled.groupBy("bucket", "local_depth").count().collect():
        assert r["count"] <= capacity or r.local_depth == 8
    assert (depth == 0) == (capacity == 1000)


def test_colliding_keys_chain_and_are_told_apart(spark, staging, monkeypatch):
    monkeypatch.setattr(m.F, "xxhash64", lambda *c: F.lit(1).cast("long"))
    got = m.find_duplicates(frame(spark, ROWS), staging).collect()
    assert {r.chain_length for r in got} == {7}
    assert sum(r.kept for r in got) == 7


def test_empty_table(spark, staging):
    empty = frame(spark, [])
    assert m.find_duplicates(empty, staging).count() == 0
    assert m.drop_duplicates(empty, staging).count() == 0
