import pytest

from tests.conftest import rows
from wirestar.operators import checks
from wirestar.operators.lookups import Sized
from wirestar.schemas import STAR_SCHEMA, empty

FOUND = ("table_name", "rule", "column_name", "value", "n_rows")


@pytest.fixture
def clean(spark):
    return {t: empty(spark, r.schema) for t, r in STAR_SCHEMA.items()}


def test_empty_star_schema_is_clean(clean):
    assert rows(checks.check_star_schema(clean)) == []


def test_each_rule(spark, clean):
    schema = STAR_SCHEMA["ip_dim"].schema
    ips = spark.createDataFrame(
        [(1, "1.1.1.1"), (1, "2.2.2.2"), (None, "2.2.2.2"), (4, "a" * 16), (5, None)], schema
    )
    assert rows(checks.check_table({**clean, "ip_dim": ips}, "ip_dim")) == sorted(
        [
            ("ip_dim", "unique", "ip_key", "1", 2),
            ("ip_dim", "unique", "ip_address", "2.2.2.2", 2),
            ("ip_dim", "not_null", "ip_key", None, 1),
            ("ip_dim", "not_null", "ip_address", None, 1),
            ("ip_dim", "length", "ip_address", None, 1),
        ],
        key=repr,
    )
    directions = spark.createDataFrame(
        [(1, "inbound"), (2, "sideway"), (3, None)], STAR_SCHEMA["direction_dim"].schema
    )
    found = checks.check_table({**clean, "direction_dim": directions}, "direction_dim")
    assert rows(found) == [("direction_dim", "check", "direction", "sideway", 1)]


def test_foreign_keys_let_nulls_pass(spark, clean):
    facts = spark.createDataFrame(
        [(1, 9, 1, 1, None, 2024010100, 1, 1.0), (2, 9, None, None, None, None, None, 1.0)],
        STAR_SCHEMA["packets_fact"].schema,
    )
    ips = spark.createDataFrame([(1, "1.1.1.1")], STAR_SCHEMA["ip_dim"].schema)
    found = checks.check_table({**clean, "packets_fact": facts, "ip_dim": ips}, "packets_fact")
    assert rows(found, "column_name", "value", "n_rows") == [
        ("date_key", "2024010100", 1),
        ("direction_key", "1", 1),
        ("user_key", "9", 2),
    ]


def test_one_current_row_per_user(spark):
    users = spark.createDataFrame(
        [("ann", True), ("ann", True), ("bo", True), ("bo", False)],
        "user_name string, current_flag boolean",
    )
    assert rows(checks.several_current(users)) == [
        ("users_dim", "one_current", "user_name", "ann", 2)
    ]


def test_count_changes(spark):
    before = spark.createDataFrame([("IP DIM COUNT", 3)], "table_name string, n_rows long")
    after = spark.createDataFrame([("IP DIM COUNT", 8)], "table_name string, n_rows long")
    assert rows(checks.count_changes(before, after)) == [("IP DIM COUNT", 3, 8, 5)]


@pytest.mark.parametrize("limit", [64 * 1024 * 1024, 0])
def test_only_new_values_are_compared(spark, tmp_path, limit):
    spark.range(0, 100_000).toDF("k").write.parquet(str(tmp_path / "old"))
    old = spark.read.parquet(str(tmp_path / "old"))
    new = spark.createDataFrame([(99_990,), (100_001,), (100_001,), (100_002,), (None,)], "k long")
    found = checks.duplicates_after(old, Sized(new, 5), "t", "k", limit)
    assert rows(found, *FOUND) == [("t", "unique", "k", "100001", 2), ("t", "unique", "k", "99990", 2)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,99990)" in plan  # reaches the files' statistics
    none = checks.duplicates_after(old, Sized(new.where("false"), 0), "t", "k", limit)
    assert rows(none) == []


def test_keys_of_other_days_are_found(spark, clean):
    schema = STAR_SCHEMA["packets_fact"].schema
    facts = [(n, None, None, None, None, None, None, 1.0) for n in (7, 8, 9)]
    day, others = spark.createDataFrame(facts[1:], schema), spark.createDataFrame(facts[:2], schema)
    found = checks.check_star_schema(clean, day, others)
    assert rows(found, *FOUND) == [("packets_fact", "unique", "packets_key", "8", 2)]
