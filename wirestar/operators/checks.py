"""Constraint checks: each returns what breaks a rule, so no rows means the rule holds.

Violations come as key values with a row count rather than as rows. They are counted
before anything is shuffled by value, so a value shared by a third of all rows is one
row per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wirestar.operators.lookups import BROADCAST_BYTES, Sized
from wirestar.schemas import STAR_SCHEMA, TableRules

REPORT = ["table_name", "rule", "column_name", "value", "n_rows"]


def _report(table: str, rule: str, column: str, value: Column, n_rows: Column) -> list[Column]:
    return [
        F.lit(table).alias("table_name"),
        F.lit(rule).alias("rule"),
        F.lit(column).alias("column_name"),
        value.cast("string").alias("value"),
        n_rows.cast("bigint").alias("n_rows"),
    ]


def duplicates(df: DataFrame, table: str, column: str, rule: str = "unique") -> DataFrame:
    """Values of a column that occur more than once. NULLs are never equal."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(*_report(table, rule, column, F.col(column), F.col("n")))
    )


def duplicates_after(
    old: DataFrame, new: Sized, table: str, column: str, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``duplicates`` of both tables together, if ``old`` has none by itself: values of ``new``
    rows that repeat among them or are in ``old``.

    Of ``old``, only what lies between the least and the greatest new value is read, by a
    filter that Parquet's statistics serve; after a load with claimed keys that is next to
    nothing. Those rows meet the new values where they are, and only hits are shuffled; beyond
    ``broadcast_bytes`` of new values it is a shuffle join, which Spark may thin out by a Bloom
    filter of them.
    """
    least, most = new.df.agg(F.min(column), F.max(column)).first()
    counted = new.df.where(F.col(column).isNotNull()).groupBy(column)
    counted = counted.agg(F.count(F.lit(1)).alias("n"))
    near = old.where(F.col(column).between(F.lit(least), F.lit(most)))
    held, values = near.select(F.col(column).alias("_held")), new.df.select(column)
    if new.fits_broadcast(broadcast_bytes):
        values = F.broadcast(values)
    hits = held.join(values, F.col("_held") == F.col(column), "left_semi")
    hits = hits.groupBy("_held").agg(F.count(F.lit(1)).alias("_n_held"))
    both = counted.join(hits, F.col(column) == F.col("_held"), "left")
    n = F.col("n") + F.coalesce("_n_held", F.lit(0))
    return both.where(n > 1).select(*_report(table, "unique", column, F.col(column), n))


def several_current(users: DataFrame, table: str = "users_dim") -> DataFrame:
    """Users with more than one current row."""
    current = users.where("current_flag")
    return duplicates(current, table, "user_name", rule="one_current")


def _counted(df: DataFrame, table: str, rule: str, broken: dict[str, Column]) -> DataFrame:
    """Count several conditions in one pass; one report row per condition that occurs."""
    counts = df.agg(*(F.count_if(cond).alias(c) for c, cond in broken.items()))
    pairs = F.array(
        *(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n")) for c in broken)
    )
    rows = counts.select(F.explode(pairs).alias("r")).where("r.n > 0")
    return rows.select(
        F.lit(table).alias("table_name"),
        F.lit(rule).alias("rule"),
        F.col("r.column_name").alias("column_name"),
        F.lit(None).cast("string").alias("value"),
        F.col("r.n").alias("n_rows"),
    )


def nulls(df: DataFrame, table: str, columns: tuple[str, ...] | list[str]) -> DataFrame:
    """Columns that hold NULLs, with their number, in one pass over the table."""
    return _counted(df, table, "not_null", {c: F.col(c).isNull() for c in columns})


def too_long(df: DataFrame, table: str, limits: dict[str, int]) -> DataFrame:
    """Columns that hold text longer than allowed, with the number of rows, in one pass."""
    broken = {c: F.char_length(F.col(c)) > n for c, n in limits.items()}
    return _counted(df, table, "length", broken)


def not_allowed(df: DataFrame, table: str, column: str, values: tuple[str, ...]) -> DataFrame:
    """Values outside the allowed list. NULL passes, as in a CHECK clause."""
    return (
        df.where(~F.col(column).isin(*values))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*_report(table, "check", column, F.col(column), F.col("n")))
    )


def orphans(
    df: DataFrame, table: str, column: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Key values that the parent table does not hold. NULL references nothing and passes."""
    used = (
        df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    )
    held = parent.select(F.col(parent_key).alias("_held"))
    return used.join(held, F.col(column) == F.col("_held"), "left_anti").select(
        *_report(table, "foreign_key", column, F.col(column), F.col("n"))
    )


def all_orphans(
    df: DataFrame, table: str, references: dict[str, tuple[DataFrame, str]]
) -> DataFrame:
    """``orphans`` of several columns in one pass over ``df``: their values are counted
    together, by column and value, and each parent takes away what it holds."""
    values = F.array(
        *(F.struct(F.lit(c).alias("column_name"), F.col(c).cast("long").alias("used")) for c in references)
    )
    used = df.select(F.inline(values)).where("used is not null")
    used = used.groupBy("column_name", "used").agg(F.count(F.lit(1)).alias("n"))
    parents: dict[tuple[int, str], list[str]] = {}
    for column, (parent, key) in references.items():
        parents.setdefault((id(parent), key), []).append(column)
    held = reduce(
        DataFrame.unionByName,
        (
            references[columns[0]][0].select(
                F.explode(F.array(*map(F.lit, columns))).alias("column_name"),
                F.col(key).cast("long").alias("used"),
            )
            for (_, key), columns in parents.items()
        ),
    )
    lost = used.join(held, ["column_name", "used"], "left_anti")
    return lost.select(
        F.lit(table).alias("table_name"),
        F.lit("foreign_key").alias("rule"),
        "column_name",
        F.col("used").cast("string").alias("value"),
        F.col("n").alias("n_rows"),
    )


def check_table(
    tables: dict[str, DataFrame],
    table: str,
    rows: DataFrame | None = None,
    others: DataFrame | None = None,
) -> DataFrame:
    """All declared rules of one star-schema table, or of some of its ``rows``, such as those
    of the days a load has added; with the ``others`` of the table, their values must not be
    there either. A table is read at most three times: for keys that repeat,
    for counts of NULLs and lengths, and for the references of all its columns."""
    rules: TableRules = STAR_SCHEMA[table]
    df = tables[table] if rows is None else rows
    if others is None:
        found = [duplicates(df, table, c) for c in rules.unique]
    else:
        sized = Sized(df, df.count())
        found = [duplicates_after(others, sized, table, c) for c in rules.unique]
    found.append(nulls(df, table, rules.not_null))
    if rules.max_length:
        found.append(too_long(df, table, rules.max_length))
    found += [not_allowed(df, table, c, v) for c, v in rules.allowed.items()]
    if rules.references:
        parents = {c: (tables[t], k) for c, (t, k) in rules.references.items()}
        found.append(all_orphans(df, table, parents))
    if table == "users_dim":
        found.append(several_current(df))
    return reduce(DataFrame.unionByName, found)


def check_star_schema(
    tables: dict[str, DataFrame],
    fact_rows: DataFrame | None = None,
    other_facts: DataFrame | None = None,
) -> DataFrame:
    """All rules of all tables; of the fact only ``fact_rows`` if given, whose keys
    ``other_facts`` must not have."""
    some = {"packets_fact": (fact_rows, other_facts)}
    return reduce(
        DataFrame.unionByName, (check_table(tables, t, *some.get(t, ())) for t in STAR_SCHEMA)
    )


# Labels of the row-count report, in its order.
COUNT_LABELS = {
    "ip_dim": "IP DIM COUNT",
    "users_dim": "USER DIM COUNT",
    "date_dim": "DATE DIM COUNT",
    "direction_dim": "DIRECTION DIM COUNT",
    "packets_fact": "PACKETS FACT COUNT",
}


def table_counts(tables: dict[str, DataFrame | list[DataFrame]]) -> DataFrame:
    """Row count per table: ``table_name, n_rows``. A table may be given as its parts, each of
    which is counted by itself."""

    def rows(label: str, table: DataFrame | list[DataFrame]) -> DataFrame:
        parts = table if isinstance(table, list) else [table]
        counted = [part.agg(F.count(F.lit(1)).alias("n_rows")) for part in parts]
        # Footers of no files at all give no count.
        n_rows = F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows")
        total = reduce(DataFrame.unionByName, counted).agg(n_rows)
        return total.select(F.lit(label).alias("table_name"), "n_rows")

    return reduce(DataFrame.unionByName, (rows(v, tables[t]) for t, v in COUNT_LABELS.items()))


def count_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two count reports side by side, with the difference."""
    old = before.select("table_name", F.col("n_rows").alias("n_before"))
    new = after.select("table_name", F.col("n_rows").alias("n_after"))
    return new.join(old, "table_name").select(
        "table_name", "n_before", "n_after", (F.col("n_after") - F.col("n_before")).alias("n_added")
    )
