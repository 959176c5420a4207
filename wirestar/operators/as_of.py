"""Lookups at a moment: which version of a key was in effect, without a range join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def carry_last(
    rows: DataFrame, key: str, span: str, order: list[Column], value: Column, name: str
) -> DataFrame:
    """``rows`` with ``name``: the last ``value`` that is not NULL among the rows of the same key
    up to the row itself, in ``order``, which begins with what ``span`` is a coarser form of.

    No window holds more than one span of a key, so a key with a third of all rows is many
    windows. What goes from span to span is one value per key and span, and both sides of that
    join are already placed by key and span. NULL is a key and a span like any other.
    """
    end = F.max_by(value, F.when(value.isNotNull(), F.struct(*order))).alias("_end")
    earlier = Window.partitionBy(key).orderBy(span).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        rows.groupBy(key, span)
        .agg(end)
        .select(
            F.col(key).alias("_key"),
            F.col(span).alias("_span_of"),
            F.last("_end", ignorenulls=True).over(earlier).alias("_carried"),
        )
    )
    so_far = (
        Window.partitionBy(key, span)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col(span).eqNullSafe(F.col("_span_of"))
    return (
        rows.withColumn(name, F.last(value, ignorenulls=True).over(so_far))
        .join(carried, same, "left")
        .withColumn(name, F.coalesce(name, "_carried"))
        .drop("_key", "_span_of", "_carried")
    )


def as_of(
    moments: DataFrame, versions: DataFrame, key: str, at: str, since: str, takes: list[str]
) -> DataFrame:
    """``key``, ``at`` and the ``takes`` columns of the key's version in effect at each moment:
    the one with the latest ``since`` that is not after it, and of several with the same, the
    one whose ``takes`` are the greatest. NULLs where no version had begun.

    ``moments`` are distinct; times that repeat are to be reduced first, as each is looked up
    once. A version without a ``since`` is in effect from ever; a moment without a time finds
    only such versions.
    """
    begun = versions.select(
        key, F.col(since).alias("_at"), F.lit(0).alias("_kind"), F.struct(*takes).alias("_taken")
    )
    asked = moments.select(key, F.col(at).alias("_at"), F.lit(1).alias("_kind"))
    both = begun.unionByName(asked, allowMissingColumns=True).withColumn("_span", F.to_date("_at"))
    order = [F.col("_at"), F.col("_kind"), F.col("_taken")]
    found = carry_last(both, key, "_span", order, F.col("_taken"), "_found")
    taken = [F.col(f"_found.{c}").alias(c) for c in takes]
    return found.where("_kind = 1").select(key, F.col("_at").alias(at), *taken)
