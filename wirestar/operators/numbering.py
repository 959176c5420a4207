"""Dense row numbers and surrogate keys, without one task that sees all rows.

``row_number()`` over a global order moves every row to one task. Here the rows are
range-sorted over all tasks and staged with their position; then only the row counts
per partition are summed up, and every row adds its partition's offset.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wirestar.operators.lookups import Sized
from wirestar.sources.staging import Staged, Staging

# monotonically_increasing_id() = partition << 33 | row position in the partition
_POSITION_BITS = 33
#: Partitions of a range sort; Spark's range partitioner samples for no more.
_MOST_PARTITIONS = 100_000


def number_rows(
    df: DataFrame,
    order_by: Sequence[Column],
    name: str,
    staging: Staging,
    group_by: Sequence[str] = (),
    start: int | Callable[[int], int] = 0,
    dtype: T.DataType | None = None,
) -> Staged:
    """Add ``name``: ``start`` + 1, 2, 3, ... in the given order, per group if grouped. Where
    ``start`` is a function, it is called once with the number of rows, if there are any.

    The order must be total, or equal rows swap numbers between runs. The range sort
    uses all of its columns, so neither a hot group nor a hot leading value gathers in
    one partition.
    """
    ordered = df.orderBy(*group_by, *order_by).withColumn(
        "_position", F.monotonically_increasing_id()
    )
    part = F.shiftright("_position", _POSITION_BITS)
    staged = staging.write(ordered, f"sorted-{name}", {"last_part": F.max(part)})
    rows = staged.df
    if not group_by and not staged.seen["last_part"]:
        shift = F.lit(0)  # one partition: a row's position is its place
    else:
        rows = rows.withColumn("_part", part)
        # One row per partition and group: at most partitions + groups rows.
        offsets = _offsets(rows, list(group_by), "_part", staging if group_by else None)
        rows = _join_offsets(rows, offsets, ["_part", *group_by])
        shift = F.col("_shift")
    if callable(start):
        start = start(staged.rows) if staged.rows else 0
    number = F.col("_position") + shift + F.lit(1 + start)
    numbered = rows.withColumn(name, number.cast(dtype or T.LongType()))
    return Staged(numbered.drop("_position", "_part", "_shift"), staged.rows)


def number_in_file(
    df: DataFrame, name: str, staging: Staging, observe: Mapping[str, Column] | None = None
) -> Staged:
    """Add ``name``: 1, 2, 3, ... in file order, for rows with ``file_path`` and
    ``block_start`` (see ``read_traffic(positions=True)``). No row is sorted.

    A file block is read by one task in order, so a row's place in its block is known
    from its position. Only the blocks' row counts are summed up over each file.
    """
    positioned = df.withColumn("_position", F.monotonically_increasing_id())
    staged = staging.write(positioned, "file-rows", observe)
    # One row per file block (gz files are one block each).
    offsets = _offsets(staged.df, ["file_path"], "block_start", staging)
    joined = _join_offsets(staged.df, offsets, ["file_path", "block_start"])
    numbered = joined.withColumn(name, F.col("_position") + F.col("_shift") + F.lit(1))
    return Staged(numbered.drop("_position", "_shift"), staged.rows, staged.seen)


def _offsets(rows: DataFrame, groups: list[str], part: str, staging: Staging | None) -> Sized:
    """``_shift`` per group and part: what turns a row's position into its place in the
    group. Parts of a group follow each other in the order of ``part``. Without groups there
    is one row per partition, few enough to join without counting or staging them."""
    runs = rows.groupBy(part, *groups).agg(
        F.min("_position").alias("_first"), F.count(F.lit(1)).alias("_size")
    )
    # Without groups this window sees one row per partition of the sort.
    earlier = Window.partitionBy(*groups).orderBy(part).rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = F.coalesce(F.sum("_size").over(earlier), F.lit(0))
    shifts = runs.select(part, *groups, (before - F.col("_first")).alias("_shift"))
    if staging is None:
        return Sized(shifts, _MOST_PARTITIONS)
    staged = staging.write(shifts, "offsets")
    return Sized(staged.df, staged.rows)


def _join_offsets(rows: DataFrame, offsets: Sized, keys: list[str]) -> DataFrame:
    """Rows with their ``_shift``, by keys that may be NULL. The offsets of a plain sort
    or of few groups are broadcast; with many, both sides are shuffled by group and part,
    of which none is larger than a task's share."""
    other = offsets.df.select(*(F.col(k).alias(f"_{k}_r") for k in keys), "_shift")
    if offsets.fits_broadcast():
        other = F.broadcast(other)
    same = [F.col(k).eqNullSafe(F.col(f"_{k}_r")) for k in keys]
    return rows.join(other, same).drop(*(f"_{k}_r" for k in keys))


def last_key(table: DataFrame, key: str) -> int:
    """Highest key so far, 0 for an empty table."""
    return table.agg(F.max(key)).first()[0] or 0

