"""Dimension lookups: broadcast below a checked size, salted beyond it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A dimension row is two short strings and a few numbers; 128 bytes bound it in memory.
ROW_BYTES = 128
BROADCAST_BYTES = 64 * 1024 * 1024

# A key is hot if it holds more than this share of the rows, so at most 1 / HOT_SHARE
# keys can be hot, whatever the size of the data.
HOT_SHARE = 1 / 1000
SALTS = 64


@dataclass(frozen=True)
class Sized:
    """A lookup table and its row count, None if unknown."""

    df: DataFrame
    rows: int | None = None

    def fits_broadcast(self, limit: int = BROADCAST_BYTES) -> bool:
        return self.rows is not None and self.rows * ROW_BYTES <= limit


def left_lookup(
    rows: DataFrame,
    dim: Sized,
    row_keys: list[str],
    dim_keys: list[str],
    base: Sized,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_share: float = HOT_SHARE,
    salts: int = SALTS,
) -> DataFrame:
    """``rows`` left join ``dim`` on equal keys; ``dim`` is unique on its keys.

    A dimension known to be small is broadcast. If its size is unknown, the plain join
    leaves the choice to adaptive execution, which measures it. Beyond the limit, both
    sides are shuffled, and rows of hot keys spread over ``salts`` tasks. Hot keys are
    counted in ``base``: the staged table that ``rows`` comes from, with the same keys.
    """
    on = [F.col(r) == F.col(d) for r, d in zip(row_keys, dim_keys)]
    if dim.fits_broadcast(broadcast_bytes):
        return rows.join(F.broadcast(dim.df), on, "left")
    if dim.rows is None or base.rows is None:
        return rows.join(dim.df, on, "left")
    hot = hot_keys(base, row_keys, hot_share)
    return _salted_left(rows, dim.df, row_keys, dim_keys, hot, salts)


def hot_keys(base: Sized, keys: list[str], share: float = HOT_SHARE) -> DataFrame:
    """Keys with more than ``share`` of the rows, as ``_hot_0`` and so on: at most
    1 / ``share`` of them.

    Map-side combined: each task sends one row per key. NULL counts as a key, so that
    many NULL rows, which match nothing, do not meet in one task either.
    """
    return (
        base.df.groupBy(*(F.col(k).alias(f"_hot_{i}") for i, k in enumerate(keys)))
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > F.lit(base.rows * share))
        .withColumn("_hot", F.lit(True))
        .drop("_n")
    )


def _salted_left(
    rows: DataFrame,
    dim: DataFrame,
    row_keys: list[str],
    dim_keys: list[str],
    hot: DataFrame,
    salts: int,
) -> DataFrame:
    def with_salt(df: DataFrame, keys: list[str], salt: Column, name: str) -> DataFrame:
        same = [F.col(k).eqNullSafe(F.col(f"_hot_{i}")) for i, k in enumerate(keys)]
        flagged = df.join(F.broadcast(hot), same, "left")  # at most 1 / HOT_SHARE rows
        return flagged.withColumn(name, salt).drop(*hot.columns)

    is_hot = F.coalesce(F.col("_hot"), F.lit(False))
    spread = F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int")
    row_salt = F.when(is_hot, spread).otherwise(F.lit(0))
    copies = F.explode(F.sequence(F.lit(0), F.when(is_hot, salts - 1).otherwise(0)))
    left = with_salt(rows, row_keys, row_salt, "_row_salt")
    right = with_salt(dim, dim_keys, copies, "_dim_salt")
    keys = [*zip(row_keys, dim_keys), ("_row_salt", "_dim_salt")]
    on = [F.col(r) == F.col(d) for r, d in keys]
    return left.join(right, on, "left").drop("_row_salt", "_dim_salt")
