"""Small helpers that the operators of this package share."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The whitespace of the contracts, as a regular expression class.
SPACES = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(column: str | Column = "text") -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column, F.lit(""))


def bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, though ``use`` names it many times."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``: the folds of the contracts."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


#: Bits of ``with_chance`` for each key, and at most.
BITS_PER_KEY, MOST_BITS = 32, 2**26


def with_chance(
    df: DataFrame, key: str | Column, keys: DataFrame, n_keys: int, name: str
) -> DataFrame:
    """``df`` with a boolean ``name``: false only where ``key`` is not among the ``n_keys`` values
    of the one column of ``keys``. Rows without a chance need not be shuffled to be joined. Bitmaps
    of the keys' hashes are broadcast, 8 MB at most; beyond that more rows have a chance."""
    bits = min(MOST_BITS, max(2**15, 1 << (BITS_PER_KEY * n_keys).bit_length()))

    def slot(column: Column) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(bits))

    part, bitmap = free_name(df, "_part"), free_name(df, "_bitmap")
    slots = keys.select(slot(F.col(keys.columns[0])).alias("slot"))
    slots = slots.select(F.bitmap_bucket_number("slot").alias(part), "slot").repartition(part)
    bitmaps = slots.groupBy(part).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias(bitmap)
    ).withColumn(bitmap, _words(F.col(bitmap)))
    own = slot(F.col(key) if isinstance(key, str) else key)
    at = F.bitmap_bit_position(own).cast("int")
    word = F.get(bitmap, F.shiftright(at, 5))
    in_word = 24 - F.shiftright(at, 3) % 4 * 8 + at % 8  # a word's first byte is its highest
    is_set = F.getbit(word, in_word) == 1
    found = df.withColumn(part, F.bitmap_bucket_number(own)).join(F.broadcast(bitmaps), part, "left")
    return found.withColumn(name, F.coalesce(is_set, F.lit(False))).drop(part, bitmap)


def _words(bitmap: Column) -> Column:
    """A bitmap of 4,096 bytes as whole numbers, which rows look up without making new values."""
    def word(i: Column) -> Column:
        found = F.conv(F.hex(F.substring(bitmap, i * 4 + 1, F.lit(4))), 16, 10).cast("long")
        return (found - F.when(found >= 2**31, F.lit(2**32)).otherwise(0)).cast("int")

    return F.transform(F.sequence(F.lit(0), F.lit(1023)), word)


def with_chance_only(
    df: DataFrame, key: str | Column, keys: DataFrame, n_keys: int
) -> DataFrame:
    name = free_name(df, "_chance")
    return with_chance(df, key, keys, n_keys, name).where(name).drop(name)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


#: Functions with a cache of what workers keep between tasks, such as vocabularies.
_kept: list = []


def kept_by_worker(cached):
    """Marks a cached function, so that other work can have its results dropped."""
    _kept.append(cached)
    return cached


def frugal(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` on the batches of a task. A worker lives on, idle or in other stages, beside a JVM
    that needs the room: what it keeps for other work goes before, what it has freed after."""
    def run(batches: Iterator) -> Iterator:
        drop_kept()
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def drop_kept() -> None:
    for cached in _kept:
        cached.cache_clear()


def give_back() -> None:
    """Memory that Python and Arrow have freed but hold goes to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim:
        trim(0)
