"""Exact duplicates through an extendible-hash index on shared files.

The index key is a 64-bit hash of the normalised text. A directory of key prefixes points to
buckets: wherever a bucket holds more entries than its capacity, the directory doubles and
the bucket splits on the next bit. Copies are counted into one entry before they reach the
index, so a text with a third of all rows is one entry of one bucket. The entries are written
to the shared folder, each owner task one range of buckets. Different texts with one key chain
in their bucket; every key with more than one document or text is settled by comparing the
texts' bytes, with equal texts combined before the shuffle.

Nulls: a null text counts as empty; a null ``doc_id`` sorts after all others. Rows that
repeat an id and its text are one group, of which one row stays. An empty table gives an
empty result. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wirestar.llm.common import SPACES, free_name, text_or_empty
from wirestar.sources.staging import Staging

BUCKET_CAPACITY = 65_536
#: The directory has at most 2 ** MAX_DEPTH slots (1.5 MB), so it can always be broadcast.
#: Buckets of that depth have no upper bound: their pages just chain.
MAX_DEPTH = 16
#: Tasks over which the copies of one text are spread until equal texts have been combined.
SALTS = 32
#: Contested keys that may be broadcast: 1.6 MB as rows.
BROADCAST_KEYS = 100_000


def normalised(text: str | Column = "text") -> Column:
    return F.regexp_replace(text_or_empty(text), SPACES, " ")


@dataclass(frozen=True)
class Index:
    """``keys``: one row per document (row, doc_id, key, sha). ``entries``: one row per text,
    sorted by bucket and key. ``directory``: slot -> bucket, at ``depth`` bits."""

    keys: DataFrame
    entries: DataFrame
    directory: DataFrame
    depth: int


def slot_of(key: Column, depth: int) -> Column:
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("bigint")


def grow_directory(
    keys: DataFrame, staging: Staging, capacity: int = BUCKET_CAPACITY, max_depth: int = MAX_DEPTH
) -> tuple[DataFrame, int]:
    """Directory for the distinct 64-bit ``key`` values: (slot, bucket, local_depth) and the
    global depth. A bucket is named by the first slot that points to it.

    Prefixes are counted once, at the maximal depth; all shallower counts are sums of these.
    A bucket splits while it is overfull, and the directory is as deep as its deepest bucket.
    """
    fine = keys.groupBy(slot_of(F.col("key"), max_depth).alias("slot")).count()
    sized = (
        fine.select(F.explode(F.sequence(F.lit(0), F.lit(max_depth))).alias("depth"), "*")
        .groupBy("depth", F.expr(f"shiftright(slot, {max_depth} - depth)").alias("prefix"))
        .agg(F.sum("count").alias("n"))
    )
    sized = staging.write(sized, "bucket-sizes").df
    split = sized.where((F.col("n") > capacity) & (F.col("depth") < max_depth))
    deepest = split.agg(F.max("depth")).first()[0]
    depth = 0 if deepest is None else deepest + 1
    parents = split.select(
        (F.col("depth") + 1).alias("depth"), F.explode(F.array(
            F.col("prefix") * 2, F.col("prefix") * 2 + 1)).alias("prefix")
    )
    root = split.sparkSession.range(1).select(F.lit(0).alias("depth"), F.col("id").alias("prefix"))
    open_at = parents.unionByName(root)
    leaves = open_at.join(split.select("depth", "prefix"), ["depth", "prefix"], "left_anti")
    width = F.expr(f"cast(shiftleft(1L, {depth} - depth) as bigint)")
    first = F.col("prefix") * width
    slots = F.explode(F.sequence(first, first + width - 1)).alias("slot")
    directory = leaves.select(slots, first.alias("bucket"), F.col("depth").alias("local_depth"))
    return staging.write(directory, "directory").df, depth


def build_index(
    docs: DataFrame, staging: Staging, capacity: int = BUCKET_CAPACITY, max_depth: int = MAX_DEPTH
) -> Index:
    """Index of ``docs`` (doc_id, text). Texts are read once and only hashes are shuffled."""
    text = normalised()
    keys = docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.xxhash64(text).alias("key"),
        F.sha2(text.cast("binary"), 256).alias("sha"),
    )
    keys = staging.write(keys, "keys").df
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    entries = keys.groupBy("key", "sha").agg(
        F.count(F.lit(1)).alias("rows"), F.min(first).alias("first")
    )
    entries = staging.write(entries, "texts").df
    directory, depth = grow_directory(
        entries.select("key").distinct(), staging, capacity, max_depth
    )
    placed = entries.withColumn("slot", slot_of(F.col("key"), depth)).join(
        F.broadcast(directory), "slot"
    )
    owned = placed.repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key", "sha")
    owned = owned.select("bucket", "key", "sha", "rows", "first")
    return Index(keys, staging.write(owned, "buckets").df, directory, depth)


def compare_bytes(docs: DataFrame, index: Index, staging: Staging) -> DataFrame:
    """Texts of all keys that more than one document has, told apart by their bytes:
    (key, sha, copies, chain), where ``chain`` is the number of texts under that key.

    The contested keys are written first, and counted: at most ``BROADCAST_KEYS`` are
    broadcast, and then only contested texts are shuffled. More are joined by shuffles in which
    the copies of one text are spread over ``SALTS`` tasks."""
    contested = index.entries.groupBy("key").agg(F.sum("rows").alias("n")).where("n > 1")
    contested = staging.write(contested.select("key"), "contested")
    text = normalised()
    suspects = docs.select(text.alias("norm"), F.xxhash64(text).alias("key"))
    if contested.rows <= BROADCAST_KEYS:
        suspects = suspects.join(F.broadcast(contested.df), "key", "left_semi")
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        suspects = suspects.withColumn("salt", (F.rand(0) * SALTS).cast("int"))
        salted = contested.df.select("key", salts).hint("merge")
        suspects = suspects.join(salted, ["key", "salt"], "left_semi")
    texts = suspects.groupBy("key", "norm").agg(F.count(F.lit(1)).alias("copies"))
    texts = texts.select("key", F.sha2(F.col("norm").cast("binary"), 256).alias("sha"), "copies")
    chained = texts.groupBy("key").agg(F.collect_list(F.struct("sha", "copies")).alias("texts"))
    return chained.select("key", F.size("texts").alias("chain"), F.inline("texts"))


def find_duplicates(
    docs: DataFrame, staging: Staging, capacity: int = BUCKET_CAPACITY, max_depth: int = MAX_DEPTH
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, and
    ``chain_length``, the number of different texts under the document's key."""
    index = build_index(docs, staging, capacity, max_depth)
    proven = staging.write(compare_bytes(docs, index, staging), "compared").df
    groups = index.entries.join(proven, ["key", "sha"]).select(
        "key", "sha", "first", "copies", "chain"
    )
    keys = index.keys.join(groups, ["key", "sha"], "left")  # a hot key is split by AQE
    alone = F.col("first").isNull()
    return keys.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("first.row"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
        F.coalesce("chain", F.lit(1)).alias("chain_length"),
    )


def drop_duplicates(docs: DataFrame, staging: Staging) -> DataFrame:
    """Rows of ``docs`` that stay, with all their columns. Of rows that repeat both id and
    text, any one stays."""
    names = ("_sha", "_keep_id", "_keep_sha", "_again_id", "_again_sha")
    sha, keep_id, keep_sha, again_id, again_sha = (free_name(docs, n) for n in names)
    found = staging.write(find_duplicates(docs, staging), "duplicates").df
    ids = F.col("doc_id"), F.col("text_sha256")
    stays = found.where("kept").select(ids[0].alias(keep_id), ids[1].alias(keep_sha))
    repeated = found.groupBy(*ids).count().where("count > 1")
    repeated = repeated.select(ids[0].alias(again_id), ids[1].alias(again_sha))
    named = docs.withColumn(sha, F.sha2(normalised().cast("binary"), 256))

    def same(other_id: str, other_sha: str) -> Column:
        return F.col("doc_id").eqNullSafe(F.col(other_id)) & (F.col(sha) == F.col(other_sha))

    kept = named.join(stays, same(keep_id, keep_sha), "left_semi")
    once = kept.join(repeated, same(again_id, again_sha), "left_anti")
    first = kept.join(repeated, same(again_id, again_sha), "left_semi").dropDuplicates(["doc_id", sha])
    return once.unionByName(first).drop(sha)
