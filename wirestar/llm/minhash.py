"""Near duplicates: MinHash banding, signature verification, connected components.

Texts with the same set of word shingles are one class, found by a hash of the whole set, and
only one representative of each goes on. Its ``HASHES`` universal-hash minima are cut into
``BANDS``; representatives that agree on a whole band share a bucket. Every candidate pair is
first compared by signature, with a bound that a linked pair misses by chance once in 10^9,
and what passes is confirmed on the full sets.

No bucket is expanded into all its pairs. First each member is compared with the bucket's
smallest id, and the links found are joined to components: one round settles a group of copies
of one text. What remains are members of one bucket in different components. Those of small
buckets are paired; a large bucket is dealt into blocks, and a task compares two blocks, in
memory, skipping what it already knows to be connected, and returns links enough to connect
what is connected. So each pair that shares a bucket is either compared or known to be in one
component, and the components are exact over the candidates.

Components come from alternating large-star and small-star steps, each a written table.

Chance of missing a pair of similarity 0.75 in all bands: (1 - 0.75 ** 5) ** 56 < 3e-7.

Rows are told apart by their place in the first read, which is written, so an id may repeat: each
row has its own set and links, and gives a row. A component's id is the smallest of its rows'.

Nulls: a null text counts as empty; texts without words have the empty set, are linked with
nothing, and are their own component. Rows with a null ``doc_id`` are their own component of
null id and stay, and link nothing. Rows that repeat an id and its text have equal results. A
text's set is held whole, so memory grows with the longest text. An empty table gives an empty
result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType

from wirestar.llm.common import (
    free_name,
    frugal,
    text_or_empty,
    with_chance,
    with_chance_only,
)
from wirestar.sources.staging import Staging

WORDS = 5
PERCENT = 75
ROWS = 5
BANDS = 56
HASHES = ROWS * BANDS
#: Signature agreements below which a pair cannot be linked: six deviations under the mean.
LEAST_AGREEING = int(HASHES * 0.75 - 6 * (HASHES * 0.75 * 0.25) ** 0.5)
#: Buckets of at most so many members are paired directly.
SMALL_BUCKET = 8
#: A block of a large bucket has about so many members at most, and shingles in all.
BLOCK = 1_000
BLOCK_SHINGLES = 150_000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_POWER = np.uint64(1099511628211)


# --- shingles and signatures ----------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD
    x = (x ^ (x >> np.uint64(29))) * _ODD
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Sets of hashed word shingles. A word's hash is computed once per worker and then looked
    up; a full memory is emptied."""

    REMEMBERED = 120_000

    def __init__(self, words: int = WORDS):
        self.words = words
        self.known: dict[bytes, int] = {}

    def shingles(self, text: str) -> np.ndarray:
        """The sorted distinct 64-bit hashes of the text's shingles. Bytes fold only A-Z and
        split only at the contract's white space."""
        parts = text.encode("utf-8", "surrogatepass").lower().split()
        if not parts:
            return np.empty(0, dtype=np.uint64)
        known = self.known
        if len(known) > self.REMEMBERED:
            known.clear()
        for word in [w for w in set(parts) if w not in known]:
            digest = hashlib.blake2b(word, digest_size=8).digest()
            known[word] = int.from_bytes(digest, "little")
        words = np.fromiter(map(known.__getitem__, parts), dtype=np.uint64, count=len(parts))
        width = min(self.words, len(words))
        rolled = np.full(len(words) - width + 1, len(words) if width < self.words else 0, np.uint64)
        for i in range(width):
            rolled = _mix(rolled * _POWER + words[i : len(words) - width + 1 + i])
        return np.unique(rolled)


class Signer:
    """Minima of ``hashes`` universal hash functions a * x + b over 32 bits, of the shingles'
    upper halves. Of each minimum the lower 16 bits are kept: the upper ones say little, as
    minima are small, and different minima agree in the lower ones once in 65,536."""

    def __init__(self, hashes: int = HASHES, seed: int = 7, at_once: int = 256):
        random = np.random.default_rng(seed)
        self.a = random.integers(0, 2**31, (hashes, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.b = random.integers(0, 2**32, (hashes, 1), dtype=np.uint32)
        self.room = np.empty((hashes, at_once), dtype=np.uint32)

    def sign(self, shingles: np.ndarray) -> np.ndarray:
        upper = (shingles >> np.uint64(32)).astype(np.uint32)
        least = np.full(len(self.a), np.iinfo(np.uint32).max, dtype=np.uint32)
        step = self.room.shape[1]
        for i in range(0, len(upper), step):
            part = upper[i : i + step]
            hashed = self.room[:, : len(part)]
            np.multiply(self.a, part, out=hashed)
            np.add(hashed, self.b, out=hashed)
            np.minimum(least, hashed.min(axis=1), out=least)
        return (least & np.uint32(0xFFFF)).astype("<u2")


def band_keys(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key per band; the band's number is part of it."""
    keys = np.arange(1, len(signature) // rows + 1, dtype=np.uint64)
    for column in signature.reshape(-1, rows).T:
        keys = _mix(keys * _POWER + column.astype(np.uint64))
    return keys


def signatures(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: node (its number), doc_id, text_key (hash of the text), n_shingles,
    set_hash (null for the empty set), signature."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, signer = Shingler(), Signer()
        for batch in batches:
            sizes, hashes, signed = [], [], []
            for text in batch["text"]:
                found = shingler.shingles(text.as_py())
                sizes.append(len(found))
                hashes.append(hashlib.blake2b(found, digest_size=16).digest() if len(found) else None)
                signed.append(signer.sign(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch["node"], batch["doc_id"], batch["text_key"], pa.array(sizes, pa.int64()),
                 pa.array(hashes, pa.binary()), pa.array(signed, pa.binary())],
                names=["node", "doc_id", "text_key", "n_shingles", "set_hash", "signature"],
            )

    schema = (
        "node long, doc_id long, text_key long, n_shingles long, set_hash binary, signature binary"
    )
    rows = docs.select(
        F.monotonically_increasing_id().alias("node"), "doc_id", text_key().alias("text_key"),
        text_or_empty().alias("text"),
    )
    return rows.mapInArrow(frugal(sign), schema)


def text_key() -> Column:
    return F.xxhash64(text_or_empty())


def shingle_sets(texts: DataFrame) -> DataFrame:
    """(node, signature, shingles) of ``texts`` (node, text), the full sets as array<bigint>."""
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, signer = Shingler(), Signer()
        for batch in batches:
            for node, text in zip(batch["node"].to_pylist(), batch["text"]):
                found = shingler.shingles(text.as_py())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([node], pa.int64()),
                        pa.array([signer.sign(found).tobytes()], pa.binary()),
                        pa.array([found.view(np.int64)], pa.list_(pa.int64())),
                    ],
                    names=["node", "signature", "shingles"],
                )

    return texts.mapInArrow(frugal(gather), "node long, signature binary, shingles array<bigint>")


# --- links ----------------------------------------------------------------------------------


def alike(a: bytes, b: bytes) -> int:
    return int(np.count_nonzero(np.frombuffer(a, "<u2") == np.frombuffer(b, "<u2")))


@F.pandas_udf(IntegerType())
def _agreeing(a: pd.Series, b: pd.Series) -> pd.Series:
    if not len(a):
        return pd.Series([], dtype="int32")
    left = np.frombuffer(b"".join(a), "<u2").reshape(len(a), -1)
    right = np.frombuffer(b"".join(b), "<u2").reshape(len(b), -1)
    return pd.Series((left == right).sum(axis=1).astype("int32"))


def linked_sets(a: Column, b: Column, percent: int = PERCENT) -> Column:
    common = F.size(F.array_intersect(a, b))
    return 100 * common >= percent * (F.size(a) + F.size(b) - common)


def confirm(
    pairs: DataFrame, representatives: DataFrame, docs: DataFrame, staging: Staging,
    percent: int = PERCENT,
) -> DataFrame:
    """Pairs (u, v) of representatives that are linked: signatures first, then full sets. Only
    texts that a surviving pair names are read again."""
    staged = staging.write(pairs, "pairs")
    pairs, ends = staged.df, staged.df.select(F.explode(F.array("u", "v")).alias("node"))
    signed = representatives.select("node", "signature", "n_shingles")
    signed = with_chance_only(signed, "node", ends, 2 * staged.rows)
    left = signed.toDF("u", "signature_u", "n_u")
    right = signed.toDF("v", "signature_v", "n_v")
    sized = pairs.join(left, "u").join(right, "v").where(
        (100 * F.col("n_u") >= percent * F.col("n_v")) & (100 * F.col("n_v") >= percent * F.col("n_u"))
    )
    near = sized.where(_agreeing("signature_u", "signature_v") >= LEAST_AGREEING)
    near = staging.write(near.select("u", "v"), "near").df
    ends = near.select(F.explode(F.array("u", "v")).alias("node"))
    sets = sets_of(ends, representatives, docs, staging)
    sets = sets.select("node", "shingles")
    left, right = sets.toDF("u", "set_u"), sets.toDF("v", "set_v")
    found = near.join(left, "u").join(right, "v").where(linked_sets(F.col("set_u"), F.col("set_v"), percent))
    return staging.write(found.select("u", "v"), "links").df


def sets_of(
    nodes: DataFrame, representatives: DataFrame, docs: DataFrame, staging: Staging
) -> DataFrame:
    """Signature and full set of each of the ``nodes``, from a row of its id and text."""
    named = representatives.select("node", "doc_id", "text_key")
    needed = staging.write(named.join(nodes.distinct(), "node"), "needed")
    texts = docs.select("doc_id", text_key().alias("text_key"), text_or_empty().alias("text"))
    texts = with_chance_only(texts, "text_key", needed.df.select("text_key"), needed.rows)
    # A node has one id and one text, so what the join has brought together need not move again.
    found = texts.join(needed.df, ["doc_id", "text_key"])
    found = found.dropDuplicates(["doc_id", "text_key", "node"]).select("node", "text")
    return staging.write(shingle_sets(found), "sets").df


def leftovers(
    buckets: DataFrame, components: DataFrame, signed: DataFrame, docs: DataFrame, staging: Staging,
    percent: int = PERCENT,
) -> DataFrame:
    """Links between members of one bucket that are in different components so far."""
    members = buckets.join(components, "node", "left").select(
        "key", "node", "n_shingles", F.coalesce("component", "node").alias("component")
    )
    members = staging.write(members, "members").df
    mixed = members.groupBy("key").agg(
        F.min("component").alias("least"),
        F.max("component").alias("most"),
        F.count("*").alias("n"),
        F.sum("n_shingles").alias("total"),
    ).where("least < most").select("key", "n", "total")
    open_members = staging.write(members.join(mixed, "key"), "open").df
    small = open_members.where(F.col("n") <= SMALL_BUCKET)
    other = small.select("key", F.col("node").alias("v"), F.col("component").alias("component_v"))
    pairs = small.withColumnRenamed("node", "u").join(other, "key")
    pairs = pairs.where("u < v and component != component_v").select("u", "v").distinct()
    links = confirm(pairs, signed, docs, staging, percent)
    large = open_members.where(F.col("n") > SMALL_BUCKET)
    if large.isEmpty():
        return links
    return links.unionByName(_compare_blocks(large, signed, docs, staging, percent))


def _compare_blocks(
    large: DataFrame, signed: DataFrame, docs: DataFrame, staging: Staging, percent: int
) -> DataFrame:
    """Buckets dealt into blocks; each two blocks meet in one task with signatures and sets.
    How many blocks a bucket has follows from its members and their shingles, so that a task's
    memory has a bound also where long texts meet."""
    sets = sets_of(large.select("node"), signed, docs, staging)
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES))
    own = F.pmod(F.xxhash64("node"), blocks)
    meets = F.transform(
        F.sequence(F.lit(0).cast("long"), blocks - 1),
        lambda other: F.struct(
            F.least(own, other).alias("i"), F.greatest(own, other).alias("j"), own.alias("block")
        ),
    )
    rows = large.join(sets, "node")
    rows = rows.select("key", "node", "component", "signature", "shingles", F.inline(meets))

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        part = part.drop_duplicates("node")
        found = links_between(
            part["node"].to_numpy(), part["component"].to_numpy(), list(part["signature"]),
            list(part["shingles"]), percent,
        )
        return pd.DataFrame(found, columns=["u", "v"], dtype="int64")

    return staging.write(
        rows.groupBy("key", "i", "j").applyInPandas(compare, "u long, v long"), "block-links"
    ).df


def links_between(ids, components, signatures, sets, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Linked pairs enough to connect all that is linked, given what the components connect."""
    root = {c: c for c in components.tolist()}

    def find(c):
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    signed = np.frombuffer(b"".join(signatures), "<u2").reshape(len(ids), -1)
    sizes = np.array([len(s) for s in sets])
    links = []
    for i in range(len(ids) - 1):
        agree = (signed[i + 1 :] == signed[i]).sum(axis=1) >= LEAST_AGREEING
        close = np.minimum(sizes[i + 1 :], sizes[i]) * 100 >= percent * np.maximum(sizes[i + 1 :], sizes[i])
        for j in (np.flatnonzero(agree & close) + i + 1).tolist():
            a, b = find(components[i]), find(components[j])
            if a == b:
                continue
            common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * common >= percent * (sizes[i] + sizes[j] - common):
                root[a] = b
                links.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
    return links


# --- components -----------------------------------------------------------------------------


def connected(edges: DataFrame, staging: Staging) -> DataFrame:
    """(node, component): for every node of ``edges`` (u, v) the smallest node it reaches.

    Large-star links each larger neighbour of a node to the least of its neighbourhood;
    small-star links the smaller ones, and the node. Both keep what is connected, and repeated
    they end in stars around the smallest nodes.
    """
    state = staging.write(_ordered(edges), "edges")
    while True:
        large = _star(_both_ways(state.df), larger=True)
        small = _star(_ordered(large), larger=False)
        following = staging.write(
            small, "edges", {"sum": F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))}
        )
        if (following.rows, following.seen["sum"]) == (state.rows, state.seen.get("sum")):
            break
        state = following
    stars = following.df
    roots = stars.select(F.col("v").alias("node")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.withColumn("component", F.col("node"))
    )


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger node u to the smaller v; no loops."""
    ordered = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return ordered.where("u > v").distinct()


def _both_ways(edges: DataFrame) -> DataFrame:
    ways = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
    return edges.select(F.inline(ways))


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Around each u: its larger (or smaller) neighbours, and u itself when these are the
    smaller ones, get linked to the least of u and its neighbours."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
    joined = edges.join(least, "u")  # a hot u is split by adaptive execution
    if larger:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
    ends = F.explode(F.array("u", "v")).alias("end")
    return _ordered(joined.select(ends, "least").select(F.col("end").alias("u"), F.col("least").alias("v")))


# --- operator -------------------------------------------------------------------------------


def near_duplicates(docs: DataFrame, staging: Staging, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept. ``percent`` is at
    least ``PERCENT``, for which the bands and ``LEAST_AGREEING`` are made."""
    return _components_of(docs, staging, percent).drop("text_key")


def _components_of(docs: DataFrame, staging: Staging, percent: int) -> DataFrame:
    if percent < PERCENT:
        raise ValueError(f"percent={percent} is below {PERCENT}, so links would be missed")
    signed = staging.write(signatures(docs), "signed").df
    filled = signed.where("doc_id is not null and set_hash is not null")
    classes = filled.groupBy("set_hash").agg(
        F.min(F.struct("doc_id", "node")).alias("leader"), F.count("*").alias("copies")
    )
    classes = classes.select(
        "set_hash", "copies", F.col("leader.doc_id").alias("least"), F.col("leader.node").alias("node")
    )
    classes = staging.write(classes, "classes", {"copied": F.count_if(F.col("copies") > 1)})
    classes, copied_sets = classes.df, classes.seen["copied"]
    leaders = staging.write(_leaders(filled, classes, copied_sets), "leaders").df
    buckets = _buckets(leaders, staging)
    stars = buckets.join(buckets.groupBy("key").agg(F.min("node").alias("u")), "key")
    stars = stars.select("u", F.col("node").alias("v")).where("u < v").distinct()
    first = confirm(stars, leaders, docs, staging, percent)
    components = staging.write(connected(first, staging), "components").df
    rest = leftovers(buckets, components, leaders, docs, staging, percent)
    so_far = components.select(F.col("node").alias("u"), F.col("component").alias("v"))
    edges = so_far.where("u != v").unionByName(rest)
    components = staging.write(connected(edges, staging), "components").df
    # Classes with links, and the smallest id of their component.
    linked = classes.select("set_hash", "least", "node").join(components, "node")
    ids = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = linked.join(ids, "component").select("set_hash", "component_id")
    # Only sets of several rows or with links need looking up.
    copied = classes.where("copies > 1").select("set_hash", F.col("least").alias("component_id"))
    ends = copied.join(linked, "set_hash", "left_anti").unionByName(linked)
    ends = staging.write(ends, "ends").df
    component = F.coalesce(
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")), F.col("doc_id")
    )
    return signed.select("doc_id", "text_key", "n_shingles", "set_hash").join(
        ends, "set_hash", "left"
    ).select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        "text_key",
    )


def drop_near_duplicates(docs: DataFrame, staging: Staging, percent: int = PERCENT) -> DataFrame:
    """Rows of ``docs`` that stay, with all their columns: those with the smallest id of their
    component, and all rows without an id."""
    found = _components_of(docs, staging, percent)
    name, key, own = (free_name(docs, n) for n in ("_gone", "_gone_key", "_text_key"))
    gone = found.where("not kept").select(
        F.col("doc_id").alias(name), F.col("text_key").alias(key)
    ).distinct()
    gone = staging.write(gone, "gone")
    same = (F.col("doc_id") == F.col(name)) & (F.col(own) == F.col(key))
    rows, chance = docs.withColumn(own, text_key()), free_name(docs, "_chance")
    rows = with_chance(rows, own, gone.df.select(key), gone.rows, chance)
    kept = rows.where(chance).join(gone.df, same, "left_anti")
    return rows.where(~F.col(chance)).unionByName(kept).drop(own, chance)


def _leaders(filled: DataFrame, classes: DataFrame, copied_sets: int) -> DataFrame:
    """The row of each class that goes on. A row of a set without copies is its leader, so only
    the others are looked up."""
    copied = classes.where("copies > 1").select("set_hash")
    rows = with_chance(filled, "set_hash", copied, copied_sets, "_chance")
    looked_up = rows.where("_chance").join(classes.select("node"), "node", "left_semi")
    return rows.where("not _chance").unionByName(looked_up).drop("_chance", "set_hash")


def _buckets(leaders: DataFrame, staging: Staging) -> DataFrame:
    """(key, node, n_shingles) of all band buckets with at least two members."""
    @F.pandas_udf(ArrayType(LongType()))
    def keys(signature: pd.Series) -> pd.Series:
        return pd.Series([band_keys(np.frombuffer(s, "<u2")).view(np.int64) for s in signature])

    banded = leaders.select("node", "n_shingles", F.explode(keys("signature")).alias("key"))
    banded = staging.write(banded, "bands").df
    shared = banded.groupBy("key").count().where("count > 1").select("key")
    shared = staging.write(shared, "shared-keys")
    banded = with_chance_only(banded, "key", shared.df, shared.rows)
    return staging.write(banded.join(shared.df, "key").select("key", "node", "n_shingles"), "shared-bands").df
