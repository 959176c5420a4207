"""Shards by a hierarchical weighted hash tree.

A tree has regions, racks in them and shards in these, and every shard a weight. A row descends
it: on each level every child gets a draw ``-ln(u) / weight`` from the hash of the child's name
and the row's key, and the smallest draw wins. A child wins with a chance in proportion to its
weight, and its draw depends on nothing but itself. So when a weight rises, rows move only into
the subtree where it rose, and when it falls, only out of it; siblings exchange nothing. Inside a
subtree that grew, rows that come in are drawn anew among its children. A new shard that is a
region of its own (``with_new_shard``) has nobody to share with: rows move into it alone.

The key is ``doc_id``, so the law is ``key``: the id and the tree decide, whatever the text, and a
row is placed without knowing any other. Copies of one text meet only if they have one id; to
keep them together, pass the text's hash as ``key``. Names are hashed, not positions: the order
of the tree's list does not matter.

Slots number a shard's rows by doc_id, text size, checksum and place of reading. Texts do not
travel: of each, only its size and its checksum.

Nulls: a null text has size 16 and checksum 0, as the empty text has; a null ``doc_id`` draws as
one key of its own and has the last slots of its shard. Rows that repeat an id, with the same
text or another, share a shard and have slots of their own. The size of a text does not matter.
An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wirestar.llm.common import text_or_empty
from wirestar.operators.numbering import number_rows
from wirestar.sources.staging import Staging

SHARDS = 40
RACKS_PER_REGION = 2
SHARDS_PER_RACK = 5
#: What a row takes besides its text, in bytes.
ROW_BYTES = 16
#: Hexadecimal digits of a hash that make a draw: 52 bits fit a double.
DIGITS = 13


@dataclass(frozen=True)
class Shard:
    region: str
    rack: str
    number: int
    weight: float = 1.0


def balanced_tree(shards: int = SHARDS) -> list[Shard]:
    """Shards of equal weight, five in a rack and two racks in a region."""
    racks = [i // SHARDS_PER_RACK for i in range(shards)]
    return [
        Shard(f"region{rack // RACKS_PER_REGION}", f"rack{rack}", i) for i, rack in enumerate(racks)
    ]


def with_new_shard(tree: Sequence[Shard], weight: float = 1.0) -> list[Shard]:
    """The tree with one more shard, a region of its own: rows move into it alone."""
    number = max((s.number for s in tree), default=-1) + 1
    return [*tree, Shard(f"new{number}", f"new{number}/rack", number, weight)]


def shard_of(key: Column, tree: Sequence[Shard]) -> Column:
    """The number of the shard that ``key`` descends to. Shards without weight get no rows."""
    racks, shards = defaultdict(dict), defaultdict(dict)
    regions: dict[str, float] = defaultdict(float)
    for s in tree:
        if s.weight > 0:
            regions[s.region] += s.weight
            racks[s.region][s.rack] = racks[s.region].get(s.rack, 0.0) + s.weight
            shards[s.rack][f"shard{s.number}"] = s.weight
    name = F.coalesce(key.cast("string"), F.lit("null"))
    region = _winner(_children(regions), name)
    rack = _winner(F.element_at(_children_of(racks), region), name)
    shard = _winner(F.element_at(_children_of(shards), rack), name)
    return F.substring(shard, len("shard") + 1, 20).cast("int")


def _children(weights: dict[str, float]) -> Column:
    return F.array(
        *(F.struct(F.lit(n).alias("name"), F.lit(w).alias("weight")) for n, w in weights.items())
    )


def _children_of(parents: dict[str, dict[str, float]]) -> Column:
    return F.create_map(*(c for n, w in parents.items() for c in (F.lit(n), _children(w))))


def _winner(children: Column, key: Column) -> Column:
    """The child with the smallest draw; of equal draws, the first name."""
    def draw(child: Column) -> Column:
        digest = F.md5(F.concat(child["name"], F.lit("/"), key).cast("binary"))
        drawn = F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double")
        uniform = (drawn + F.lit(0.5)) / F.lit(float(16**DIGITS))
        return F.struct((-F.ln(uniform) / child["weight"]).alias("draw"), child["name"])

    return F.array_min(F.transform(children, draw))["name"]


def shard_documents(
    docs: DataFrame, tree: Sequence[Shard], grown: Sequence[Shard], staging: Staging
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, size, text_crc32, law, shard, slot,
    grown_shard (its shard in the tree ``grown``), region and rack."""
    text = text_or_empty()
    placed = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col("doc_id"), tree).alias("shard"),
        shard_of(F.col("doc_id"), grown).alias("grown_shard"),
        F.monotonically_increasing_id().alias("row"),
    )
    placed = staging.write(placed, "placed").df
    order = [F.col("doc_id").asc_nulls_last(), F.col("size"), F.col("text_crc32"), F.col("row")]
    numbered = number_rows(placed, order, "slot", staging, group_by=["shard"], start=-1).df
    places = F.create_map(*(
        c for s in tree for c in (F.lit(s.number), F.struct(
            F.lit(s.region).alias("region"), F.lit(s.rack).alias("rack")))
    ))
    place = F.element_at(places, F.col("shard"))
    return numbered.select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard",
        place["region"].alias("region"), place["rack"].alias("rack"),
    )
