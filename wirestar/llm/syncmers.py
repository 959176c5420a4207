"""Document fingerprints from closed syncmers.

A substring of ``K`` code points is an anchor when the smallest hash among its inner
substrings of ``S`` code points lies at its first or last place. That depends on these ``K``
code points alone, so a passage has the same anchors in whatever text it stands, and a text
spliced from two others has their anchors except around the seam.

An anchor is a long: its position in the upper 32 bits, the hash of its content in the lower
32. The fingerprint is the hashes of all anchors, each at its first place in the text, four bytes
each in base64: about as long as the text. Two fingerprints are as alike as the Jaccard
similarity of their hashes, without a sketch, so a passage that long texts share always shows.
``aligned`` matches anchors by position.

All work is column expressions. A text is cut into overlapping pieces first, so the
intermediate arrays stay small however long the text is.

Nulls: a null text counts as empty. An empty text has the empty fingerprint, alike (1.0) only
to another empty one. A text without anchors, as every one shorter than ``K``, has one anchor
over its whole content. Equal texts have equal fingerprints. Rows with a null ``doc_id`` are
put before all others; ties of ids are broken by text, and rows that repeat follow one another.
Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wirestar.llm.common import bind, text_or_empty
from wirestar.sources.staging import Staging

S = 5
#: An anchor has ten inner substrings: two at its edges and eight between.
K = S + 9
PIECE = 128
#: Documents of so many neighbouring ids form a bucket in which the next one is looked up.
BUCKET_IDS = 512

_LOW = 0xFFFFFFFF


def anchors(text: Column) -> Column:
    """Closed syncmers of ``text`` in order, as array<bigint>."""
    piece = rf"(?s)(?=(.{{1,{PIECE + K - 1}}})).{{1,{PIECE}}}"
    pieces = F.regexp_extract_all(text, F.lit(piece), F.lit(1))

    def of_piece(piece: Column, number: Column) -> Column:
        inner = F.regexp_extract_all(piece, F.lit(rf"(?s)(?=(.{{{S}}}))."), F.lit(1))
        return bind(
            F.transform(inner, lambda s: F.xxhash64(s)),
            lambda h: bind(_minima_of_four(h), lambda m: _closed(h, m, number * PIECE)),
        )

    return F.flatten(F.transform(pieces, of_piece))


def _minima_of_four(h: Column) -> Column:
    return F.transform(
        h, lambda x, i: F.least(x, F.get(h, i + 1), F.get(h, i + 2), F.get(h, i + 3))
    )


def _closed(h: Column, minima: Column, start: Column) -> Column:
    def anchor(x: Column, i: Column) -> Column:
        last = F.get(h, i + K - S)
        between = F.least(F.get(minima, i + 1), F.get(minima, i + 5))
        content = F.xxhash64(x, F.get(h, i + S), last).bitwiseAND(F.lit(_LOW))
        placed = F.shiftleft((start + i).cast("long"), 32).bitwiseOR(content)
        return F.when(last.isNotNull() & (F.least(x, last) <= between), placed)

    return F.filter(F.transform(h, anchor), lambda a: a.isNotNull())


def position(anchor: Column) -> Column:
    return F.shiftrightunsigned(anchor, 32)


def spliced(
    own: Column, cut: Column, other: Column, taken: Column, seam: Column, seam_start: Column
) -> Column:
    """Anchors of a text made of another's first ``cut`` code points and a third one's first
    ``taken``: those wholly inside either part, and those of ``seam``, the stretch of
    2 * (K - 1) code points around the cut."""
    before = F.filter(own, lambda a: position(a) + K <= cut)
    after = F.transform(
        F.filter(other, lambda a: position(a) + K <= taken),
        lambda a: a + F.shiftleft(cut.cast("long"), 32),
    )
    across = F.transform(
        anchors(seam), lambda a: a + F.shiftleft(seam_start.cast("long"), 32)
    )
    return F.concat(before, across, after)


def hashes(found: Column, text: Column) -> Column:
    """The distinct hashes of ``found`` in order of place; the whole text's hash if there are
    none; nothing for an empty text."""
    whole = F.array(F.xxhash64(text).bitwiseAND(F.lit(_LOW)))
    none = F.array().cast("array<bigint>")
    return (
        F.when(F.size(found) > 0, F.array_distinct(F.transform(found, lambda a: a.bitwiseAND(F.lit(_LOW)))))
        .when(F.length(text) > 0, whole)
        .otherwise(none)
    )


def written(hashes: Column) -> Column:
    def digits(x: Column) -> Column:
        return F.substring(F.hex(x.bitwiseOR(F.lit(_LOW + 1))), 2, 8)

    return F.base64(F.unhex(F.array_join(F.transform(hashes, digits), "")))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of distinct hashes, from 0 to 1."""
    common = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - common
    return F.when(either == 0, F.lit(1.0)).otherwise(common / either)


def aligned(a: Column, b: Column, shift: int = 0) -> Column:
    """Share of the anchors of ``a`` that ``b`` has ``shift`` code points further on; 0.0
    without anchors."""
    moved = F.transform(a, lambda x: x + F.lit(shift * 2**32)) if shift else a
    common = F.size(F.array_intersect(moved, b)) / F.size(F.array_distinct(a))
    return F.when(F.size(a) == 0, F.lit(0.0)).otherwise(common)


def with_next(docs: DataFrame, staging: Staging, derived: dict[str, Column]) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) with its ``derived`` columns, and the text and these
    columns of the row that follows in order of doc_id as the struct ``next``; the first row
    follows the last.

    Rows are grouped by ranges of ids, and each group is ordered by itself. The first row of a
    group also goes, marked as borrowed, to the group before. Which rows those are is known
    from the ids alone, so texts are shuffled once.
    """
    bucket = F.floor(F.coalesce("doc_id", F.lit(0)) / BUCKET_IDS)
    bounds = _first_ids(docs.select("doc_id", bucket.alias("bucket")), staging)
    lent = docs.withColumn("bucket", bucket).join(
        bounds, F.col("doc_id").eqNullSafe(F.col("first_id")) & (bucket == F.col("of")), "left"
    )

    def home(borrowed: bool, bucket: str) -> Column:
        return F.struct(F.lit(borrowed).alias("borrowed"), F.col(bucket).alias("home"))

    borrowed = F.when(F.col("before").isNotNull(), home(True, "before"))
    homes = F.array_compact(F.array(home(False, "bucket"), borrowed))
    rows = lent.select(*docs.columns, F.inline(homes)).repartition("home")
    rows = rows.withColumns(derived)
    order = ["borrowed", F.col("doc_id").asc_nulls_first(), "text"]
    within = Window.partitionBy("home").orderBy(*order)
    followed = rows.withColumn("next", F.lead(F.struct("text", *derived)).over(within))
    return followed.where("not borrowed").drop("home", "borrowed")


def _first_ids(ids: DataFrame, staging: Staging) -> DataFrame:
    """(of, first_id, before): the least id of each bucket and the bucket before it; before
    the first comes the last. The buckets are sorted in ranges, and only the last bucket of
    each range crosses a task."""
    first = F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("first")
    firsts = ids.groupBy("bucket").agg(first)
    ranged = firsts.repartitionByRange("bucket").withColumn("part", F.spark_partition_id())
    ranged = staging.write(ranged, "buckets").df
    edges = ranged.groupBy("part").agg(F.max("bucket").alias("last"))
    over_parts = Window.orderBy("part")  # one row per task
    edges = edges.select(
        "part",
        F.coalesce(
            F.lag("last").over(over_parts),
            F.max("last").over(Window.orderBy(F.lit(1)).rowsBetween(
                Window.unboundedPreceding, Window.unboundedFollowing)),
        ).alias("before_part"),
    )
    within = Window.partitionBy("part").orderBy("bucket")
    bounds = ranged.withColumn("within", F.lag("bucket").over(within)).join(
        F.broadcast(edges), "part"
    )
    bounds = bounds.select(
        F.col("bucket").alias("of"),
        F.col("first.doc_id").alias("first_id"),
        F.coalesce("within", "before_part").alias("before"),
    )
    return staging.write(bounds, "bounds").df


def edited_with_next(docs: DataFrame, staging: Staging) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last floor(n / 2) code points
    are replaced by the first as many of the next document."""
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    rows = with_next(texts, staging, {"own": anchors(F.col("text"))})
    return fingerprint_edits(
        rows.select(
            "doc_id", "text", "own", F.col("next.text").alias("next"), F.col("next.own").alias("other")
        )
    )


def fingerprint_edits(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, text, next and both texts' anchors own, other) with all digest
    columns. The edited text's anchors are those of its parts; only the seam is searched."""
    text, following = F.col("text"), F.col("next")
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumns({
        "n_chars": n.cast("long"),
        "cut": (n - half),
        "tail": F.substring(following, F.lit(1), half),
    })
    rows = rows.withColumn("taken", F.length("tail"))
    edge = F.least(F.col("cut"), F.lit(K - 1))
    rows = rows.withColumn("edited", F.concat(F.substring(text, F.lit(1), F.col("cut")), "tail"))
    seam = F.substring(F.col("edited"), F.col("cut") - edge + 1, edge + K - 1)
    mixed = spliced(
        F.col("own"), F.col("cut"), F.col("other"), F.col("taken"), seam, F.col("cut") - edge
    )
    rows = rows.withColumn("mixed", mixed).select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.size("own").alias("n_anchors"),
        aligned(F.col("own"), F.col("mixed")).alias("aligned_edited"),
        hashes(F.col("own"), text).alias("own"),
        hashes(F.col("other"), following).alias("other"),
        hashes(F.col("mixed"), F.col("edited")).alias("mixed"),
    )
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        written(F.col("own")).alias("fingerprint"),
        written(F.col("mixed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("mixed")).alias("near_edited"),
        likeness(F.col("own"), F.col("other")).alias("near_next"),
        "n_anchors",
        "aligned_edited",
    )
