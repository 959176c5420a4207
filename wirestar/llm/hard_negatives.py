"""Hard negatives by rotated one-bit codes.

A vector is rotated and each component kept as its sign. The signs, as a unit vector, are
stored with their alignment: the vector's length along them. What the code leaves of the vector
is at right angles to it and is coded again under another rotation, ``CODES`` times, each leaving
about 0.6 of the rest. An anchor is rotated alike and cut into ``PLANES`` bit planes, so its inner
product with a code is a weighted sum of popcounts. The product with the rest is not known, but
by Cauchy and Schwarz it is at most the product of both lengths; that and what rounding to
bit planes left of the anchor make an interval around the estimate that always holds the score.
Rows whose interval cannot reach the result are passed over; all others are scored in integers.
So the result is exact, whatever the codes leave.

Anchors and rows are dealt into blocks at random, and a task sees one block of each. Of every
pair of blocks an anchor keeps only its best few, so what is merged per anchor has one short list
per block of rows. The best rows of its label become its positives; a second pass looks for the
best rows of other labels in each positive's band.

Nulls: rows with a null label, a null vector, or a null or non-finite component take no part; a
row with a null ``vec_id`` is no anchor and comes last among equal scores. Vectors of different
lengths are filled up with zeros. Rows that repeat a ``vec_id`` are rows of their own, as anchors
too; equal scores and ids are ordered by place of reading. Vectors may have any length. Scores are
exact and as 64-bit integers; those beyond are cut to its ends. An empty table gives an empty
result, and so do an anchor without another row of its label and one whose positive has nothing
in its band. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from wirestar.sources.staging import Staging

POSITIVES = 5
NEGATIVES = 3
#: A negative's score is between these hundredths of the positive's.
LOW, HIGH = 50, 95
ANCHOR_STEP = 50
CODES = 4
PLANES = 6
#: Rows and anchors that meet in one task, about.
ROW_BLOCK = 8_192
ANCHOR_BLOCK = 2_048
#: Anchors whose estimates are in memory at once.
SLICE = 64
#: Rows of the best estimates that are scored first, for a bound on the others.
FIRST_SCORED = 24

_CODED = (
    "row long, vec_id long, label long, vector binary, codes binary, weights binary, rest double"
)
_FOUND = "anchor long, anchor_id long, other long, other_id long, score long"


# --- codes --------------------------------------------------------------------------------------


def rotations(size: int, codes: int = CODES) -> np.ndarray:
    """One orthogonal matrix per code, the same in every task."""
    random = np.random.default_rng(20)
    return np.stack([np.linalg.qr(random.standard_normal((size, size)))[0] for _ in range(codes)])


def padded(size: int) -> int:
    """Components after filling up to whole 64-bit words."""
    return max(64, -(-size // 64) * 64)


def _words(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=-1, bitorder="little").view("<u8")


def encode(vectors: np.ndarray, rotated: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each vector: sign words (n, codes, words), alignments (n, codes), and the length of
    what the codes leave, rounded up."""
    n, size = vectors.shape
    words = np.empty((n, len(rotated), size // 64), dtype="<u8")
    weights = np.empty((n, len(rotated)), dtype="<f4")
    rest = vectors.astype(np.float64)
    for k, rotation in enumerate(rotated):
        turned = rest @ rotation.T
        signs = turned > 0
        words[:, k] = _words(signs)
        unit = np.where(signs, 1.0, -1.0) / np.sqrt(size)
        weights[:, k] = (unit * turned).sum(axis=1)
        rest = (turned - weights[:, k, None].astype(np.float64) * unit) @ rotation
    return words, weights, np.linalg.norm(rest, axis=1) * (1 + 1e-6)


class Anchors:
    """Bit planes of rotated anchors. ``left`` is what rounding leaves of each, by code."""

    def __init__(self, vectors: np.ndarray, rotated: np.ndarray, planes: int = PLANES):
        self.length = np.linalg.norm(vectors, axis=1)
        self.planes, self.step, self.base, self.left, self.total = [], [], [], [], []
        for rotation in rotated:
            turned = vectors @ rotation.T
            low = turned.min(axis=1)
            step = np.maximum((turned.max(axis=1) - low) / (2**planes - 1), 1e-300)
            level = np.rint((turned - low[:, None]) / step[:, None]).astype(np.uint64)
            bits = (level[:, None, :] >> np.arange(planes, dtype=np.uint64)[:, None]) & np.uint64(1)
            self.planes.append(_words(bits.astype(np.uint8)))
            self.step.append(step)
            self.base.append(low)
            self.total.append(level.sum(axis=1).astype(np.float64))
            rounded = low[:, None] + step[:, None] * level
            self.left.append(np.linalg.norm(turned - rounded, axis=1))

    def intervals(self, at: slice, codes, weights, rest) -> tuple[np.ndarray, np.ndarray]:
        """Estimate of each score, anchors by rows, and how far the score may be from it.

        With signs s and levels l of one code, the sum of s * l is twice the levels where s is
        positive, which popcounts give, less all levels.
        """
        size = 64 * codes.shape[2]
        estimate = np.zeros((len(self.length[at]), len(codes)))
        radius = np.outer(self.length[at], rest)
        for k, plane in enumerate(self.planes):
            counts = np.zeros(estimate.shape, dtype=np.int32)
            for bit in range(plane.shape[1]):
                ones = np.zeros(estimate.shape, dtype=np.int32)
                for word in range(plane.shape[2]):
                    ones += np.bitwise_count(codes[:, k, word] & plane[at, bit, word, None])
                counts += ones << bit
            positive = np.bitwise_count(codes[:, k]).sum(axis=1)
            signed = self.base[k][at, None] * (2.0 * positive - size)
            signed = signed + self.step[k][at, None] * (2.0 * counts - self.total[k][at, None])
            estimate += signed * (weights[:, k] / np.sqrt(size))
            radius += np.outer(self.left[k][at], np.abs(weights[:, k]))
        return estimate, radius * (1 + 1e-9) + 1e-6 * np.outer(self.length[at], self.scale(weights, rest))

    @staticmethod
    def scale(weights: np.ndarray, rest: np.ndarray) -> np.ndarray:
        return np.abs(weights).sum(axis=1, dtype=np.float64) + rest


class Scorer:
    """Integer scores of one anchor with chosen rows, each computed once. Products of doubles are
    exact while sums stay below 2 ** 52; beyond that, Python's integers take over."""

    def __init__(self, vectors: np.ndarray, anchor: np.ndarray):
        largest = np.abs(vectors).max(initial=0.0) * np.abs(anchor).max(initial=0.0)
        self.exact = bool(largest * max(1, vectors.shape[1]) < 2.0**45)
        self.vectors, self.anchor = vectors, anchor
        self.known = np.zeros(len(vectors), dtype=bool)
        self.scores = np.zeros(len(vectors), dtype=np.int64 if self.exact else object)

    def of(self, rows: np.ndarray) -> np.ndarray:
        new = rows[~self.known[rows]]
        if len(new):
            if self.exact:
                self.scores[new] = self.vectors[new] @ self.anchor
            else:
                anchor = [int(v) for v in self.anchor]
                for i in new.tolist():
                    self.scores[i] = sum(int(a) * b for a, b in zip(self.vectors[i], anchor))
            self.known[new] = True
        return self.scores[rows]


def best(rows: np.ndarray, scores: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """Positions of the ``n`` highest scores; equal ones by ``place`` of the row."""
    if scores.dtype == object:
        order = sorted(range(len(rows)), key=lambda i: (-scores[i], place[rows[i]]))
        return np.array(order[:n], dtype=np.int64)
    return np.lexsort((place[rows], -scores))[:n]


# --- tiles --------------------------------------------------------------------------------------


class Tile:
    """A block of rows and a block of anchors."""

    def __init__(self, rows: pa.Table, anchors: pa.Table, rotated: np.ndarray):
        size = rotated.shape[1]
        self.rows, self.anchors = rows, anchors
        self.vectors = _doubles(rows["vector"], size)
        self.anchor_vectors = _doubles(anchors["vector"], size)
        n, codes = rows.num_rows, len(rotated)
        self.codes = np.frombuffer(b"".join(rows["codes"].to_pylist()), "<u8").reshape(n, codes, -1)
        self.weights = np.frombuffer(b"".join(rows["weights"].to_pylist()), "<f4").reshape(n, codes)
        self.rest = rows["rest"].to_numpy()
        self.labels, self.row = rows["label"].to_numpy(), rows["row"].to_numpy()
        ids = rows["vec_id"]
        filled = ids.fill_null(np.iinfo(np.int64).max).to_numpy()
        order = np.lexsort((self.row, filled, ids.is_null().to_numpy()))
        self.place = np.empty(n, dtype=np.int64)
        self.place[order] = np.arange(n)
        self.anchor_labels = anchors["label"].to_numpy()
        self.planes = Anchors(self.anchor_vectors, rotated)

    def intervals(self, at: slice, rows) -> tuple[np.ndarray, np.ndarray]:
        return self.planes.intervals(at, self.codes[rows], self.weights[rows], self.rest[rows])

    def found(self, hits: list[tuple[int, int, int]], **more: list[int]) -> pa.Table:
        """A table of (anchor, row, score), by position."""
        ends = np.iinfo(np.int64)
        a, r = ([h[i] for h in hits] for i in (0, 1))
        scores = [min(max(int(h[2]), ends.min), ends.max) for h in hits]
        return pa.table({
            "anchor": self.anchors["row"].take(pa.array(a, pa.int64())),
            "anchor_id": self.anchors["vec_id"].take(pa.array(a, pa.int64())),
            "other": self.rows["row"].take(pa.array(r, pa.int64())),
            "other_id": self.rows["vec_id"].take(pa.array(r, pa.int64())),
            "score": pa.array(scores, pa.int64()),
            **{name: pa.array(values, pa.int64()) for name, values in more.items()},
        })


def _doubles(column: pa.ChunkedArray, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), size)


def _slices(n: int) -> Iterator[slice]:
    for i in range(0, n, SLICE):
        yield slice(i, min(i + SLICE, n))


def positives_in(tile: Tile, wanted: int = POSITIVES) -> pa.Table:
    """Of each anchor, the best ``wanted`` rows of its label in the tile, but for itself."""
    own = tile.anchors["row"].to_numpy()
    by_label = np.argsort(tile.anchor_labels, kind="stable")
    hits = []
    for label in np.unique(tile.anchor_labels):
        rows = np.flatnonzero(tile.labels == label)
        group = by_label[tile.anchor_labels[by_label] == label]
        if not len(rows):
            continue
        for i in range(0, len(group), SLICE):
            some = group[i : i + SLICE]
            estimate, radius = tile.intervals(some, rows)
            for a, middle, around in zip(some.tolist(), estimate, radius):
                other = tile.row[rows] != own[a]
                low = np.where(other, middle - around, -np.inf)
                least = np.partition(low, -wanted)[-wanted] if len(low) > wanted else -np.inf
                reach = rows[other & (middle + around >= least)]
                scores = Scorer(tile.vectors, tile.anchor_vectors[a]).of(reach)
                hits += [
                    (a, int(reach[j]), scores[j]) for j in best(reach, scores, tile.place, wanted)
                ]
    return tile.found(hits)


def negatives_in(tile: Tile, wanted: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> pa.Table:
    """Of each anchor and positive, the best ``wanted`` rows of other labels in its band."""
    hits, positives = [], []
    lists = tile.anchors["positives"].to_pylist()
    for at in _slices(tile.anchors.num_rows):
        estimate, radius = tile.intervals(at, slice(None))
        for a, middle, around in zip(range(at.start, at.stop), estimate, radius):
            others = np.flatnonzero(tile.labels != tile.anchor_labels[a])
            under, over = (middle - around)[others], (middle + around)[others]
            scorer = Scorer(tile.vectors, tile.anchor_vectors[a])
            for p in lists[a]:
                least, most = low * p["score"], high * p["score"]
                near = (over * 100 >= least) & (under * 100 <= most)
                reach, bound = others[near], over[near]
                if len(reach) > FIRST_SCORED:
                    close = np.where(middle[reach] * 100 <= most, -middle[reach], np.inf)
                    first = reach[np.argpartition(close, FIRST_SCORED)[:FIRST_SCORED]]
                    sure = _in_band(scorer.of(first), least, most)
                    if len(sure) >= wanted:
                        reach = reach[bound >= float(np.sort(sure)[-wanted])]
                scores = scorer.of(reach)
                inside = (100 * scores >= least) & (100 * scores <= most)
                inside = inside.astype(bool)
                reach, scores = reach[inside], scores[inside]
                for j in best(reach, scores, tile.place, wanted):
                    hits.append((a, int(reach[j]), scores[j]))
                    positives.append(p["other"])
    return tile.found(hits, positive=positives)


def _in_band(scores: np.ndarray, least: int, most: int) -> np.ndarray:
    return scores[((100 * scores >= least) & (100 * scores <= most)).astype(bool)]


# --- operator -----------------------------------------------------------------------------------


def coded_rows(vectors: DataFrame, size: int, shift_every: int | None = 7) -> DataFrame:
    """Rows that take part, with their components in 1/256 rounded down, and their codes. The
    label of rows whose id ``shift_every`` divides moves on by one of ten."""
    usable = F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    label = F.col("label").cast("long")
    if shift_every:
        moved = F.coalesce(F.col("vec_id") % shift_every == 0, F.lit(False))
        label = F.when(moved, (label + 1) % 10).otherwise(label)
    picked = vectors.where(usable).select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        label.alias("label"),
        F.transform("embedding", lambda x: x.cast("double")).alias("embedding"),
    )

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rotated = rotations(size)
        for batch in batches:
            n = batch.num_rows
            components = np.zeros((n, size))
            for i, vector in enumerate(batch["embedding"]):
                values = vector.values.to_numpy(zero_copy_only=False)
                components[i, : len(values)] = np.floor(values * 256)
            codes, weights, rest = encode(components, rotated)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["row"], batch["vec_id"], batch["label"],
                    pa.array([v.tobytes() for v in components], pa.binary()),
                    pa.array([c.tobytes() for c in codes], pa.binary()),
                    pa.array([w.tobytes() for w in weights], pa.binary()),
                    pa.array(rest, pa.float64()),
                ],
                names=["row", "vec_id", "label", "vector", "codes", "weights", "rest"],
            )

    return picked.mapInArrow(code, _CODED)


def mine(
    vectors: DataFrame, staging: Staging, shift_every: int | None = 7, step: int = ANCHOR_STEP,
    row_block: int = ROW_BLOCK, anchor_block: int = ANCHOR_BLOCK,
) -> DataFrame:
    """Per anchor (id divisible by ``step``) and positive of ``vectors`` (vec_id, embedding,
    label), the first negatives: anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score."""
    size = padded(vectors.agg(F.max(F.size("embedding"))).first()[0] or 1)
    is_anchor = F.coalesce(F.col("vec_id") % step == 0, F.lit(False))
    coded = staging.write(
        coded_rows(vectors, size, shift_every), "coded",
        {"anchors": F.coalesce(F.sum(is_anchor.cast("long")), F.lit(0))},
    )
    row_blocks = max(1, -(-coded.rows // row_block))
    anchor_blocks = max(1, -(-coded.seen["anchors"] // anchor_block))
    rows = coded.df.withColumn("row_block", _dealt(row_blocks))
    rows = rows.withColumn("anchor_block", _all(anchor_blocks))
    anchors = coded.df.where(is_anchor).select("row", "vec_id", "label", "vector")
    anchors = anchors.withColumn("anchor_block", _dealt(anchor_blocks))

    def tiles(some: DataFrame, work, schema: str) -> DataFrame:
        empty = to_arrow_schema(T.StructType.fromDDL(schema)).empty_table()

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                return empty
            return work(Tile(left, right, rotations(size)))

        keys = ["anchor_block", "row_block"]
        other = some.withColumn("row_block", _all(row_blocks))
        other = other.toDF(*other.columns)  # columns of its own beside those of ``rows``
        return rows.groupBy(keys).cogroup(other.groupBy(keys)).applyInArrow(run, schema)

    near = tiles(anchors, positives_in, _FOUND)
    order = [F.col("score").desc(), F.col("other_id").asc_nulls_last(), F.col("other")]
    ranked = near.withColumn(
        "rank", F.row_number().over(Window.partitionBy("anchor").orderBy(*order))
    )
    positives = staging.write(ranked.where(F.col("rank") <= POSITIVES), "positives").df
    listed = positives.groupBy(F.col("anchor").alias("row")).agg(
        F.collect_list(F.struct("other", "score")).alias("positives")
    )
    found = tiles(anchors.join(listed, "row"), negatives_in, _FOUND + ", positive long")
    pair = Window.partitionBy("anchor", "positive").orderBy(*order)
    found = found.withColumn("rank", F.row_number().over(pair)).where(F.col("rank") <= NEGATIVES)
    named = positives.select(
        "anchor", F.col("other").alias("positive"), F.col("other_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return found.join(named, ["anchor", "positive"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("other_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )


def _dealt(blocks: int) -> Column:
    return F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")


def _all(blocks: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
