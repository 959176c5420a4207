"""Token ids in files, as a canonical Huffman code of bounded code length.

``write_tokens`` sorts documents by id in ranges, encodes them, and cuts each range into blocks
of whole documents. The ids of all blocks are counted, and the code lengths are the best ones
under the length limit (package-merge); codes are canonical, so the lengths alone are stored.
Blocks are coded independently. Each notes the bit offset of every ``CHECKPOINT``-th id, so a
reader can start at any of these, and decoding a block advances all of them in step through
one lookup table.

Layout under the path, written and read by Spark, so that it may lie in any store:

- ``blocks``: part, block, start (ids before it in its part), doc_ids, lengths, bits (most
  significant first, padded to 8 bytes and 8 more), checkpoints (64-bit integers)
- ``code``: id, length of its code
- ``parts``: part, start: ids of all parts before it

Nulls: a null text counts as empty and holds the end id alone; a null ``doc_id`` sorts first.
Ties of ids are ordered by text, and repeated rows are written as often. An empty table makes
empty files. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wirestar.llm.byte_bpe import encoder, in_pieces
from wirestar.llm.common import text_or_empty
from wirestar.sources.staging import Staging

END_ID = 0
#: Ids in a block; a longer document makes a longer block.
BLOCK_IDS = 1 << 19
CHECKPOINT = 128
MAX_LENGTH = 18

_RAW = "part int, block int, start long, doc_ids array<bigint>, lengths array<bigint>, ids binary"
_CODED = (
    "part int, block int, start long, doc_ids array<bigint>, lengths array<bigint>, bits binary,"
    " checkpoints binary"
)


# --- code ---------------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, limit: int = MAX_LENGTH) -> np.ndarray:
    """Lengths of the best prefix code whose codes have at most ``limit`` bits, for symbols
    with positive ``counts`` (others get 0). A limit too small for the symbols is raised.

    Package-merge: each round pairs neighbours of the sorted list and merges the pairs with
    the single symbols again; the first 2n - 2 items of the last list tell the lengths. An
    item's history is kept as how many packages of the list before it stand in front.
    """
    symbols = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    n = len(symbols)
    if n <= 1:
        lengths[symbols] = 1
        return lengths
    limit = max(limit, int(n - 1).bit_length())
    order = symbols[np.argsort(counts[symbols], kind="stable")]
    single = counts[order].astype(np.int64)
    weights, is_single = single, [np.ones(n, dtype=bool)]
    for _ in range(limit - 1):
        pairs = weights[: len(weights) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate([single, pairs])
        place = np.argsort(merged, kind="stable")
        weights = merged[place]
        is_single.append(place < n)
    taken, depth = 2 * n - 2, np.zeros(n, dtype=np.int64)
    for flags in reversed(is_single):
        singles = int(flags[:taken].sum())
        depth[:singles] += 1
        taken = 2 * (taken - singles)
    lengths[order] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """The canonical code of each symbol: shorter codes first, then by symbol."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    codes = np.zeros(len(lengths), dtype=np.uint64)
    if len(order):
        ranked = lengths[order].astype(np.int64)
        width = int(ranked[-1])
        span = np.left_shift(1, width - ranked)
        first = np.concatenate([[0], np.cumsum(span)[:-1]])
        codes[order] = np.right_shift(first, width - ranked).astype(np.uint64)
    return codes


def pack_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, bytes]:
    """The ids' codes one after another, and the bit offset of every CHECKPOINT-th id.

    Each 64-bit word is the union of the codes that begin in it and of the rest of one that
    began in the word before; codes are shorter than a word, so some code begins in each.
    """
    if not len(ids):
        return bytes(8), b""
    size = lengths[ids].astype(np.int64)
    end = np.cumsum(size)
    begin = end - size
    room = 64 - (begin & 63) - size  # negative: bits that pass into the next word
    code = codes[ids]
    here = np.where(
        room >= 0,
        code << np.maximum(room, 0).astype(np.uint64),
        code >> np.maximum(-room, 0).astype(np.uint64),
    )
    word = begin >> 6
    heads = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    words = np.zeros((int(end[-1]) + 63) // 64 + 1, dtype=np.uint64)
    words[word[heads]] = np.bitwise_or.reduceat(here, heads)
    across = np.flatnonzero(room < 0)
    words[word[across] + 1] |= code[across] << (64 + room[across]).astype(np.uint64)
    return words.astype(">u8").tobytes(), begin[::CHECKPOINT].astype("<i8").tobytes()


class Decoder:
    """Table-driven decoding: the next ``width`` bits give the id and its length at once."""

    def __init__(self, lengths: np.ndarray):
        self.width = int(lengths.max(initial=1))
        self.ids = np.zeros(1 << self.width, dtype=np.uint32)
        self.sizes = np.zeros(1 << self.width, dtype=np.int64)
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[lengths[order] > 0]
        span = np.left_shift(1, self.width - lengths[order].astype(np.int64))
        filled = int(span.sum())
        self.ids[:filled] = np.repeat(order, span)
        self.sizes[:filled] = np.repeat(lengths[order], span)

    def unpack(self, bits: bytes, checkpoints: bytes, n: int) -> np.ndarray:
        """The ``n`` ids of a block; every stretch between checkpoints is a lane."""
        at = np.frombuffer(checkpoints, dtype="<i8").astype(np.int64)
        data = np.frombuffer(bits, dtype=np.uint8).astype(np.uint32)
        windows = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
        out = np.zeros((CHECKPOINT, len(at)), dtype=np.uint32)
        lanes, last = len(at), n - (len(at) - 1) * CHECKPOINT
        mask, shift = np.uint32((1 << self.width) - 1), 32 - self.width
        for step in range(CHECKPOINT if lanes else 0):
            if step == last:  # the last stretch is over
                lanes, at = lanes - 1, at[:-1]
                if not lanes:
                    break
            bits_at = windows[at >> 3] >> (shift - (at & 7)).astype(np.uint32)
            found = bits_at & mask
            out[step, :lanes] = self.ids[found]
            at = at + self.sizes[found]
        return out.T.reshape(-1)[:n]


# --- files --------------------------------------------------------------------------------


def write_tokens(
    docs: DataFrame, path: str, vocabulary: str, staging: Staging, end_id: int = END_ID
) -> None:
    """Encode ``docs`` (doc_id, text), each with ``end_id`` after it, and write them under
    ``path`` in ascending order of doc_id."""
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows = rows.withColumn("part", F.spark_partition_id())

    def raw_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, number, start = encoder(vocabulary), 0, 0, 0
        end = np.array([end_id], dtype=encode.dtype).tobytes()
        ids, data, held = [], [], 0

        def block() -> pa.RecordBatch:
            lengths = [len(d) // encode.dtype.itemsize for d in data]
            return _batch(_RAW, [part], [number], [start], [ids], [lengths], [b"".join(data)])

        for batch in batches:
            part = batch["part"][0].as_py() if batch.num_rows else part
            at = 0
            for texts in in_pieces(batch["text"].to_pylist()):
                for doc_id, found in zip(
                    batch["doc_id"][at : at + len(texts)].to_pylist(), encode.encode(texts)
                ):
                    ids.append(doc_id)
                    data.append(found + end)
                    held += len(data[-1]) // encode.dtype.itemsize
                    if held >= BLOCK_IDS:
                        yield block()
                        number, start = number + 1, start + held
                        ids, data, held = [], [], 0
                at += len(texts)
        if ids:
            yield block()

    raw = staging.write(rows.mapInArrow(raw_blocks, _RAW), "raw-blocks").df
    dtype = encoder(vocabulary).dtype.str
    lengths = code_lengths(_count(raw, dtype, encoder(vocabulary).size))
    code = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark = docs.sparkSession
    spark.createDataFrame(code, "id int, length int").coalesce(1).write.parquet(f"{path}/code")

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = canonical_codes(lengths)
        for row in _rows(batches):
            ids = np.frombuffer(row.pop("ids"), dtype=dtype)
            bits, checkpoints = pack_bits(ids, codes, lengths)
            yield _batch(_CODED, *([v] for v in row.values()), [bits], [checkpoints])

    raw.mapInArrow(coded, _CODED).write.parquet(f"{path}/blocks")
    n = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    parts = raw.groupBy("part").agg(F.max(F.col("start") + n).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    start = F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    parts.select("part", start).write.parquet(f"{path}/parts")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of all documents: ``ids`` as little-endian 32-bit integers, and
    ``start`` the number of ids of all documents before."""
    code = spark.read.parquet(f"{path}/code").collect()  # at most a vocabulary
    lengths = np.zeros(max((r.id for r in code), default=0) + 1, dtype=np.uint8)
    for r in code:
        lengths[r.id] = r.length

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(lengths)
        for row in _rows(batches):
            sizes = np.array(row["lengths"], dtype=np.int64)
            ids = decoder.unpack(row["bits"], row["checkpoints"], int(sizes.sum()))
            ends = np.cumsum(sizes)
            starts = row["start"] + ends - sizes
            data, cuts = ids.astype("<u4").tobytes(), (4 * ends).tolist()
            pieces = [data[a:b] for a, b in zip([0, *cuts], cuts)]
            step = max(1, len(pieces) * (8 << 20) // max(1, len(data)))  # about 8 MB a batch
            for i in range(0, len(pieces), step):
                to = slice(i, i + step)
                yield _batch(
                    "doc_id long, part int, start long, ids binary",
                    row["doc_ids"][to], [row["part"]] * len(pieces[to]), starts[to], pieces[to],
                )

    schema = "doc_id long, part int, start long, ids binary"
    docs = spark.read.parquet(f"{path}/blocks").mapInArrow(decoded, schema)
    parts = spark.read.parquet(f"{path}/parts").withColumnRenamed("start", "before")
    placed = docs.join(F.broadcast(parts), "part")  # one row per writing task
    return placed.select("doc_id", (F.col("before") + F.col("start")).alias("start"), "ids")


def _count(raw: DataFrame, dtype: str, size: int) -> np.ndarray:
    """How often each id occurs in all blocks: summed per task, then per id."""
    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for row in _rows(batches):
            total += np.bincount(np.frombuffer(row["ids"], dtype=dtype), minlength=size)
        found = np.flatnonzero(total)
        yield _batch("id int, n long", found, total[found])

    counted = raw.select("ids").mapInArrow(per_task, "id int, n long").groupBy("id")
    counts = np.zeros(size, dtype=np.int64)
    for r in counted.agg(F.sum("n").alias("n")).collect():  # at most a vocabulary
        counts[r["id"]] = r["n"]
    return counts


_ARROW = {
    "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(),
    "array<bigint>": pa.list_(pa.int64()),
}


def _batch(schema: str, *columns) -> pa.RecordBatch:
    fields = [f.split(" ") for f in schema.split(", ")]
    arrays = [pa.array(c, type=_ARROW[kind]) for c, (_, kind) in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch[name][i].as_py() for name in batch.schema.names}
