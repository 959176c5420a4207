"""Packing documents into token sequences by swap-based local search.

Documents are encoded where they are read, and only pieces of a few numbers travel. A document
longer than a sequence is cut so that only its first piece is shorter; full pieces are
sequences of their own. The others are dealt at random into groups of about ``GROUP`` pieces,
each packed by itself, which costs at most about one sequence per group.

In a group, best fit of the longest first makes a start. Then the emptiest bin is taken apart
again and again: its documents move to, or are exchanged one for one or two for one with,
documents of fuller bins. Each such step makes a fuller bin fuller and an emptier one emptier,
so the sum of squared fills grows; a bin that loses its last document is gone.

Nulls: a null text counts as empty and holds the end id alone; rows with a null ``doc_id`` and
repeated rows are packed like others. An empty table gives an empty result. Extra columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wirestar.llm.byte_bpe import encoder, in_pieces
from wirestar.llm.common import give_back, text_or_empty
from wirestar.sources.staging import Staging

SEQUENCE = 2048
GROUP = 20_000
END_ID = 0
#: Bins that a group takes apart in vain before it stops.
PATIENCE = 60

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_lengths(n: int, most: int) -> list[int]:
    """Lengths of a document's pieces: all full but the first."""
    first = n % most
    return [first] * bool(first) + [most] * (n // most)


def pieces(docs: DataFrame, vocabulary: str, most: int = SEQUENCE) -> DataFrame:
    """The pieces of every document (doc_id, text) with the end id after its ids."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            rows, ids = [], iter(batch["doc_id"].to_pylist())
            for texts in in_pieces(text.as_py() for text in batch["text"]):
                for data in encode.encode(texts):
                    doc_id = next(ids)
                    found = np.frombuffer(data, dtype=encode.dtype).astype("<u4")
                    found, start = np.append(found, np.uint32(END_ID)).astype("<u4"), 0
                    for number, n in enumerate(cut_lengths(len(found), most)):
                        crc = zlib.crc32(found[start : start + n].tobytes())
                        rows.append((doc_id, number, start, n, crc))
                        start += n
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, type=kind) for c, kind in zip(columns, kinds)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)
        del encode, batches
        give_back()

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(cut, _PIECES)


def best_fit(lengths: np.ndarray, most: int) -> list[list[int]]:
    """Bins of indices: the longest first, each into the fullest bin it fits.

    Bins stand in stacks by room left; bit r of ``open_rooms`` tells that stack r is not empty.
    """
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(most + 1)]
    open_rooms = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fitting = open_rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                open_rooms &= ~(1 << room)
            bins[b].append(i)
        else:
            b, room = len(bins), most
            bins.append([i])
        by_room[room - n].append(b)
        open_rooms |= 1 << (room - n)
    return bins


class LocalSearch:
    """Bins of one group under improvement. ``of``: bin of each item; ``fill``: sum of each
    bin; ``members``: items of each bin."""

    def __init__(self, lengths: np.ndarray, bins: list[list[int]], most: int):
        self.lengths, self.most = lengths.astype(np.int64), most
        self.members = [list(b) for b in bins]
        self.of = np.empty(len(lengths), dtype=np.int64)
        for b, items in enumerate(self.members):
            self.of[items] = b
        self.fill = np.bincount(self.of, weights=self.lengths, minlength=len(bins)).astype(np.int64)

    def squared(self) -> int:
        return int((self.fill**2).sum())

    def run(self, patience: int = PATIENCE) -> list[list[int]]:
        vain, tried = 0, np.zeros(len(self.fill), dtype=bool)
        while vain < patience:
            open_bins = np.flatnonzero((self.fill > 0) & ~tried)
            total = int(self.fill.sum())
            if not len(open_bins) or np.count_nonzero(self.fill) * self.most < total + self.most:
                break  # nothing left to try, or as few bins as the total needs
            donor = int(open_bins[np.argmin(self.fill[open_bins])])
            tried[donor] = True
            while self.fill[donor] and self._step(donor):
                pass
            vain = vain + 1 if self.fill[donor] else 0
        return [b for b in self.members if b]

    def _step(self, donor: int) -> bool:
        """One improving move, else exchange, else two-for-one exchange out of ``donor``."""
        room = np.where((self.fill > 0) & (self.fill >= self.fill[donor]), self.most - self.fill, 0)
        room[donor] = 0
        items = sorted(self.members[donor], key=lambda i: -self.lengths[i])
        for x in items:
            n = int(self.lengths[x])
            target = int(np.argmin(np.where(room >= n, room, self.most + 1)))
            if room[target] >= n:
                self._shift([x], donor, target)
                return True
        reach = room[self.of]  # of each item's bin
        for x in items:
            if self._exchange(donor, [x], reach):
                return True
        for a, x in enumerate(items):
            for y in items[a + 1 :]:
                if self._exchange(donor, [x, y], reach):
                    return True
        return False

    def _exchange(self, donor: int, given: list[int], reach: np.ndarray) -> bool:
        """Give ``given`` for the one item that leaves the donor emptiest."""
        n = int(self.lengths[given].sum())
        gain = n - self.lengths
        gain = np.where((gain > 0) & (gain <= reach), gain, 0)
        taken = int(np.argmax(gain))
        if gain[taken] <= 0:
            return False
        target = int(self.of[taken])
        self._shift([taken], target, donor)
        self._shift(given, donor, target)
        return True

    def _shift(self, items: list[int], source: int, target: int) -> None:
        for i in items:
            self.members[source].remove(i)
            self.members[target].append(i)
            self.of[i] = target
            self.fill[source] -= self.lengths[i]
            self.fill[target] += self.lengths[i]


def pack_group(lengths: np.ndarray, most: int) -> list[list[int]]:
    return LocalSearch(lengths, best_fit(lengths, most), most).run()


def pack(
    docs: DataFrame, vocabulary: str, staging: Staging, most: int = SEQUENCE, group: int = GROUP
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = pieces(docs, vocabulary, most).withColumn("row", F.monotonically_increasing_id())
    cut = staging.write(cut, "pieces").df
    full = cut.where(F.col("length") == most)
    rest = cut.where(F.col("length") < most)
    groups = max(1, round(rest.count() / group))

    def in_group(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("row", kind="stable", ignore_index=True)
        lengths = part["length"].to_numpy()
        sequence = np.empty(len(part), dtype=np.int64)
        offset = np.empty(len(part), dtype=np.int64)
        first = int(part["bin"].iloc[0]) << 32
        for b, items in enumerate(pack_group(lengths, most)):
            sequence[items] = first + b
            offset[items] = np.cumsum(lengths[items]) - lengths[items]
        return part.drop(columns=["row", "bin"]).assign(sequence_id=sequence, offset=offset)

    schema = _PIECES + ", sequence_id long, offset long"
    dealt = rest.withColumn("bin", F.pmod(F.xxhash64("row"), F.lit(groups)))
    packed = dealt.groupBy("bin").applyInPandas(in_group, schema)
    alone = full.withColumns({"sequence_id": -1 - F.col("row"), "offset": F.lit(0).cast("long")})
    return packed.unionByName(alone.drop("row"))
