"""Alignment of the tokens of two tokenizers, and how usual each pair of tokens is.

Both tokenizers cover the same bytes: a space and the text. The byte offsets where a token ends
are the keys of a dictionary per side, from offset to the number of tokens up to there. The keys
that both dictionaries have, sorted, cut both id lists into groups, and every token of one side of
a group is linked with every token of the other.

A space or line feed after a visible character begins a token on both sides, and what stands before
it does not matter to what follows. So texts are cut there, the different chunks that a worker does
not remember are aligned together, and a text's groups are those of its chunks in turn. The memory
has a fixed size: two generations, of which the older is forgotten when the younger is full.

Texts are read and tokenized once. Each document's numbers, its different pairs and how often
each is linked are written to the shared folder. From there Spark counts the documents of each
pair, summed per task first, so a pair that all documents share is one row per task. The counts
are joined to the documents' pairs: broadcast where they were counted below ``BROADCAST_PAIRS``,
else by a shuffle; a pair has at most one row of a document there, so none is hotter than one in
a document's many.

Nulls: a null text, an empty one, and one whose joined tokens are not the space and the text (the
piece model writes U+2581 for a space, so a text that has it is not) have no tokens: all
numbers are 0 and ``groups_sha256`` is empty. A null ``doc_id`` and repeated rows are documents
like others, each counted. Strings of special tokens are plain text. A very long text takes memory
in proportion to its length, a chunk without common ends to its different ids on both sides. Of
equal counts all are best. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wirestar.sources.staging import Staging

#: Where a chunk begins. Python's white space takes in all that both tokenizers know.
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
#: A chunk is encoded after this letter, a piece of its own, so that the dummy space is not its.
_LEAD = "x"
#: Chunks in a generation of a worker's memory, and the longest of them in characters.
REMEMBERED = 200_000
LONGEST = 48
#: New chunks in one text for the libraries.
JOINED = 64
#: Links of a group up to which they are listed; larger groups count equal ids first.
LISTED = 4_096
#: Pair counts that may be broadcast: about 50 MB.
BROADCAST_PAIRS = 1_000_000
#: Bits of a pair for the second id.
B_BITS = 31

_NUMBERS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_ALIGNED = _NUMBERS + ", pairs array<bigint>, times array<bigint>"


# --- alignment ----------------------------------------------------------------------------------


def ends(sizes: np.ndarray) -> dict[int, int]:
    """How many tokens end at or before each byte offset where one ends."""
    return dict(zip(np.cumsum(sizes).tolist(), range(1, len(sizes) + 1)))


def common_ends(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Offsets where tokens of both sides end, in order, and how many tokens each side has up to
    there: where the groups end."""
    a_ends, b_ends = ends(a_sizes), ends(b_sizes)
    offsets = sorted(a_ends.keys() & b_ends.keys())
    return tuple(
        np.fromiter(found, np.int64, len(offsets))
        for found in (offsets, map(a_ends.get, offsets), map(b_ends.get, offsets))
    )


def links(a: np.ndarray, b: np.ndarray, a_cuts, b_cuts) -> tuple[np.ndarray, ...]:
    """Pairs linked in each group, how often, and the number of them by group. A pair comes as
    often as it is linked, but in large groups once."""
    n_a, n_b = (np.diff(cuts, prepend=0) for cuts in (a_cuts, b_cuts))
    listed = n_a * n_b
    large = np.flatnonzero(listed > LISTED)
    listed[large] = 0
    total = np.cumsum(listed)
    within = np.arange(total[-1] if len(total) else 0) - np.repeat(total - listed, listed)
    width = np.repeat(n_b, listed)
    left = a[np.repeat(a_cuts - n_a, listed) + within // np.maximum(width, 1)]
    right = b[np.repeat(b_cuts - n_b, listed) + within % np.maximum(width, 1)]
    pairs, times = left << B_BITS | right, np.ones(len(left), np.int64)
    for g in reversed(large.tolist()):
        x, n = np.unique(a[a_cuts[g] - n_a[g] : a_cuts[g]], return_counts=True)
        y, m = np.unique(b[b_cuts[g] - n_b[g] : b_cuts[g]], return_counts=True)
        listed[g] = len(x) * len(y)
        at = int(total[g])
        pairs = np.insert(pairs, at, ((x << B_BITS)[:, None] | y).reshape(-1))
        times = np.insert(times, at, np.outer(n, m).reshape(-1))
    return pairs, times, listed


class Writer:
    """Groups as text, ``a1,a2|b1;a3|b2,b3;``: an id is its digits and the sign after it."""

    def __init__(self, size: int):
        digits = np.arange(size).astype("S7").reshape(-1, 1).view(np.uint8).reshape(size, 7)
        self.letters = np.concatenate([digits, np.zeros((size, 1), np.uint8)], axis=1)
        self.lengths = (digits > 0).sum(axis=1) + 1

    def write(self, a: np.ndarray, b: np.ndarray, a_cuts, b_cuts) -> tuple[bytes, np.ndarray]:
        """The text, and where in it each group ends."""
        n_a, n_b = (np.diff(cuts, prepend=0) for cuts in (a_cuts, b_cuts))
        group_ends = a_cuts + b_cuts
        ids = np.empty(len(a) + len(b), np.int64)
        a_at = np.arange(len(a)) + np.repeat(b_cuts - n_b, n_a)
        b_at = np.arange(len(b)) + np.repeat(a_cuts, n_b)
        ids[a_at], ids[b_at] = a, b
        letters = self.letters[ids]
        letters[:, 7] = ord(",")
        letters[group_ends - n_b - 1, 7] = ord("|")
        letters[group_ends - 1, 7] = ord(";")
        upto = np.cumsum(self.lengths[ids])
        return letters.tobytes().translate(None, b"\0"), upto[group_ends - 1]


#: Of a chunk: how many tokens both sides have, groups, links and listed pairs; the groups as text;
#: the pairs and how often each is linked. All but the text are 64-bit integers.
Chunk = tuple[bytes, bytes, bytes, bytes]
_NUMBERS_OF_CHUNK = 5


@functools.lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    """The worker's aligner for the two vocabularies, made once."""
    return Aligner(a_path, b_path)


class Aligner:
    def __init__(self, a_path: str, b_path: str, remembered: int = REMEMBERED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.a_sizes[i] = len(token)  # one character stands for one byte
        self.b = SentencePieceProcessor(model_file=b_path)
        self.b_bytes = [self._bytes_of(i) for i in range(self.b.get_piece_size())]
        self.b_sizes = np.array(list(map(len, self.b_bytes)), np.int64)
        self.lead = self.b.encode(_LEAD)
        self.writer = Writer(max(len(self.a_sizes), len(self.b_bytes)))
        self.remembered = remembered
        self.young: dict[str, Chunk | None] = {}
        self.old: dict[str, Chunk | None] = {}

    def _bytes_of(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def _align(self, chunks: list[str]) -> list[Chunk | None]:
        """Chunks aligned, or None where the joined tokens are not the chunk. Where a chunk ends,
        tokens of both sides end, so many are aligned in one pass."""
        joined = ["".join(chunks[i : i + JOINED]) for i in range(0, len(chunks), JOINED)]
        encoded = self.a.encode_batch_fast(joined, add_special_tokens=False)
        a = np.fromiter(chain.from_iterable(e.ids for e in encoded), np.int64)
        pieces = self.b.encode([_LEAD + text for text in joined], num_threads=1)
        b_ids = list(chain.from_iterable(ids[len(self.lead) :] for ids in pieces))
        data = "".join(joined).encode()
        whole = b"".join(map(self.b_bytes.__getitem__, b_ids)) == data
        if not whole or self.a_sizes[a].sum() != len(data):
            if len(chunks) == 1:
                return [None]
            half = len(chunks) // 2
            return self._align(chunks[:half]) + self._align(chunks[half:])
        b = np.array(b_ids, np.int64)
        offsets, a_cuts, b_cuts = common_ends(self.a_sizes[a], self.b_sizes[b])
        pairs, times, listed = links(a, b, a_cuts, b_cuts)
        written, written_ends = self.writer.write(a, b, a_cuts, b_cuts)
        n_links = np.diff(a_cuts, prepend=0) * np.diff(b_cuts, prepend=0)
        chunk_ends = np.cumsum([len(c.encode()) for c in chunks])
        last = np.searchsorted(offsets, chunk_ends)  # a chunk's last group
        n_pairs = np.cumsum(listed)[last]
        upto = [a_cuts[last], b_cuts[last], last + 1, np.cumsum(n_links)[last], n_pairs]
        numbers = np.diff(np.stack(upto, axis=1), axis=0, prepend=0).astype(np.int64).tobytes()
        width = 8 * _NUMBERS_OF_CHUNK
        pair_cuts, text_cuts = (8 * n_pairs).tolist(), written_ends[last].tolist()
        pairs, times = pairs.tobytes(), times.tobytes()
        return [
            (numbers[i : i + width], written[t:u], pairs[p:q], times[p:q])
            for i, t, u, p, q in zip(
                range(0, len(numbers), width), [0, *text_cuts], text_cuts, [0, *pair_cuts], pair_cuts
            )
        ]

    def align(self, texts: list[str | None]) -> Iterator[tuple[list[Chunk], list[int], bytes]]:
        """Per text: its different chunks, how often it has each, and its groups as text. A text
        without tokens has no chunks."""
        cut = [_CUT.split(" " + t) if t else [] for t in texts]
        if len(self.young) > self.remembered:
            self.old, self.young = self.young, {}
        found, new = {}, []
        for c in {c for chunks in cut for c in chunks}:
            if c in self.young:
                found[c] = self.young[c]
            elif c in self.old:
                found[c] = self.young[c] = self.old[c]
            else:
                new.append(c)
        if new:
            # White space alone could join what stands after it.
            blank = [c for c in new if not c.strip()]
            visible = [c for c in new if c.strip()]
            aligned = [one for c in blank for one in self._align([c])]
            aligned += self._align(visible) if visible else []
            fresh = dict(zip(blank + visible, aligned))
            found.update(fresh)
            self.young.update((c, f) for c, f in fresh.items() if len(c) <= LONGEST)
        for chunks in cut:
            counted = Counter(chunks)
            own = [found[c] for c in counted]
            if None in own:
                yield [], [], b""
            else:
                written = {c: f[1] for c, f in zip(counted, own)}
                yield own, list(counted.values()), b"".join(map(written.get, chunks))[:-1]


def document_sums(chunks: list[Chunk], times: list[int]) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Of a document: its numbers of tokens, groups and links, its different pairs, and how often
    each is linked."""
    numbers, _, pairs, linked = map(b"".join, zip(*chunks))
    sizes = np.frombuffer(numbers, np.int64).reshape(-1, _NUMBERS_OF_CHUNK)
    times = np.array(times)
    linked = np.frombuffer(linked, np.int64) * np.repeat(times, sizes[:, 4])
    pairs = np.frombuffer(pairs, np.int64)
    order = np.argsort(pairs, kind="stable")
    pairs = pairs[order]
    first = np.flatnonzero(np.diff(pairs, prepend=-1))
    return (times @ sizes[:, :4]).tolist(), pairs[first], np.add.reduceat(linked[order], first)


# --- operator -----------------------------------------------------------------------------------


def _runs(batch: pa.RecordBatch, at_once: int = 1 << 20) -> Iterator[tuple[list, list]]:
    """Ids and texts of a batch, about ``at_once`` bytes of text at a time."""
    ids, texts, size = [], [], 0
    for doc_id, text in zip(batch["doc_id"], batch["text"]):
        ids.append(doc_id.as_py())
        texts.append(text.as_py())
        size += len(texts[-1] or "")
        if size >= at_once:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def aligned_documents(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Of each row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and the
    different pairs with how often each is linked."""
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a_path, b_path)
        for batch in batches:
            for ids, texts in _runs(batch):
                rows = []
                for doc_id, (chunks, times, written) in zip(ids, both.align(texts)):
                    if not chunks:
                        rows.append((doc_id, 0, 0, 0, 0, "", [], []))
                        continue
                    sizes, pairs, linked = document_sums(chunks, times)
                    digest = hashlib.sha256(written).hexdigest()
                    rows.append((doc_id, *sizes, digest, pairs, linked))
                kinds = [pa.int64()] * 5 + [pa.string()] + [pa.list_(pa.int64())] * 2
                arrays = [pa.array(c, type=kind) for c, kind in zip(zip(*rows), kinds)]
                names = [field.split()[0] for field in _ALIGNED.split(", ")]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select("doc_id", "text").mapInArrow(align, _ALIGNED)


def pair_counts(aligned: DataFrame, staging: Staging) -> tuple[DataFrame, int]:
    """(pair, n, best): in how many documents each pair of ids is linked, and whether no other
    pair of its first id is in more. And the number of pairs."""
    apart = aligned.select(F.explode("pairs").alias("pair"))
    counted = staging.write(apart.groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "pair-counts")
    a_id = F.shiftright("pair", B_BITS)
    best = counted.df.groupBy(a_id.alias("a")).agg(F.max("n").alias("most"))  # at most a vocabulary
    marked = counted.df.join(F.broadcast(best), a_id == F.col("a"))
    return marked.select("pair", "n", (F.col("n") == F.col("most")).alias("best")), counted.rows


def align_documents(
    docs: DataFrame, a_path: str, b_path: str, staging: Staging,
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256."""
    aligned = aligned_documents(docs, a_path, b_path)
    aligned = aligned.withColumn("row", F.monotonically_increasing_id())
    aligned = staging.write(aligned, "aligned").df
    counts, n_pairs = pair_counts(aligned, staging)
    if n_pairs <= broadcast_pairs:
        counts = F.broadcast(counts)
    linked = F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("times")))
    # A document's pairs are in one task, which sums them before they are shuffled.
    sums = aligned.select("row", linked).join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("times")).alias("count_sum"),
    )
    zero = F.lit(0).cast("long")
    return aligned.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(
        sums, "row", "left"
    ).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256",
    )
