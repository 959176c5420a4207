"""Token files: exact round trip, best code lengths, checkpoints."""

import heapq
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wirestar.llm import byte_bpe
from wirestar.llm import token_files as m

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    (5, "hello  world \n and more\n\n  of it"), (3, None), (4, ""), (1, "a" * 100_000),
    (9, "Ünï 𝒯 <|endoftext|> x"), (9, "again"), (9, "again"), (None, "no id"),
    (20, "the cat sat on the mat. " * 5_000), (-7, "\tindented"),
]


@given(st.lists(st.integers(0, 10_000), min_size=2, max_size=60), st.integers(4, 12))
@settings(max_examples=60, deadline=None)
def test_lengths_are_a_full_code_and_best_without_a_limit(counts, limit):
    counts = np.array(counts)
    lengths = m.code_lengths(counts, limit)
    used = lengths[counts > 0].astype(int)
    if len(used) < 2:
        return
    assert used.max() <= max(limit, int(len(used) - 1).bit_length())
    assert sum(2.0**-x for x in used) == 1
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    best = 0
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        best += pair
        heapq.heappush(heap, pair)
    free = m.code_lengths(counts, 60)
    assert int((free.astype(int) * counts).sum()) == best


@given(st.lists(st.integers(0, 40), max_size=1500))
@settings(max_examples=40, deadline=None)
def test_bits_round_trip(ids):
    ids = np.array(ids, dtype="<u2")
    lengths = m.code_lengths(np.bincount(ids, minlength=41))
    bits, checkpoints = m.pack_bits(ids, m.canonical_codes(lengths), lengths)
    assert m.Decoder(lengths).unpack(bits, checkpoints, len(ids)).tolist() == ids.tolist()


def test_chunked_ids_equal_the_library(monkeypatch):
    library = Tokenizer.from_file(VOCABULARY)
    own = byte_bpe.ChunkEncoder(VOCABULARY, slots=8)
    texts = [t or "" for _, t in TEXTS] + [
        "", "  a", " a", "a  b", "a \n b", "a\n b", "\n\n b", "a\n\n  b", "a\tb c", "a ",
        "x <|endoftext|>\n y", "é 　 x y", "don't  'll we'll", "\x1c a \x1d b",
    ]
    got = [np.frombuffer(x, own.dtype).tolist() for x in own.encode(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_files_round_trip_in_order(spark, staging, monkeypatch):
    monkeypatch.setattr(m, "BLOCK_IDS", 300)
    df = spark.createDataFrame([(*t, 1) for t in TEXTS], "doc_id long, text string, part int")
    path = staging.path("tokens")
    m.write_tokens(df.repartition(3), path, VOCABULARY, staging)
    library = Tokenizer.from_file(VOCABULARY)
    want, start = [], 0
    for i, t in sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((start, i, zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    read = m.read_tokens(spark, path).select("start", "doc_id", F.crc32("ids").alias("c"))
    assert sorted(tuple(r) for r in read.collect()) == want


def test_empty_table(spark, staging):
    path = staging.path("tokens")
    m.write_tokens(spark.createDataFrame([], "doc_id long, text string"), path, VOCABULARY, staging)
    assert m.read_tokens(spark, path).count() == 0


def test_white_space_alone_and_among_other_texts():
    """Every white-space character as a text of its own, learned with and without others."""
    from tokenizers import Tokenizer

    from wirestar.llm.byte_bpe import ChunkEncoder
    from wirestar.llm.queries import BYTE_BPE

    library = Tokenizer.from_file(BYTE_BPE)
    blanks = [chr(c) for c in range(0x110000) if chr(c).isspace()] + ["\u180e", "\u200b", "\ufeff"]
    texts = ["hello"] + [t for c in blanks for t in (c, c + c, c + "x", "x" + c, f"a {c} b")] + ["other"]
    expected = [library.encode(t, add_special_tokens=False).ids for t in texts]

    def ids(found, encode):
        return [np.frombuffer(f, encode.dtype).tolist() for f in found]

    together = ChunkEncoder(BYTE_BPE)
    assert ids(together.encode(texts), together) == expected
    apart = ChunkEncoder(BYTE_BPE)
    assert [ids(apart.encode([t]), apart)[0] for t in texts] == expected
