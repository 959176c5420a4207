"""Packing: a gapless partition of all ids, close to the fewest sequences."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from wirestar.llm import packing as m

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [(1, "a b c"), (2, None), (3, ""), (4, "word " * 500), (4, "word " * 500), (None, "x"),
         (7, " ".join(str(i * i) for i in range(300)))] + [(10 + i, "pad " * (i % 23)) for i in range(80)]


@pytest.mark.parametrize("most,group", [(64, 1000), (64, 20), (2048, 20_000)])
def test_pieces_cover_ids_without_gaps(spark, staging, most, group):
    df = spark.createDataFrame([(*t, 1) for t in TEXTS], "doc_id long, text string, length int")
    rows = m.pack(df, VOCABULARY, staging, most, group).collect()
    library = Tokenizer.from_file(VOCABULARY)
    want = []
    for i, t in TEXTS:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        start = 0
        for k, n in enumerate(m.cut_lengths(len(ids), most)):
            want.append((i, k, start, n, zlib.crc32(ids[start : start + n].tobytes())))
            start += n
        assert start == len(ids)
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= most
    least = -(-sum(r.length for r in rows) // most)
    assert len(bins) <= least + max(2, len(rows) // group + 1)


def test_only_first_piece_is_shorter():
    assert m.cut_lengths(5000, 2048) == [904, 2048, 2048]
    assert m.cut_lengths(4096, 2048) == [2048, 2048] and m.cut_lengths(1, 2048) == [1]


@given(st.lists(st.integers(1, 100), min_size=1, max_size=120))
@settings(max_examples=60, deadline=None)
def test_search_keeps_items_and_never_loses_fill(lengths):
    lengths = np.array(lengths)
    start = m.best_fit(lengths, 100)
    search = m.LocalSearch(lengths, start, 100)
    before = search.squared()
    bins = search.run()
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(lengths[b].sum() <= 100 for b in bins)
    assert len(bins) <= len(start) and search.squared() >= before


def test_search_empties_a_bin_that_best_fit_leaves():
    lengths = np.array([6, 4, 4, 3, 3, 5, 5])  # 30 in three bins of ten
    worse = [[0, 1], [2, 3, 4], [5], [6]]
    assert len(m.LocalSearch(lengths, worse, 10).run()) == 3


def test_empty_table(spark, staging):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert m.pack(empty, VOCABULARY, staging).count() == 0
