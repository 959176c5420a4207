"""The pair occurrence index against the tokenizers library."""

import hashlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from wirestar.llm import word_bpe as m

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(VOCABULARY)
LIBRARY.no_truncation()
LIBRARY.no_padding()
TEXTS = [
    "", " ", "Hello World, it's 2024!", "aaaaaaaaaaaa aaaaa", "ΟΔΟΣ Σ ΣΣ", "İstanbul ẞ", "é é ñ ñ",
    "x<|endoftext|>y <|startoftext|> <|ENDOFTEXT|>", "tab\tnew\nline\x0b\x1c\x1d mixed\x1f", "日本語 한국어 🎉🎉",
    "don't we'll I'M they'RE", "a" * 5000, "word " * 20_000, "　wide space", "...!!! --- $$$a1b22",
]


def library(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


def own(bpe, texts):
    return [(np.frombuffer(ids, "<u4").tolist(), text) for ids, text in bpe.encode(texts)]


def test_ids_and_decoding_equal_the_library():
    assert own(m.WordBpe(VOCABULARY, remembered=10), TEXTS * 2) == [library(t) for t in TEXTS * 2]


def test_documents_equal_the_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in m.encode_documents(docs, VOCABULARY).collect():
        ids, decoded = library(texts[r.doc_id])
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.decoded == decoded


CODEC = m.WordBpe(VOCABULARY)


@given(st.lists(st.text(alphabet="abeinorst'É.1 ", max_size=40), max_size=8))
@settings(max_examples=150, deadline=None)
def test_any_text_equals_the_library(texts):
    assert own(CODEC, texts) == [library(t) for t in texts]


def test_a_lower_rank_made_by_a_merge_comes_first(tmp_path):
    import json

    letters = m.byte_letters().values()
    tokens = [*letters, *(x + "</w>" for x in letters), "ab", "bc", "abc", "abca", "abcab", "ca"]
    merges = [["bc", "a"], ["abc", "a"], ["b", "c"], ["a", "bc"], ["a", "b"], ["ab", "c"]]
    tokens += ["bca"]
    with open(VOCABULARY, encoding="utf-8") as file:
        spec = json.load(file)
    spec["model"] |= {"vocab": {t: i for i, t in enumerate(tokens)}, "merges": merges}
    spec["added_tokens"] = []
    path = tmp_path / "small.json"
    path.write_text(json.dumps(spec))
    small = Tokenizer.from_file(str(path))
    words = ["abcabcx", "abcaabc", "cabcab", "bcabca", "aabbcc"]
    got = m.WordBpe.__new__(m.WordBpe)
    spec["added_tokens"] = [{"content": "<s>", "id": 999_999}]
    path.write_text(json.dumps(spec))
    got.__init__(str(path))
    assert got.merge_words(words) == [small.encode(w).ids for w in words]


def test_digest_and_odd_rows(spark):
    df = spark.createDataFrame([(1, None, 1), (None, "a b", 2), (3, "x", 3), (3, "x", 3)], "doc_id long, text string, ids long")
    rows = m.digest_documents(df, VOCABULARY).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == 4 and by_id[1].n_tokens == 0
    assert by_id[1].decoded_sha256 == hashlib.sha256(b"").hexdigest()
    ids, decoded = library("a b")
    assert by_id[None].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert by_id[None].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert m.digest_documents(df.limit(0), VOCABULARY).count() == 0
