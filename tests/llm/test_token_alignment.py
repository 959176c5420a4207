import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from wirestar.llm import token_alignment as A

BYTE = public_tokenizers.path("byte_bpe_50k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(BYTE)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=PIECE)


def whole_text(libraries, text):
    """Groups of a text, without chunks: one pass over the ends of both sides."""
    if not text:
        return []
    a, b = libraries
    names = {i: token for token, i in a.get_vocab().items()}
    left = a.encode(" " + text, add_special_tokens=False).ids
    right = b.encode(text)
    sizes = [len(names[i]) for i in left]
    pieces = [b.id_to_piece(i) for i in right]
    pieces = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
              for i, p in zip(right, pieces)]
    if b"".join(pieces) != (" " + text).encode():
        return []
    groups, i, j, at_a, at_b = [], 0, 0, 0, 0
    while i < len(left):
        group = ([], [])
        while True:
            if at_a <= at_b and i < len(left):
                group[0].append(left[i])
                at_a, i = at_a + sizes[i], i + 1
            else:
                group[1].append(right[j])
                at_b, j = at_b + len(pieces[j]), j + 1
            if at_a == at_b:
                break
        groups.append(group)
    return groups


def brute_force(libraries, rows):
    cut = [whole_text(libraries, text) for _, text in rows]
    linked = [Counter((x, y) for left, right in g for x in left for y in right) for g in cut]
    counts = Counter(pair for found in linked for pair in found)
    most = Counter()
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    found = []
    for (doc_id, _), groups, pairs in zip(rows, cut, linked):
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        found.append((
            doc_id, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups),
            sum(pairs.values()), sum(n for p, n in pairs.items() if counts[p] == most[p[0]]),
            sum(n * counts[p] for p, n in pairs.items()),
            hashlib.sha256(written.encode()).hexdigest() if groups else "",
        ))
    return sorted(found, key=repr)


def aligned(spark, staging, docs, **options):
    df = A.align_documents(docs, BYTE, PIECE, staging, **options)
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                          "groups_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


CASES = [
    "plain words, and more words", " leading", "  two", "trailing ", "trailing  \n", "\n", " ",
    "\n\nlines\nand \n  more\n\n\n  lines", "tab\there \t x", "a\r\nb \r c;\r d", "x", "xx x\nx",
    "no\xa0break \xa0 \xa0x　y", "é è ê ﬁ Ａ ½", "日本語のテキスト とスペース", "😀 👩‍👩‍👧 x😀y",
    "under ▁ line", "<|endoftext|> <s> </s> <unk> <0x41>", "it's they'll I'D", "12345 67 8,9.0",
    "a\x00b \x01 \x1c x \x85 y   z​ ᠎ q ﻿ w", "é ́x", "…—“quoted”",
    "aaaa" * 40, "word " * 30,
]


def test_cases_against_brute_force(spark, staging, libraries):
    rows = [(i, text) for i, text in enumerate(CASES)]
    rows += [(None, None), (None, "plain words"), (3, ""), (3, None), (0, CASES[0]), (0, CASES[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute_force(libraries, rows)
    assert aligned(spark, staging, docs) == expected
    assert aligned(spark, staging, docs, broadcast_pairs=0) == expected


def test_whole_table_against_brute_force(spark, staging, libraries, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert aligned(spark, staging, docs.repartition(5)) == brute_force(libraries, rows)


def test_every_character_before_and_after_a_cut(libraries):
    """Chunks have the ids that they have in the whole text."""
    align = A.Aligner(BYTE, PIECE, remembered=2_000)
    points = [*range(0x3000), *range(0xFE00, 0x10000), 0x1F600, 0xE0020]
    for i in range(0, len(points), 40):
        letters = map(chr, points[i : i + 40])
        text = "".join(f"q{c} w{c}\n{c} {c}e \n" for c in letters if c != "▁")
        (_, _, written), = align.align([text])
        expected = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y))
                            for x, y in whole_text(libraries, text))
        assert written.decode() == expected, hex(points[i])


@pytest.mark.parametrize("listed", [0, 3, 4_096])
def test_links_of_small_and_large_groups(monkeypatch, listed):
    monkeypatch.setattr(A, "LISTED", listed)
    a, b = np.array([1, 1, 2, 1, 7]), np.array([5, 5, 5, 8])
    pairs, times, by_group = A.links(a, b, np.array([3, 4, 5]), np.array([2, 3, 4]))
    found = Counter()
    for pair, n in zip(pairs.tolist(), times.tolist()):
        found[pair >> A.B_BITS, pair & 0xFFFF] += n
    assert found == {(1, 5): 5, (2, 5): 2, (7, 8): 1}
    assert by_group.sum() == len(pairs) == len(times)


def test_forgetting_and_long_chunks_change_nothing():
    small, large = A.Aligner(BYTE, PIECE, remembered=3), A.Aligner(BYTE, PIECE)
    texts = ["one two three", "four five one", "z" * 70_000 + " " + "ab" * 30, "one two three"] * 3
    assert [w for t in texts for *_, w in small.align([t])] == [w for *_, w in large.align(texts)]


def test_empty_table_and_extra_columns(spark, staging):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert aligned(spark, staging, empty) == []
    clash = spark.createDataFrame([(1, "one two", 3, 4)], "doc_id long, text string, pair int, row int")
    assert len(aligned(spark, staging, clash)) == 1
