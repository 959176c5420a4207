"""Fingerprints against a plain implementation on strings."""

import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from wirestar.llm import syncmers as m

TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog, again and again and again."),
    (2, "The quick brown fox jumps over the lazy dog, again and again and again."),
    (4, None),
    (5, ""),
    (7, "short"),
    (600, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa"),
    (5000, "Ünïcödé 𝒯𝑒𝓍𝓉 " * 40),
    (5001, " ".join(f"w{i * i % 97}" for i in range(900))),
    (5002, "x" * 13),
    (5003, "abcdefghijklmnopqrstuvwxyz"),
]


def hashes(spark, pieces):
    df = spark.createDataFrame([(p,) for p in pieces], "p string")
    return {r.p: r.h for r in df.select("p", F.xxhash64("p").alias("h")).collect()}


def plain_positions(text, h):
    inner = [h[text[i : i + m.S]] for i in range(len(text) - m.S + 1)]
    width = m.K - m.S + 1
    found = []
    for i in range(len(inner) - width + 1):
        window = inner[i : i + width]
        if min(window[0], window[-1]) <= min(window[1:-1]):
            found.append(i)
    return found


def test_anchors_are_the_closed_syncmers(spark):
    texts = [t for _, t in TEXTS if t]
    h = hashes(spark, {t[i : i + m.S] for t in texts for i in range(len(t) - m.S + 1)})
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    df = df.select("text", F.transform(m.anchors(F.col("text")), m.position).alias("at"))
    for row in df.collect():
        assert row["at"] == plain_positions(row.text, h)


@pytest.fixture(scope="module")
def result(spark):
    from wirestar.sources.staging import Staging

    df = spark.createDataFrame([(*r, "x") for r in TEXTS], "doc_id long, text string, next string")
    with Staging(spark) as staging:
        return {r.doc_id: r for r in m.edited_with_next(df, staging).collect()}


def test_edited_text_and_direct_fingerprint(spark, result):
    edited = {}
    for (i, text), (_, following) in zip(TEXTS, [*TEXTS[1:], TEXTS[0]]):
        text, following = text or "", following or ""
        half = len(text) // 2
        edited[i] = text[: len(text) - half] + following[:half]
    assert set(result) == set(edited)
    df = spark.createDataFrame(list(edited.items()), "doc_id long, text string")
    text = F.col("text")
    direct = df.select("doc_id", m.written(m.hashes(m.anchors(text), text)).alias("f")).collect()
    for row in direct:
        got = result[row.doc_id]
        want = hashlib.sha256(edited[row.doc_id].encode()).hexdigest()
        assert got.edited_sha256 == want
        assert got.edited_fingerprint == row.f


def test_ends_and_ties(result):
    assert result[1].fingerprint == result[2].fingerprint and result[1].near_next == 1.0
    assert result[4].fingerprint == "" and result[4].near_next == 1.0 and result[4].n_chars == 0
    assert len(result[7].fingerprint) == 8 and result[7].near_next == 0.0
    assert all(0 <= r.near_edited <= 1 and 0 <= r.aligned_edited <= 1 for r in result.values())


def test_fingerprint_has_every_anchor_and_likeness_is_that_of_the_whole_sets(result):
    def parts(fingerprint):
        data = base64.b64decode(fingerprint)
        return {data[i : i + 4] for i in range(0, len(data), 4)}

    ids = [i for i, _ in TEXTS]
    for i, following in zip(ids, [*ids[1:], ids[0]]):
        own, row = parts(result[i].fingerprint), result[i]
        for other, got in ((parts(row.edited_fingerprint), row.near_edited), (parts(result[following].fingerprint), row.near_next)):
            assert got == pytest.approx(len(own & other) / len(own | other) if own | other else 1.0)
    assert len(parts(result[5001].fingerprint)) > 64


def test_a_shared_passage_of_long_texts_always_shows(spark, staging):
    pick = random.Random(7)

    def prose(n):
        return "".join(pick.choice("abcdefghijklmnop ") for _ in range(n))

    rows = []
    for i in range(0, 40, 2):
        passage = prose(800)
        rows += [(i, passage + prose(19_200)), (i + 1, passage + prose(19_200))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    near = {r.doc_id: r.near_next for r in m.edited_with_next(df, staging).collect()}
    assert all(near[i] > 0.01 for i in range(0, 40, 2))
    assert all(near[i] < 0.01 for i in range(1, 40, 2))


def test_moved_passage_aligns_at_its_shift(spark):
    text = TEXTS[7][1]
    df = spark.createDataFrame([(text, "seven: " + text)], "a string, b string")
    a, b = m.anchors(F.col("a")), m.anchors(F.col("b"))
    row = df.select(m.aligned(a, b, 7).alias("at7"), m.aligned(a, b).alias("at0")).first()
    assert row.at7 == 1.0 and row.at0 < 0.2


def test_empty_table(spark, staging):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert m.edited_with_next(empty, staging).count() == 0
