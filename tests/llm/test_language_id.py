"""Language identification: subwords, held-out accuracy, calibration, rejection."""

import numpy as np
import pytest

from wirestar.llm import language_id as m


@pytest.fixture(scope="module")
def found(spark):
    from wirestar.sources.staging import Staging

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    with Staging(spark) as staging:
        rows = m.identify(docs, staging).join(docs.select("doc_id", "lang", "text"), "doc_id")
        return rows.where("held_out").collect()


def test_held_out_accuracy_and_calibration(found):
    known = [r for r in found if r.lang and r.lang_pred != m.UNKNOWN]
    assert len(known) > 100
    right = np.array([r.lang == r.lang_pred for r in known])
    assert right.mean() > 0.97
    scores = np.array([r.score for r in known])
    assert abs(scores.mean() - right.mean()) < 0.05
    assert np.mean([r.rejected for r in known]) < 0.1


def test_subwords_of_a_batch_are_those_of_each_text():
    texts = ["Éa bc", "", "x1y", "ab\0cd", "ω" * 5, "a"]
    buckets, counts = m.subwords(texts)
    alone = [m.subwords([t]) for t in texts]
    assert counts.tolist() == [int(c[0]) for _, c in alone]
    assert buckets.tolist() == [b for found, _ in alone for b in found.tolist()]
    assert counts[0] > counts[1] == 0


def test_texts_without_letters_and_odd_rows(spark, staging):
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 !", "de"), (4, "the house " * 9, "en"),
            (6, "das haus " * 9, "de"), (6, "das haus " * 9, "de"), (None, "house", None),
            (8, "word " * 60_000, None)]
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, score double")
    got = m.identify(df, staging).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.lang_pred == m.UNKNOWN) == (r.doc_id in (1, 2, 3))
        assert r.lang_pred in ("und", "en", "de") and 0 <= r.score <= 1
    assert m.identify(df.limit(0), staging).count() == 0
    unlabelled = df.withColumn("lang", df.lang.substr(9, 1)).replace("", None, ["lang"])
    assert {r.lang_pred for r in m.identify(unlabelled, staging).collect()} == {m.UNKNOWN}
