"""Rows that a join cannot find are known before its shuffle."""

import pyarrow as pa
import pytest

from wirestar.llm import byte_bpe, common, minhash, packing, secrets, toxicity
from wirestar.llm.queries import BYTE_BPE


@pytest.mark.parametrize("most_bits", [2**26, 2**15])
def test_no_key_is_without_a_chance(spark, monkeypatch, most_bits):
    monkeypatch.setattr(common, "MOST_BITS", most_bits)
    keys = spark.range(0, 200_000, 10).selectExpr("id as k").repartition(5)
    rows = spark.range(200_000).selectExpr("id", "id as _part", "id % 3 as _bitmap")
    found = common.with_chance(rows, "id", keys, 20_000, "chance")
    assert found.columns == [*rows.columns, "chance"] and found.count() == 200_000
    assert found.where("chance and id % 10 = 0").count() == 20_000
    others = found.where("chance and id % 10 > 0").count()
    assert others < (8_000 if most_bits > 2**15 else 100_000)


def test_empty_and_null_keys(spark):
    rows = spark.createDataFrame([("a",), (None,), ("b",)], "k string")
    none = common.with_chance(rows, "k", rows.where("false"), 0, "chance")
    assert [r.chance for r in none.collect()] == [False] * 3
    some = common.with_chance(rows, "k", rows.where("k is null or k = 'b'"), 2, "chance")
    assert {r.k: r.chance for r in some.collect()} == {"a": False, None: True, "b": True}


def texts(spark):
    """2,000 texts of their own, 20 with a near copy and 20 with a live secret."""
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(40))) for i in range(2_000)]
    rows += [(5_000 + i, text + " more") for i, text in rows[:20]]
    rows += [(9_000 + i, f"password = Xk{i}Qz81Lm09Vt{i} {rows[100 + i][1][:9]}") for i in range(20)]
    return spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, source string")


def joined(monkeypatch, module, names):
    """Rows of each call that go on to a join, by the columns they have."""
    seen = []

    def only(df, *args):
        found = common.with_chance_only(df, *args)
        seen.append((df.columns, df.count(), found.count()))
        return found

    def flagged(df, key, keys, n_keys, name):
        found = common.with_chance(df, key, keys, n_keys, name)
        seen.append((df.columns, df.count(), found.where(name).count()))
        return found

    for name, stand_in in zip(("with_chance_only", "with_chance"), (only, flagged)):
        if name in names:
            monkeypatch.setattr(module, name, stand_in)
    return seen


def test_only_texts_with_a_chance_are_joined_for_near_copies(spark, staging, monkeypatch):
    docs = texts(spark)
    seen = joined(monkeypatch, minhash, ("with_chance_only", "with_chance"))
    assert minhash.drop_near_duplicates(docs, staging).count() == docs.count() - 20
    whole = [(n, m) for columns, n, m in seen if "text" in columns]
    assert len(whole) >= 2 and all(m < n / 10 for n, m in whole)
    signed = [(n, m) for columns, n, m in seen if "signature" in columns]
    assert len(signed) >= 2 and all(m < n / 10 for n, m in signed)


def test_only_texts_with_a_chance_are_joined_for_masks(spark, staging, monkeypatch):
    docs = texts(spark)
    seen = joined(monkeypatch, secrets, ("with_chance",))
    masked = secrets.mask_live(docs, staging)
    assert masked.columns == docs.columns and masked.count() == docs.count()
    assert masked.where("contains(text, '[SECRET]')").count() == 20
    assert masked.intersect(docs).count() == docs.count() - 20
    (_, n, m), = seen
    assert 20 <= m < n / 10


class Taken:
    """Stands for a table and keeps the work that it is given."""

    def select(self, *columns):
        return self

    def mapInArrow(self, work, schema):
        self.work = work
        return self


@pytest.mark.parametrize("stage", [minhash.signatures, minhash.shingle_sets])
def test_workers_drop_the_vocabulary_when_other_work_begins(spark, stage):
    work = stage(Taken()).work
    byte_bpe.encoder(BYTE_BPE)
    assert byte_bpe.encoder.cache_info().currsize == 1
    assert list(work(iter([]))) == [] and byte_bpe.encoder.cache_info().currsize == 0


def test_packing_keeps_the_vocabulary_and_gives_the_rest_back(spark, monkeypatch):
    given = []
    monkeypatch.setattr(packing, "give_back", lambda: given.append(1))
    work = packing.pieces(Taken(), BYTE_BPE).work
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["some text", ""]})
    found, = work(iter([batch]))
    assert found["doc_id"].to_pylist() == [1, 2] and given == [1]
    assert byte_bpe.encoder.cache_info().currsize == 1


def test_toxicity_takes_texts_as_arrow_batches(spark):
    docs = spark.createDataFrame([(1, "you are an idiot"), (2, ""), (3, None)], "doc_id long, text string")
    found = toxicity.with_evidence(docs, toxicity.Model((("idiot", 3.0),)))
    assert "ArrowEvalPython" in found._jdf.queryExecution().toString()
    clauses = {r.doc_id: r._found.clauses for r in found.collect()}
    assert clauses == {1: 1, 2: 0, 3: 0}


def test_frugal_gives_back_after_the_last_batch_and_after_an_error(monkeypatch):
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    assert list(common.frugal(lambda b: (x + 1 for x in b))(iter([1, 2]))) == [2, 3]
    assert given == [1]

    def fails(batches):
        yield next(batches)
        raise ValueError

    with pytest.raises(ValueError):
        list(common.frugal(fails)(iter([1])))
    assert given == [1, 1]
    common.give_back()
