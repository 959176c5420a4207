"""The pipeline's stages, on rows whose fate is known and against its operators."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as p
from wirestar.llm.common import documents

WORDS = [f"w{i}" for i in range(60)]
DOCS = [
    (1, " ".join(WORDS), "en", "a", 1), (2, "  ".join(WORDS), "en", "b", 1),
    (3, " ".join([*WORDS[:59], "other"]), "en", "b", 1), (4, "you stupid idiot moron", "en", "a", 1),
    (5, "password = hunter2hunter2", "en", "a", 1), (6, None, None, None, None), (7, "", "en", "c", 0),
    (8, "clean words alone", "en", "c", 1), (8, "clean words alone", "en", "c", 1), (None, "no id", "en", "c", 1),
]


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(DOCS, schema).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality long, toxic long").write.parquet(f"{path}/labels.parquet")
    return path


def test_each_stage_keeps_what_it_should(spark, small):
    docs, kept = documents(spark, small), []
    for name, stage in p.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept.append(sorted((r.doc_id or -1 for r in docs.collect())))
        texts = {r.doc_id: r.text for r in docs.collect()}
    assert kept == [
        [-1, 1, 2, 3, 5, 6, 7, 8, 8], [-1, 1, 3, 5, 6, 8], [-1, 1, 5, 6, 8], [-1, 1, 5, 6, 8]
    ]
    assert texts[5] == "[SECRET]" and texts[8] == "clean words alone"


def test_run_packs_what_the_stages_keep(spark, sf_dir):
    rows = p.run(spark, sf_dir).collect()
    docs = documents(spark, sf_dir)
    for _, stage in p.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()}
    assert max(r.offset + r.length for r in rows) <= 2048
    assert public_tokenizers.path("byte_bpe_50k.json") == p.BYTE_BPE


CLASHING = ["_sha", "_found", "_gone", "_id", "_text", "_spans", "_keep_id", "score", "row", "spans",
            "key", "kept", "component", "set_hash", "signature", "n_shingles", "hash", "norm", "piece"]


@pytest.mark.parametrize("number", range(4))
def test_stages_keep_clashing_columns(spark, small, number):
    docs = documents(spark, small)
    more = docs.withColumns({c: F.lit(i) for i, c in enumerate(CLASHING)})
    name, stage = p.STAGES[number]
    kept = stage(spark, more, small)
    assert kept.columns == more.columns
    rows = kept.collect()
    assert rows and all([r[c] for c in CLASHING] == list(range(len(CLASHING))) for r in rows)
    assert stage(spark, more.limit(0), small).count() == 0


def test_packing_takes_clashing_columns(spark, small):
    more = documents(spark, small).withColumns({c: F.lit(1) for c in CLASHING})
    assert p.STAGES[4][1](spark, more, small).count() == len(DOCS)
