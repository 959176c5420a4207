"""Toxicity: the grammar's compositions, and held-out accuracy."""

import random

import pytest
from pyspark.sql import functions as F

from wirestar.llm import toxicity as m


@pytest.fixture(scope="module")
def rules():
    return m.Grammar(m.Model((("vequ", 6.0),)))


def test_composition(rules):
    plain = rules.evidence("an idiot walked")[0]
    assert plain > 0
    assert rules.evidence("you are an idiot")[0] > plain
    assert rules.evidence("this is not an idiot plan")[0] < plain
    assert rules.evidence("somebody said idiot")[0] < plain
    assert rules.evidence("they kill time. nothing")[0] > rules.evidence("a kill switch")[0] == 0
    assert rules.evidence("vequais")[0] == 6.0 and rules.evidence("prevequais")[0] == 0
    assert rules.evidence("clean words. more, of them")[0] == rules.evidence("")[0] == 0
    assert rules.evidence("trashcan")[0] == 0  # an exact word, not a beginning


def readings(rules, words):
    """Each telling word as a head, weighed by plain rules of where other words stand."""
    symbols = [rules.read(w) for w in words]
    for at, (symbol, weight) in enumerate(symbols):
        if not symbol & (m.INSULT | m.THREAT):
            continue

        def where(bit):
            return [i for i, (x, _) in enumerate(symbols) if x & bit]

        if any(at - m.REACH <= i <= at for i in where(m.NEGATION)):
            weight *= m.NEGATED
        targets, reports = where(m.TARGET), where(m.REPORT)
        before, after = any(i <= at for i in targets), any(i > at for i in targets)
        if symbol & m.INSULT:
            weight *= m.INSULT_AT["before" if before else "after" if after else "nobody"]
        else:
            weight *= m.THREAT_AT["after"] if after else m.THREAT_AT["before"] if before else 0.0
        if reports:
            weight *= m.REPORTED["before" if reports[0] <= at else "after"]
        yield weight


def test_machine_equals_a_search_of_all_readings(rules):
    pick, bag = random.Random(3), "idiot scum kill hurt you they not don't said wrote vequan a house of".split()
    for _ in range(3_000):
        words = [pick.choice(bag) for _ in range(pick.randrange(14))]
        want = sum(readings(rules, words))
        assert rules.clause_score(" ".join(words)) == pytest.approx(want, abs=1e-9), words


def test_places_of_targets_and_reports(rules):
    score = rules.clause_score
    assert score("you idiot") > score("idiot you") > score("idiot")
    assert score("kill you") > score("you kill") > score("kill") == 0
    assert score("idiot") > score("idiot she said") / m.INSULT_AT["after"] > score("he said idiot") / m.INSULT_AT["before"]


def test_composition_has_all_readings_of_one_head():
    machine = m.insult_transducer().then(m.threat_transducer())
    both = [m.INSULT, m.THREAT, m.INSULT]
    paths = [(machine.start, ())]
    for symbol in both:
        paths = [(to, (*out, o)) for state, out in paths for to, o, _ in machine.arcs.get((state, symbol), ())]
    heads = sorted(tuple(bool(o & m.HEAD) for o in out) for state, out in paths if state in machine.ends)
    assert heads == [(False, False, True), (False, True, False), (True, False, False)]


def test_clauses_are_scored_apart(rules):
    together, apart = rules.evidence("you idiot")[0], rules.evidence("you. idiot")[0]
    assert together > apart
    assert rules.evidence("idiot. " * 3)[1] == 3
    assert rules.evidence("x" * 300_000 + " idiot")[1] == 1


def test_long_clauses_are_parsed_whole(rules):
    for gap in range(380, 420):  # a second insult around the 400th character
        assert rules.evidence("idiot " + "x" * gap + " idiot")[0] == 2 * rules.evidence("idiot")[0]
    filler = "word " * 200
    assert rules.evidence("you " + filler + "idiot")[0] > rules.evidence(filler + "idiot")[0]
    assert rules.evidence("idiot " + filler + "said")[0] < rules.evidence("idiot " + filler)[0]
    assert rules.evidence("not. " + filler + "idiot " + filler + "scum")[1] == 1


def test_stems_need_support_and_purity():
    counts = [("lowe", 0, 40), ("lowei", 0, 40), ("begi", 30, 40), ("rare", 0, 2), ("almo", 1, 150), ("long", 5, 40), ("longer", 0, 39)]
    assert dict(m.choose_stems(counts, 2000, 160)).keys() == {"lowei", "almo", "long", "longer"}
    assert m.choose_stems(counts, 0, 0) == ()


def test_rare_stems_among_many_candidates_are_learned(spark, staging):
    pick = random.Random(5)
    filler = ["".join(pick.choice("abcdefghij") for _ in range(8)) for _ in range(5_000)]  # > 20,000 stems
    rows = []
    for i in range(30):  # "zzinsult" is the last by contexts, and by alphabet
        pick.shuffle(filler)
        rows.append((i, f"c{i % 6} zzinsult. " + " ".join([*filler, *reversed(filler)]), 1))
    rows += [(100 + i, "calm words", 0) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic long")
    model = m.learn(df.select("doc_id", "text"), df.select("doc_id", "toxic"), staging)
    assert any("zzinsult".startswith(stem) for stem, _ in model.stems)


def test_held_out_documents(spark, staging):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    found = m.score_documents(docs, labels, staging).join(labels, "doc_id").where("held_out")
    right = found.groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in right}
    assert n[(1, 1)] / (n[(1, 1)] + n.get((1, 0), 0)) > 0.9
    assert n.get((0, 1), 0) / (n[(0, 0)] + n.get((0, 1), 0)) < 0.01


def test_rejecting_keeps_columns_and_odd_rows(spark, staging):
    rows = [(1, "you stupid idiot moron", "a"), (2, None, "b"), (3, "", "c"), (None, "fine", "d"), (4, "fine", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([], "doc_id long, toxic long")
    kept = m.reject_toxic(docs, labels, staging)
    assert kept.columns == docs.columns
    assert {tuple(r) for r in kept.collect()} == set(rows[1:])
    scored = m.score_documents(docs, labels, staging).collect()
    assert len(scored) == 5 and all(0 <= r.score <= 1 for r in scored)
    assert m.score_documents(docs.limit(0), labels, staging).count() == 0
    null = spark.createDataFrame([(None, None)], "doc_id long, toxic long")
    assert m.learn(docs, null, staging).stems == ()


def test_held_out_rows_teach_nothing(spark, staging):
    ids = [(i, "zzqq%d word" % i, 1) for i in range(60)]
    df = spark.createDataFrame(ids, "doc_id long, text string, toxic long")
    sample = m.labelled_sample(df.select("doc_id", "text"), df.select("doc_id", "toxic"), staging)
    assert sample.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1).count() == 0
