"""Near duplicates against brute force over all pairs."""

import random
import re

import numpy as np
import pytest

from wirestar.llm import minhash as m


def plain_set(text):
    text = re.sub("[A-Z]", lambda x: x[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def corpus():
    pick = random.Random(3)
    word = lambda: "".join(pick.choice("abcdefgh") for _ in range(4))
    rows, base = [], [word() for _ in range(60)]
    for i in range(60):  # a large group: all near the base, many not near each other
        copy = list(base)
        for _ in range(pick.choice([0, 1, 1, 2, 2, 3])):
            copy[pick.randrange(60)] = word()
        rows.append((1000 + i, " ".join(copy)))
    rows.append((5000, " ".join(base).upper()))
    for g in range(12):
        text = [word() for _ in range(pick.choice([4, 5, 8, 30, 200]))]
        for k in range(4):
            copy = list(text)
            for _ in range(k * len(text) // 40):
                copy[pick.randrange(len(copy))] = word()
            rows.append((20_000 + 100 * g + k, "\n ".join(copy)))
    passage = " ".join(word() for _ in range(25))  # shared, but not enough to link
    rows += [(7000 + i, passage + " " + " ".join(word() for _ in range(40))) for i in range(30)]
    return rows + [(1, None), (2, ""), (3, " \n"), (4, "É one"), (5, "é one"), (6, "É ONE"), (7, "É one")]


def brute(rows):
    sets = {i: plain_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in ids)


@pytest.mark.parametrize("small_bucket", [8, 2])
def test_components_equal_brute_force(spark, staging, monkeypatch, small_bucket):
    monkeypatch.setattr(m, "SMALL_BUCKET", small_bucket)
    monkeypatch.setattr(m, "BLOCK", 10)
    rows = corpus()
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, component int")
    got = sorted(tuple(r) for r in m.near_duplicates(df.repartition(4), staging).collect())
    assert got == brute(rows)


def test_null_and_repeated_ids(spark, staging):
    text = "one two three four five six"
    df = spark.createDataFrame([(3, text), (3, text), (None, text), (2, text)], "doc_id long, text string")
    got = {tuple(r) for r in m.near_duplicates(df, staging).collect()}
    assert got == {(2, 2, 2, True), (3, 2, 2, False), (None, 2, None, True)}


def test_components_of_long_paths_and_stars(spark, staging):
    edges = [(i, i + 1) for i in range(10, 90)] + [(200, i) for i in range(201, 260)] + [(300, 300)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r.node: r.component for r in m.connected(df, staging).collect()}
    assert got == {i: 10 for i in range(10, 91)} | {i: 200 for i in range(200, 260)}


def test_signature_estimates_similarity():
    shingler, signer = m.Shingler(), m.Signer(2000)
    a = shingler.shingles(" ".join(str(i) for i in range(400)))
    b = shingler.shingles(" ".join(str(i) for i in range(100, 500)))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs(m.alike(signer.sign(a), signer.sign(b)) / 2000 - true) < 0.05


def test_empty_table(spark, staging):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert m.near_duplicates(empty, staging).count() == 0


def test_a_lower_threshold_than_the_bands_are_made_for_is_refused(spark, staging):
    df = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    for operator in (m.near_duplicates, m.drop_near_duplicates):
        with pytest.raises(ValueError, match="percent=50"):
            operator(df, staging, percent=50)


def test_rows_of_a_repeated_id_are_told_apart(spark, staging):
    w, v = " ".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    rows = [(1, w, 1), (2, v, 2), (2, w + " x", 3), (3, v + " z", 4), (4, "other words stand here alone", 5),
            (4, "and these are not those at all", 6), (5, v, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(3)
    found = sorted(tuple(r) for r in m.near_duplicates(df, staging).collect())
    assert len(found) == len(rows)
    assert [(r[0], r[2], r[3]) for r in found if r[0] != 2] == [
        (1, 1, True), (3, 2, False), (4, 4, True), (4, 4, True), (5, 2, False)]
    assert sorted((r[2], r[3]) for r in found if r[0] == 2) == [(1, False), (2, True)]
    kept = m.drop_near_duplicates(df, staging).select("n").collect()
    assert sorted(r.n for r in kept) == [1, 2, 5, 6]
