import math

import numpy as np
import pytest

from wirestar.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, shift_every=7, step=50):
    """The contract in plain Python integers."""
    used = []
    for place, (vec_id, vector, label) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if shift_every and vec_id is not None and vec_id % shift_every == 0:
            label = (label + 1) % 10
        components = [math.floor(float(np.float32(x)) * 256) for x in vector]
        used.append((vec_id, components, label, place))

    def order(hit):
        score, row = hit
        return -score, row[0] is None, row[0] or 0, row[3]

    found = []
    for anchor in used:
        if anchor[0] is None or anchor[0] % step:
            continue
        scored = [(sum(a * b for a, b in zip(anchor[1], r[1])), r) for r in used if r is not anchor]
        scored.sort(key=order)
        same = [hit for hit in scored if hit[1][2] == anchor[2]][: H.POSITIVES]
        for positive, p in same:
            band = [
                (s, r) for s, r in scored
                if r[2] != anchor[2] and 50 * positive <= 100 * s <= 95 * positive
            ]
            for rank, (score, r) in enumerate(band[: H.NEGATIVES], 1):
                found.append((anchor[0], p[0], rank, r[0], positive, score))
    return sorted(found, key=repr)


def mined(spark, staging, rows, schema=SCHEMA, **options):
    df = H.mine(spark.createDataFrame(rows, schema).coalesce(1), staging, **options)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert df.columns == names
    return sorted((tuple(r) for r in df.collect()), key=repr)


def clustered(n, size, seed, spread=0.6):
    random = np.random.default_rng(seed)
    centres = random.standard_normal((6, size))
    rows = []
    for i in range(n):
        v = centres[i % 6] + spread * random.standard_normal(size)
        v /= np.linalg.norm(v)
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(random.integers(0, 10))))
    return rows


@pytest.mark.parametrize("size", [64, 100, 5])
def test_against_brute_force_in_many_blocks(spark, staging, size):
    rows = clustered(600, size, size)
    expected = brute_force(rows)
    assert expected
    assert mined(spark, staging, rows, row_block=150, anchor_block=5) == expected


def test_ties_repeats_and_hot_vector(spark, staging):
    rows = clustered(240, 16, 1)
    hot = rows[3][1]
    rows += [(300 + i, hot, i % 10) for i in range(150)]
    rows += [rows[50], rows[50], (7, rows[9][1], 4), (None, rows[50][1], rows[50][2]), (None, hot, 2)]
    assert mined(spark, staging, rows, row_block=90, anchor_block=4) == brute_force(rows)


def test_rows_that_take_no_part(spark, staging):
    rows = clustered(200, 8, 2, spread=0.3)
    bad = [(50, [float("nan")] * 8, 1), (100, [float("inf")] + [0.0] * 7, 1), (150, None, 1),
           (200, [None] + [0.1] * 7, 1), (250, [0.1] * 8, None)]
    assert mined(spark, staging, rows + bad) == brute_force(rows)


def test_other_lengths_zeros_and_negative_scores(spark, staging):
    rows = clustered(150, 8, 3)
    rows += [(150, [], 1), (200, [0.0] * 8, 2), (250, [0.5] * 3, 3), (300, [-x for x in rows[1][1]], 4)]
    rows += [(350, rows[2][1] + [0.9] * 70, 5)]
    assert mined(spark, staging, rows) == brute_force(rows)


def test_scores_beyond_doubles(spark, staging):
    rows = [(i, [1e3 * (x + 1.5) for x in v], label % 2) for i, v, label in clustered(120, 8, 4)]
    rows = [(i, [1e3 * x for x in v], label) for i, v, label in rows]
    assert any(abs(r[4]) > 2**53 for r in mined(spark, staging, rows))
    assert mined(spark, staging, rows) == brute_force(rows)


def test_intervals_hold_every_score():
    random = np.random.default_rng(5)
    vectors = np.floor(256 * random.standard_normal((500, 128)))
    anchors = np.floor(256 * random.standard_normal((40, 128)))
    rotated = H.rotations(128)
    codes, weights, rest = H.encode(vectors, rotated)
    middle, around = H.Anchors(anchors, rotated).intervals(slice(0, 40), codes, weights, rest)
    true = anchors @ vectors.T
    assert (np.abs(true - middle) <= around).all()
    assert (rest < 0.2 * np.linalg.norm(vectors, axis=1)).all()  # 0.6 of the rest, four times
    assert around.mean() < 0.25 * np.outer(
        np.linalg.norm(anchors, axis=1), np.linalg.norm(vectors, axis=1)).mean()


def test_empty_tables_and_extra_columns(spark, staging):
    assert mined(spark, staging, []) == []
    assert mined(spark, staging, [(50, None, 1)]) == []
    rows = clustered(120, 8, 6)
    extra = [(*r, 1, 2.0) for r in rows]
    schema = SCHEMA + ", row int, score double"
    assert mined(spark, staging, extra, schema) == brute_force(rows)
