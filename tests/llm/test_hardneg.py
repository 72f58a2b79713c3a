"""Operator 11 against brute force, its intervals, and its defined cases."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notecodes.llm import hardneg

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, is_anchor, many=5, band=(80, 100)):
    valid = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        row = (vec_id, tuple(math.floor(256 * float(x)) for x in vector), label)
        if row not in valid:
            valid.append(row)
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for aid, av, al in valid:
        if not is_anchor(aid):
            continue
        others = sorted((-dot(av, v), i, lab) for i, v, lab in valid if i != aid)
        for score, pid, _ in [o for o in others if o[2] == al][:many]:
            p = -score
            near = [(-s, i) for s, i, lab in others if lab != al and band[0] * p <= band[1] * -s <= band[1] * p]
            out += [(aid, pid, rank, nid, p, n) for rank, (n, nid) in enumerate(near[:many], 1)]
    return sorted(out)


def mined(spark, rows, every=10, **more):
    got = hardneg.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % every == 0, **more)
    return sorted(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def vectors(n, dim, labels, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)) + rng.normal(size=(1, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return [(i, [float(np.float32(v)) for v in x[i]], int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("dim", [3, 64, 100])
def test_equals_brute_force(spark, dim):
    rows = vectors(300, dim, 3, dim)
    want = brute(rows, lambda i: i % 10 == 0)
    assert want and mined(spark, rows) == want


def test_waves_give_the_same(spark):
    rows = vectors(200, 16, 2)
    assert mined(spark, rows, anchors=7) == brute(rows, lambda i: i % 10 == 0)


def test_nulls_copies_ties_and_ids(spark):
    rows = vectors(120, 8, 2, 5)
    same = rows[3][1]
    rows += [(200 + i, same, i % 2) for i in range(40)]  # one vector under many ids: ties
    rows += rows[:30]  # repeated rows count once
    rows += [(20, rows[7][1], 0), (20, rows[8][1], 1)]  # other rows of an anchor's id
    rows += [(300, None, 1), (310, [1.0, None], 1), (320, [float("nan")], 0), (330, [float("inf")] * 8, 1), (340, same, None), (None, same, 1), (350, [], 1), (360, [0.5], 0)]
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_negative_and_zero_scores(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [-0.5, 0.0], 0), (2, [-0.4, 0.0], 1), (3, [0.0, 1.0], 0), (4, [0.0, 2.0], 1), (5, [0.0, -1.0], 1)]
    want = brute(rows, lambda i: i % 10 == 0)
    assert [r[1:4] for r in want] == [(3, 1, 4), (3, 2, 5)]  # a negative score has an empty band
    assert mined(spark, rows) == want


def test_empty_table_and_extra_columns(spark):
    assert mined(spark, []) == []
    rows = vectors(60, 4, 2, 9)
    more = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("slot", "score", "place", "vector", "code")})
    got = hardneg.mine(more, F.col("vec_id") % 10 == 0)
    assert sorted(tuple(r) for r in got.drop("positive_rank").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()) == brute(rows, lambda i: i % 10 == 0)
    assert isinstance(got.schema["positive_rank"].dataType, T.IntegerType)


def test_intervals_hold_and_are_narrow():
    rng = np.random.default_rng(4)
    v = np.floor(256 * rng.normal(size=(500, 64)) / 8).astype(np.int64)
    q = np.floor(256 * rng.normal(size=(20, 64)) / 8).astype(np.int64)
    v[0] = 0
    low, high = hardneg.intervals(hardneg.codes_of(v), hardneg.planes_of(q), slice(0, 500), slice(0, 20))
    exact = q @ v.T
    assert (low <= exact).all() and (exact <= high).all()
    width = (high - low) / np.maximum(np.outer(np.linalg.norm(q, axis=1), np.linalg.norm(v, axis=1)), 1)
    assert np.median(width) < 0.5


def test_rotation_keeps_products():
    x = np.random.default_rng(1).normal(size=(6, 128))
    y = hardneg.rotated(x, 2)
    assert np.allclose(x @ x.T, y @ y.T)
