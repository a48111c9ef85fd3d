import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.llm import negatives

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
    T.StructField("id", T.StringType()), T.StructField("v", T.StringType()), T.StructField("q", T.StringType()), T.StructField("a.b", T.StringType()),
])


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA)


def mined(df, **more):
    out = negatives.mine(df, F.col("vec_id") % 10 == 0, F.col("label"), **more).collect()
    return sorted(tuple(r) for r in out)


def brute(rows, positives=5, negatives_=5, low=80, high=100):
    usable = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = tuple(math.floor(256 * float(np.float32(x))) for x in v)
        if sum(x * x for x in w) <= 2 ** 53:
            usable[(i, label, w)] = None
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, label, w in usable:
        if i % 10:
            continue
        others = [(-score(w, x), j, k == label) for j, k, x in usable if j != i]
        best = sorted({(s, j) for s, j, same in others if same})[:positives]
        for s, j in best:
            fit = sorted({(t, k) for t, k, same in others if not same and low * -s <= 100 * -t <= high * -s})[:negatives_]
            out += [(i, j, n + 1, k, -s, -t) for n, (t, k) in enumerate(fit)]
    return sorted(out)


def clusters(seed, n=600, width=12, hot=False):
    draw = np.random.default_rng(seed)
    centers = draw.normal(size=(9, width))
    rows = []
    for i in range(n):
        c = 0 if hot and i % 3 == 0 else int(draw.integers(9))
        v = centers[c] + draw.normal(size=width) * (0 if hot and i % 6 == 0 else .3)
        rows.append((i, [float(np.float32(x)) for x in v / np.linalg.norm(v)], int(draw.integers(4)) if draw.random() < .3 else c % 4))
    return rows


@pytest.mark.parametrize("hot", [False, True])
def test_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(negatives, "SPLITS", 7)
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 40)
    monkeypatch.setattr(negatives, "BLOCK_QUERIES", 25)
    rows = clusters(3 + hot, hot=hot)
    expected = brute(rows)
    assert len(expected) > 500 and mined(frame(spark, rows)) == expected


def test_other_windows_and_numbers(spark):
    rows = clusters(8, n=150)
    assert mined(frame(spark, rows), positives=3, negatives=7, low=30, high=55) == brute(rows, 3, 7, 30, 55)


def test_odd_rows(spark):
    one = [1.0, 0.5, 0.0]
    rows = [
        (10, one, 1), (10, one, 1), (10, [0.5, 1.0, 0.0], 1), (11, one, 1), (11, one, 1), (12, one, 2), (12, one, 2), (13, one, 2),
        (14, [0.9], 2), (15, [], 2), (16, None, 1), (17, [1.0, None], 1), (18, [float("nan"), 1.0], 2), (19, [float("inf")], 2),
        (None, one, 2), (20, one, None), (21, [-1.0, 0.0], 1), (30, [-1.0, -1.0], 1), (22, [1e30, 0.0], 2), (40, [0.0], 3),
        (23, [0.95, 0.5, 0.1], 2), (24, [0.8, 0.8, 0.8, 0.8], 1), (50, one, 2),
    ]
    assert mined(frame(spark, rows).repartition(3)) == brute(rows)


def test_empty_table(spark):
    assert mined(frame(spark, [])) == [] and mined(frame(spark, [(10, [1.0], 1)])) == []
    assert mined(frame(spark, [(10, None, 1), (11, [], 1)])) == []


def test_the_tree_eliminates_and_stays_exact(monkeypatch):
    draw = np.random.default_rng(1)
    centers = draw.integers(-200, 200, (40, 16))
    rows = (centers[draw.integers(40, size=6000)] + draw.integers(-12, 12, (6000, 16))).astype(float)
    ids, labels = np.arange(6000), draw.integers(0, 5, 6000)
    tree = negatives.Tree(rows, ids, labels)
    leaves = sum(isinstance(n, np.ndarray) for n in tree.nodes)
    assert sorted(np.concatenate([n for n in tree.nodes if isinstance(n, np.ndarray)])) == list(range(6000))
    for q in range(0, 6000, 300):
        scores = rows @ rows[q]
        top = scores.max() * .7
        for same, low, high in ((True, -np.inf, np.inf), (False, .8 * top, top), (False, top * 5, top * 6)):
            good = ((labels == labels[q]) == same) & (scores >= low) & (scores <= high) & (ids != q)
            expected = negatives.best(ids[good], scores[good], 5)
            found = tree.search(rows[q], q, labels[q], same, low, high, 5)
            assert (found[0] == expected[0]).all() and (found[1] == expected[1]).all()
    assert tree.leaves_read < 60 * leaves / 4


def test_equal_rows_make_one_leaf():
    tree = negatives.Tree(np.ones((1000, 4)), np.arange(1000), np.zeros(1000, np.int64))
    assert len(tree.nodes) == 1
    assert tree.search(np.ones(4), 0, 1, False, 1.0, 9.0, 3)[0].tolist() == [1, 2, 3]
