import numpy as np
from pyspark.sql import functions as F

from stationflow.llm import hamming


def brute(rows, asks, k):
    out = []
    for q, qc in asks:
        near = sorted(((qc ^ c).bit_count(), i) for i, c in rows if (i, c) != (q, qc))
        out += [(q, n + 1, i, d) for n, (d, i) in enumerate(near[:k])]
    return sorted(out)


def code(vector):
    return sum(1 << (63 - i) for i, x in enumerate(vector[:64]) if x is not None and x > 0)


def test_equals_brute_force_with_hot_codes_and_blocks(spark, monkeypatch):
    rng = np.random.default_rng(8)
    vectors = [rng.normal(size=64).tolist() for _ in range(300)]
    vectors += [vectors[0]] * 150 + [[-x if i == 3 else x for i, x in enumerate(vectors[1])]] * 3
    rows = [(i, v, "x") for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, code string").repartition(4)
    plain = [(i, code(v)) for i, v, _ in rows]
    expected = brute(plain, [p for p in plain if p[0] % 20 == 0], 10)
    for sizes in ((1 << 15, 1 << 11), (64, 5)):
        monkeypatch.setattr(hamming, "BLOCK_CODES", sizes[0])
        monkeypatch.setattr(hamming, "BLOCK_QUERIES", sizes[1])
        found = hamming.top_k(df, F.col("vec_id") % 20 == 0, 10)
        assert sorted(tuple(r) for r in found.collect()) == expected


def test_odd_rows(spark):
    rows = [(None, [1.0] * 64), (1, None), (2, []), (3, [1.0]), (4, [1.0] * 70), (5, [None] * 64), (5, [None] * 64), (6, [1.0] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    plain = sorted({(i, code(v)) for i, v in rows if i is not None and v is not None})
    found = hamming.top_k(df, F.lit(True), 10)
    assert sorted(tuple(r) for r in found.collect()) == brute(plain, plain, 10)


def test_search_is_exact_at_every_radius():
    rng = np.random.default_rng(3)
    for n in (1, 5, 400, 3000):
        codes = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        index = hamming.MultiIndex(codes)
        for q in rng.integers(0, 1 << 62, 5).astype(np.uint64):
            places, distances = index.search(q, np.ones(len(codes), int), 7)
            far = np.bitwise_count(codes ^ q)
            last = np.sort(far)[min(7, len(codes)) - 1]
            assert sorted(places.tolist()) == np.flatnonzero(far <= last).tolist()
            assert (far[places] == distances).all()


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert hamming.top_k(df, F.col("vec_id") % 100 == 0).count() == 0
