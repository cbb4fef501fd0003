"""Exact search against brute force."""

import numpy as np
from pyspark.sql import functions as F

from procurelytics.llm import voronoi

SCHEMA = "vec_id long, embedding array<double>, score string"


def brute(rows, every, k):
    out = set()
    for q, x in rows.items():
        if q % every == 0:
            best = sorted((-sum(int(a) * int(b) for a, b in zip(x, y)), i) for i, y in rows.items() if i != q)[:k]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best)}
    return out


def search(spark, data, every=5, k=3, **kw):
    df = spark.createDataFrame(data, SCHEMA)
    v = voronoi.scaled_vectors(df, "vec_id", "embedding", 256)
    return {tuple(r) for r in voronoi.top_products(v, F.col("vec_id") % every == 0, k, **kw).collect()}


def test_matches_brute_force_with_ties_clusters_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(voronoi, "DATA_BLOCK", 40)
    monkeypatch.setattr(voronoi, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(4, 6)) * 5
    data = {i: (centre[i % 4] if i % 3 else centre[0]) + rng.integers(-2, 3, 6) * (i % 2) for i in range(200)}
    whole = {i: np.floor(256 * v) for i, v in data.items()}
    assert search(spark, [(i, v.tolist(), "") for i, v in data.items()], pivots=8) == brute(whole, 5, 3)


def test_odd_rows_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(5, None, None), (10, [1.0, None], ""), (15, [nan, 1.0], ""), (20, [1.0, -inf], ""), (None, [1.0, 1.0], ""), (25, [], ""), (30, [1.0], "")]
    good = [(0, [1.0, 0.0], ""), (1, [0.5, 0.5], ""), (2, [0.5, 0.5], ""), (2, [0.5, 0.6], "")]
    assert search(spark, odd + good) == {(0, 1, 1, 128 * 256), (0, 2, 2, 128 * 256)}
    assert search(spark, odd) == set() and search(spark, []) == set() and search(spark, [(0, [1.0], "")]) == set()


def test_products_beyond_doubles(spark):
    big = {0: [2.0**22, 3.0], 1: [2.0**21 + 1 / 256, 1 / 256], 2: [2.0**21, 1 / 128]}
    whole = {i: [int(x * 256) for x in v] for i, v in big.items()}
    assert search(spark, [(i, v, "") for i, v in big.items()]) == brute(whole, 5, 3)
