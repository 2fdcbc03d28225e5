"""Neighbours against all pairs, the estimate's spread, recall at several widths."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareloom.llm import nearest as module
from fareloom.llm.nearest import encode, estimates, nearest, rotated
from fareloom.llm.queries import op13_nearest


def score(a, b):
    total = 0.0
    for x, y in zip(a, b, strict=True):
        total += x * y
    return total


def brute(rows, is_query, top):
    """For each query's place in ``rows`` the (rank, id, score) of its best."""
    good = [(i, key, v) for i, (key, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    found = []
    for i, key, v in good:
        if is_query(key):
            best = sorted(((-score(v, w), other is None, other or 0, j, other) for j, other, w in good if j != i and len(w) == len(v)))[:top]
            found += [(key, rank, other, -s) for rank, (s, _, _, _, other) in enumerate(best, 1)]
    return found


def run(spark, rows, top=5, every=4, kind="double", **more):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    got = nearest(df, F.col("vec_id") % every == 0, top=top, **more)
    return [(r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()]


@pytest.mark.parametrize("dims", [1, 3, 8, 30, 64])
def test_neighbours_equal_all_pairs(spark, monkeypatch, dims):
    monkeypatch.setattr(module, "CANDIDATES_PER_BLOCK", 90)
    monkeypatch.setattr(module, "QUERIES_PER_BLOCK", 20)
    rng = random.Random(dims)
    rows = [(i, [rng.gauss(0.1, 1) * 2 ** rng.randint(-3, 3) for _ in range(dims)]) for i in range(300)]
    got, want = run(spark, rows, sureness=5.0), brute(rows, lambda key: key % 4 == 0, 5)
    assert sorted(got) == sorted(want)


def test_copies_ties_and_hot_vectors(spark, monkeypatch):
    monkeypatch.setattr(module, "CANDIDATES_PER_BLOCK", 64)
    rng = random.Random(3)
    hot = [rng.gauss(0, 1) for _ in range(16)]
    rows = [(i, hot) for i in range(150)] + [(1000 + i, [rng.gauss(0, 1) for _ in range(16)]) for i in range(150)]
    got, want = run(spark, rows, top=20), brute(rows, lambda key: key % 4 == 0, 20)
    assert sorted(got) == sorted(want)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (None, [1.0, 2.0]), (4, None), (8, []), (12, [0.0, 0.0]), (16, [nan, 1.0]), (20, [inf, 1.0]),
        (24, [None, 1.0]), (28, [1.0, 0.0, 1.0]), (5, [-1.0, -1.0]), (32, [1e200, -1e200]), (36, [1e200, 1e200]), (40, [5e-324, 0.0]),
    ]
    got = run(spark, rows, top=9)
    by_query = {}
    for query, rank, other, value in sorted(got, key=lambda r: (r[0], r[1])):
        by_query.setdefault(query, []).append((rank, other, value))
    assert sorted(by_query) == [0, 32, 36, 40]  # 28 has no vector of its length to meet
    assert len(by_query[0]) == 2 * 6 and len(by_query[32]) == 6
    first = sorted(by_query[0])[:2]
    assert first == [(1, 36, 3e200)] * 2
    assert {other for _, other, _ in by_query[0]} == {0, None, 5, 32, 36, 40}
    assert all(not math.isnan(value) for _, _, _, value in got)
    assert run(spark, rows[:1]) == [] and run(spark, []) == [] and run(spark, [(1, [1.0]), (2, [2.0])]) == []


def test_other_columns_play_no_part(spark):
    rows = [(i, [float(i), 1.0], "x", 2, 3) for i in range(8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id string, query int, code int")
    got = nearest(df, F.col("vec_id") == 3, top=2).collect()
    assert nearest(df, F.col("vec_id") == 3, top=2).select("rank").count() == 2
    assert [(r["rank"], r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 7, 22.0), (2, 6, 19.0)]


def test_estimates_have_the_spread_they_claim():
    rng = np.random.default_rng(4)
    vectors, queries = rng.normal(size=(3000, 64)), rng.normal(size=(40, 64))
    code, norm, fit = encode(vectors)
    assert code.shape == (3000, 8) and np.allclose(norm, np.linalg.norm(vectors, axis=1))
    turned = rotated(queries)
    assert np.allclose(turned @ rotated(vectors).T, queries @ vectors.T)
    off = (estimates(turned, code) * norm / fit - queries @ vectors.T) / (np.linalg.norm(queries, axis=1)[:, None] * norm * np.sqrt(1 - fit**2) / fit / np.sqrt(63))
    assert abs(off.mean()) < 0.02 and 0.95 < off.std() < 1.05 and (np.abs(off) > 3).mean() < 0.005


def test_recall_of_the_query(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.1")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in op13_nearest(spark, sf_dir).collect()]
    x = np.array([v for _, v in rows])
    ids = [key for key, _ in rows]
    asked = [i for i, key in enumerate(ids) if key % 20 == 0]
    exact = x[asked] @ x.T
    exact[np.arange(len(asked)), asked] = -np.inf
    want = {(ids[i], ids[j]) for i, row in zip(asked, exact, strict=True) for j in np.argsort(-row, kind="stable")[:20]}
    found = {(query, other) for query, _, other, _ in got}
    assert len(got) == len(found) == len(want)
    assert len(found & want) >= 0.99 * len(want)
    by_id = dict(rows)
    assert all(value == score(by_id[query], by_id[other]) for query, _, other, value in got)
