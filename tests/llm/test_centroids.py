"""Clusters from plain rounds over all vectors, and bounds that hold for every vector."""

import hashlib
import math
import random

import numpy as np
import pytest

from fareloom.llm import centroids
from fareloom.llm.centroids import clustered, loosening, squared_distances, step
from fareloom.llm.queries import op11_centroids


def brute(rows, k, rounds, dims, scale):
    """(id, vector, cluster, distance) of what counts, in plain loops, and the centroids."""
    kept = [(key, tuple(math.floor(scale * x) for x in v)) for key, v in rows if v and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda key: hashlib.sha256(f"2:{'' if key is None else key}".encode()).hexdigest()
    first = sorted(kept, key=lambda r: (name(r[0]), np.array(r[1], "<i4").tobytes()))[:k]
    centres = [list(v) for _, v in first]

    def assign():
        found = []
        for key, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centres]
            found.append((key, v, d.index(min(d)), min(d)))
        return found

    for _ in range(rounds):
        found = assign()
        for c in range(len(centres)):
            own = [v for _, v, at, _ in found if at == c]
            if own:
                centres[c] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    return assign(), centres


def check(spark, rows, kind="float", k=6, rounds=4, dims=5, scale=256):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)
    vectors, clusters = clustered(df, k=k, rounds=rounds, dims=dims, scale=scale)
    want, centres = brute([(r.vec_id, r.embedding) for r in df.collect()], k, rounds, dims, scale)
    got = [(r.id, tuple(np.frombuffer(r.vector, "<i4").tolist()), r.cluster, r.distance) for r in vectors.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    told = {r.cluster: r for r in clusters.collect()}
    assert [list(told[c].centroid) for c in range(len(centres))] == centres
    for c, row in told.items():
        own = [d for _, _, at, d in want if at == c]
        assert (row.size, row.cluster_inertia, row.inertia) == (len(own), sum(own), sum(d for *_, d in want))
    return vectors, clusters


def test_clusters_equal_plain_rounds(spark):
    rng = random.Random(1)
    spots = [[rng.uniform(-1, 1) for _ in range(5)] for _ in range(9)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in rng.choice(spots)]) for i in range(600)]
    rows += [(i, rows[3][1]) for i in range(1000, 1300)] + [rows[7]] * 40
    check(spark, rows)
    check(spark, rows, k=1)
    check(spark, [(i, [float(rng.randint(0, 1)) for _ in range(5)]) for i in range(200)], scale=1)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0] * 4), (4, [1.0, 2.0, None, 1.0, 1.0]), (5, [nan] * 5), (6, [inf] * 5), (None, [0.5] * 5), (None, [0.25] * 5), (7, [-0.001] * 5), (7, [0.0] * 5)]
    vectors, _ = check(spark, rows, kind="double")
    assert vectors.count() == 4
    check(spark, rows[:6], kind="double")
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert [frame.count() for frame in clustered(empty)] == [0, 0]
    clashing = spark.createDataFrame([(i, [float(i)] * 5, 1, "x") for i in range(9)], "vec_id long, embedding array<float>, cluster int, distance string")
    assert clustered(clashing, k=3, dims=5)[0].count() == 9


def test_large_components_stay_exact(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1, 1]) * rng.uniform(2**18, 2**19) for _ in range(5)]) for i in range(60)]
    check(spark, rows, kind="double")
    with pytest.raises(Exception, match="would not fit a long"):
        clustered(spark.createDataFrame([(1, [2.0**20] * 5)], "vec_id long, embedding array<double>"), dims=5)


def test_bounds_hold_and_loosen_less_than_full_drift():
    rng = np.random.default_rng(3)
    tighter = scanned_rows = 0
    for turn in range(40):
        dims = int(rng.integers(1, 12))
        old = rng.integers(-300, 300, (7, dims))
        new = old + rng.integers(-60, 60, (7, dims)) * (rng.random((7, 1)) < 0.7)
        points = rng.integers(-300, 300, (400, dims))
        before = squared_distances(points, old)
        own = before.argmin(axis=1)
        radii = np.array([math.sqrt(before[own == c, c].max(initial=0)) for c in range(7)])
        found = loosening(old, new, radii)
        drift = np.sqrt(((new - old) ** 2).sum(axis=1))
        full = np.array([np.delete(drift, c).max() for c in range(7)])
        assert (found <= full * (1 + 1e-9)).all()
        tighter += (found < 0.9 * full).sum()
        nearer = np.sqrt(before) - np.sqrt(squared_distances(points, new))
        nearer[np.arange(400), own] = -np.inf
        assert (nearer.max(axis=1) <= found[own] + 1e-6).all()
        second = np.sqrt(np.sort(before, axis=1)[:, 1].astype(float))
        cluster, distance, bound, scanned = step(points, own, second, new, found, centroids.half_gaps(new))
        after = squared_distances(points, new)
        assert cluster.tolist() == after.argmin(axis=1).tolist() and distance.tolist() == after.min(axis=1).tolist()
        after[np.arange(400), cluster] = np.iinfo(np.int64).max
        assert (np.maximum(bound, 0) ** 2 <= after.min(axis=1) * (1 + 1e-9) + 1e-3).all()
        scanned_rows += scanned.sum()
    assert tighter > 40 and scanned_rows < 40 * 400


def test_query_covers_the_table(spark, sf_dir):
    got = op11_centroids(spark, sf_dir).collect()
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want, centres = brute(rows, 40, 5, 64, 256)
    assert {r.vec_id: (r.cluster, r.distance) for r in got} == {key: (c, d) for key, _, c, d in want}
    assert all(r.centroid_sha256 == centroids.centroid_digest(centres[r.cluster]) and r.inertia == sum(d for *_, d in want) for r in got)
