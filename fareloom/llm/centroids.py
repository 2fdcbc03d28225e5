"""Centroid clustering of integer vectors, with bounds that save most distances.

Every vector keeps a lower bound of its distance to all centroids but its own. A round measures
the distance to the own centroid exactly; where that is below the bound (or below half the way
to the nearest other centroid) the vector stays. All others are ambiguous and are compared with
every centroid, in whole numbers, so bounds save work but never decide a result.

When centroids move, bounds must be loosened. The full drift of the centroid that moved most
would do, but it assumes that a centroid moves straight towards every vector. Instead, each
cluster is taken as a ball around its centroid and, for each other centroid, looked at in the
plane of the ball's centre and the way the other centroid went. From a vector x, seen from the middle m of a
way of length D, a centroid comes nearer by at most D times the cosine of the angle between the way and x - m:
d - d' = (d^2 - d'^2) / (d + d'), the numerator is 2 D |x - m| cos, and d + d' is at least 2 |x - m|.
The ball spans an angle of arcsin(radius / distance) around its centre, so the largest cosine
over the ball is known. A centroid that moves past or away from a ball loosens little or nothing.

A round is one pass: tasks read vectors, clusters and bounds, and write them back together with
their own sums per cluster, which Spark adds up. The driver sees the centroids and those sums,
which don't grow with the data. A large cluster is spread over tasks like any rows.

Defined results: a vector counts if it has exactly ``dims`` components, none NULL, NaN or
infinite; others take no part. A component x becomes floor(scale * x). The first centroids are
those vectors whose text ``<salt>:<id>`` has the smallest sha256 (a NULL id is the empty text; equal ids: the
smaller vector first), fewer if there are fewer vectors. Ties go to the smaller cluster number. A
repeated row is a vector of its own. A component beyond 2^27 in amount is an error, since
squared distances would no longer fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.llm.frames import batch_of, slices
from fareloom.llm.tables import Scratch

LARGEST = 1 << 27
# Up to this amount the products of two vectors of 64 components are exact in doubles.
_EXACT_SQUARES = 1 << 51
_WIDE = T.DecimalType(38, 0)
_SLACK = 1e-6

_POINTS = T.StructType([T.StructField("id", T.LongType()), T.StructField("vector", T.BinaryType())])
#: A vector with its state, or, without a distance, a task's sums of one cluster: rows, distances, components.
_STATE = T.StructType(
    [
        *_POINTS.fields,
        T.StructField("cluster", T.IntegerType()),
        T.StructField("distance", T.LongType()),
        T.StructField("bound", T.DoubleType()),
        T.StructField("farthest", T.LongType()),
        T.StructField("sums", T.ArrayType(_WIDE)),
    ]
)


def _to_integers(dims: int, scale: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "vector"):
                part = part.filter(pc.fill_null(pc.equal(pc.list_value_length(part.column("vector")), dims), False))
                values = part.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                kept = np.isfinite(values).all(axis=1)
                whole = np.floor(values[kept] * scale)
                if whole.size and np.abs(whole).max() > LARGEST:
                    raise ValueError(f"a component is beyond {LARGEST} in amount: squared distances would not fit a long")
                vectors = [row.tobytes() for row in whole.astype("<i4")]
                yield batch_of({"id": part.column("id").filter(pa.array(kept)), "vector": vectors}, _POINTS)

    return run


def squared_distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all centres (int64)."""
    largest = max(int(np.abs(points).max(initial=0)), int(np.abs(centres).max(initial=0)))
    kind = np.float64 if 4 * points.shape[1] * largest**2 <= _EXACT_SQUARES else np.int64
    x, c = points.astype(kind), centres.astype(kind)
    found = (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)[None, :]
    return found.astype(np.int64)


def loosening(old: np.ndarray, new: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """By how much at most any other centroid has come nearer to a vector in each cluster's ball.

    ``old`` and ``new`` are centroids before and after their move, ``radii`` those of balls
    around the old ones.
    """
    way = (new - old).astype(float)
    length = np.sqrt((way**2).sum(axis=1))
    middle = (old + new) / 2
    out = old[:, None, :] - middle[None, :, :]
    off = np.sqrt((out**2).sum(axis=2))
    with np.errstate(divide="ignore", invalid="ignore"):
        angle = np.arccos(np.clip((out * way[None, :, :]).sum(axis=2) / (off * length[None, :]), -1, 1))
        span = np.arcsin(np.clip(radii[:, None] / off, 0, 1))
        nearer = length[None, :] * np.clip(np.cos(np.maximum(angle - span, 0)), 0, 1)
    full = np.broadcast_to(length[None, :], nearer.shape)
    nearer = np.where(radii[:, None] < off, nearer, full)
    nearer = np.where(full > 0, np.minimum(nearer + _SLACK * full, full * (1 + 1e-12)), 0.0)
    np.fill_diagonal(nearer, 0.0)
    return nearer.max(axis=1)


def half_gaps(centres: np.ndarray) -> np.ndarray:
    """Half the distance from each centroid to the nearest other one."""
    apart = np.sqrt(squared_distances(centres, centres).astype(float))
    np.fill_diagonal(apart, np.inf)
    return apart.min(axis=1) / 2


def step(
    points: np.ndarray, cluster: np.ndarray, bound: np.ndarray, centres: np.ndarray, loosened: np.ndarray, gaps: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One round for some vectors: cluster, squared distance, bound, and which were scanned.

    ``cluster`` is -1 for a vector without a state.
    """
    own = np.maximum(cluster, 0)
    cluster = cluster.copy()
    bound = np.where(cluster < 0, -np.inf, bound - loosened[own])
    distance = ((points - centres[own]) ** 2).sum(axis=1)
    safe = np.where(cluster < 0, -np.inf, np.maximum(bound, gaps[own]))
    scanned = np.sqrt(distance.astype(float)) >= safe * (1 - 1e-9) - _SLACK
    for at in np.array_split(np.flatnonzero(scanned), max(1, int(scanned.sum()) * len(centres) >> 20)):
        if not len(at):
            continue
        every = squared_distances(points[at], centres)
        nearest = every.argmin(axis=1)
        rows = np.arange(len(at))
        cluster[at] = nearest
        distance[at] = every[rows, nearest]
        every[rows, nearest] = np.iinfo(np.int64).max
        bound[at] = np.sqrt(every.min(axis=1).astype(float)) if len(centres) > 1 else np.inf
    return cluster, distance, bound, scanned


def _exact_sum(values: np.ndarray) -> int:
    """The sum of longs, however large."""
    return (int((values >> 32).sum()) << 32) + int((values & 0xFFFFFFFF).sum())


def _round(centres: np.ndarray, loosened: np.ndarray):
    gaps = half_gaps(centres)
    k, dims = centres.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, inertia, farthest = [0] * k, [0] * k, [0] * k
        sums = np.zeros((k, dims), object)
        for batch in batches:
            for part in slices(batch, "vector"):
                points = np.frombuffer(b"".join(part.column("vector").to_pylist()), "<i4").reshape(-1, dims).astype(np.int64)
                cluster, distance, bound, _ = step(
                    points, part.column("cluster").to_numpy(), part.column("bound").to_numpy(), centres, loosened, gaps
                )
                for c in np.unique(cluster).tolist():
                    own = cluster == c
                    rows[c] += int(own.sum())
                    inertia[c] += _exact_sum(distance[own])
                    farthest[c] = max(farthest[c], int(distance[own].max()))
                    sums[c] += points[own].sum(axis=0)
                none = [None] * len(points)
                yield batch_of(
                    {
                        "id": part.column("id"), "vector": part.column("vector"), "cluster": cluster.astype(np.int32),
                        "distance": distance, "bound": bound, "farthest": none, "sums": none,
                    },
                    _STATE,
                )
        held = [c for c in range(k) if rows[c]]
        none = [None] * len(held)
        yield batch_of(
            {
                "id": none, "vector": none, "cluster": held, "distance": none, "bound": none, "farthest": [farthest[c] for c in held],
                "sums": [[Decimal(int(x)) for x in (rows[c], inertia[c], *sums[c])] for c in held],
            },
            _STATE,
        )

    return run


def _totals(state: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """By cluster: its farthest squared distance, and sums of rows, distances and components."""
    parts = state.where(F.col("distance").isNull()).select("cluster", "farthest", F.posexplode("sums").alias("place", "value"))
    added = parts.groupBy("cluster", "place").agg(F.sum("value").alias("value"), F.max("farthest").alias("farthest"))
    found: dict[int, tuple[int, dict[int, int]]] = {}
    for row in added.collect():
        found.setdefault(row.cluster, (row.farthest, {}))[1][row.place] = int(row.value)
    return {c: (far, [values[i] for i in range(len(values))]) for c, (far, values) in found.items()}


def clustered(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 40,
    rounds: int = 5,
    dims: int = 64,
    scale: int = 256,
    salt: str = "2",
    scratch: Scratch | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Vectors after ``rounds`` moves of the centroids and a last assignment, and the clusters.

    The first frame has a row per vector that counts: ``id``, ``vector`` (little-endian 32-bit integers), ``cluster``,
    ``distance`` (squared). The second has a row per cluster: ``cluster``, ``centroid`` (array of longs), ``size``,
    ``cluster_inertia``, ``inertia`` (decimals).
    """
    spark = df.sparkSession
    scratch = scratch or Scratch(spark, "centroids")
    given = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    points = scratch.write(given.mapInArrow(_to_integers(dims, scale), _POINTS), "points")
    name = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    chosen = points.orderBy(F.sha2(name, 256), *[F.col("vector")]).limit(k).collect()
    described = T.StructType(
        [
            T.StructField("cluster", T.IntegerType()),
            T.StructField("centroid", T.ArrayType(T.LongType())),
            *[T.StructField(c, _WIDE) for c in ("size", "cluster_inertia", "inertia")],
        ]
    )
    if not chosen:
        nothing = spark.createDataFrame([], _STATE).select("id", "vector", "cluster", "distance")
        return nothing, spark.createDataFrame([], described)
    centres = np.array([np.frombuffer(row.vector, "<i4") for row in chosen], np.int64)
    loosened = np.zeros(len(centres))
    state = points.select("*", F.lit(-1).alias("cluster"), F.lit(0.0).alias("bound"))
    for turn in range(rounds + 1):
        after = scratch.write(state.mapInArrow(_round(centres, loosened), _STATE), "state")
        scratch.drop(points if turn == 0 else before)
        before, state = after, after.where(F.col("distance").isNotNull()).select("id", "vector", "cluster", "bound")
        totals = _totals(after)
        if turn == rounds:
            break
        moved, radii = centres.copy(), np.zeros(len(centres))
        for c, (far, (size, _, *sums)) in totals.items():
            moved[c] = [s // size for s in sums]
            radii[c] = np.sqrt(float(far)) * (1 + 1e-9)
        loosened = loosening(centres, moved, radii)
        centres = moved
    whole = sum(sums[1] for _, sums in totals.values())
    rows = []
    for c, centre in enumerate(centres.tolist()):
        size, inertia = totals[c][1][:2] if c in totals else (0, 0)
        rows.append((c, centre, Decimal(size), Decimal(inertia), Decimal(whole)))
    vectors = after.where(F.col("distance").isNotNull()).select("id", "vector", "cluster", "distance")
    return vectors, spark.createDataFrame(rows, described)


def centroid_digest(centre: list[int]) -> str:
    """What identifies a centroid: the sha256 of its components as decimal numbers with commas between."""
    return hashlib.sha256(",".join(map(str, centre)).encode()).hexdigest()
