"""Nearest neighbours by inner product, from randomly rotated one-bit codes.

A vector is rotated at random (three rounds of random signs and a Hadamard transform) and only
the signs of its components are kept, one bit each, packed. Two scalars go with them: the norm, and how
well the code fits (the inner product of the rotated unit vector with the unit vector along its signs). The
inner product of a query with the code, divided by the fit, estimates the inner product
with the vector without bias, and its error has a known spread:
norm * |query| * sqrt((1 - fit^2) / fit^2) / sqrt(components - 1). A query reads a
code by the byte, from a table of the sums of its own components.

Queries meet all vectors in blocks: both sides are dealt to blocks by the hash of a row's place, and each pair
of blocks is one group of a bounded size. In it, the vectors that look best are measured exactly, which gives a
threshold; then every vector whose estimate plus ``SURENESS`` spreads reaches the threshold is
measured exactly as well. A true neighbour is missed only if its estimate is off by more. Scores
are always those of the original vectors, in double precision, added in the order of components.

Defined results: vectors that are NULL, zero, or hold a NULL, NaN or infinite component take no part, as query or
as candidate. Vectors of different lengths are never compared. A query meets every row but its own, rows
that repeat its id or its vector included; ties go to the smaller id (NULL last). A score that
overflows is infinite; one that is no number (infinities of both signs) counts as minus infinity.
Fewer candidates than asked for: all of them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.llm.frames import batch_of, slices
from fareloom.llm.tables import FILE, PLACE, ROW, Scratch

#: Spreads that an estimate may be off before a neighbour is missed.
SURENESS = 3.0
CANDIDATES_PER_BLOCK = 1 << 15
QUERIES_PER_BLOCK = 512
#: Vectors measured for a first threshold, for each one asked for.
FIRST_LOOKS = 6
# Queries and pairs that a task looks at in one go.
_AT_ONCE = 8
_PAIRS_AT_ONCE = 1 << 16
_SEED = 20240613
_RIGHT = "right_"

_ROWS = T.StructType(
    [
        T.StructField(FILE, T.LongType()),
        T.StructField(ROW, T.LongType()),
        T.StructField("id", T.LongType()),
        T.StructField("query", T.BooleanType()),
        T.StructField("dims", T.IntegerType()),
        T.StructField("vector", T.BinaryType()),
        T.StructField("code", T.BinaryType()),
        T.StructField("norm", T.DoubleType()),
        T.StructField("fit", T.DoubleType()),
    ]
)
_FOUND = T.StructType(
    [
        T.StructField("query_file", T.LongType()),
        T.StructField("query_row", T.LongType()),
        T.StructField("query_id", T.LongType()),
        T.StructField("vec_file", T.LongType()),
        T.StructField("vec_row", T.LongType()),
        T.StructField("vec_id", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def rotated(vectors: np.ndarray) -> np.ndarray:
    """Rows turned at random, the same way for rows of one length; padded to a power of two, 8 at least."""
    dims = vectors.shape[1]
    width = max(8, 1 << (dims - 1).bit_length())
    out = np.zeros((len(vectors), width))
    out[:, :dims] = vectors
    rng = np.random.default_rng([_SEED, dims])
    for _ in range(3):
        out *= rng.choice([-1.0, 1.0], width)
        half = 1
        while half < width:
            pairs = out.reshape(len(out), -1, 2, half)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(out), width)
            half *= 2
        out /= np.sqrt(width)
    return out


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, norm and fit of rows none of which is zero."""
    largest = np.abs(vectors).max(axis=1)
    turned = rotated(vectors / largest[:, None])
    size = np.sqrt((turned**2).sum(axis=1))
    fit = np.abs(turned).sum(axis=1) / (size * np.sqrt(turned.shape[1]))
    with np.errstate(over="ignore"):
        return np.packbits(turned > 0, axis=1, bitorder="little"), size * largest, fit


def _encoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "vector"):
            lists = part.column("vector")
            lengths = np.array([0 if n is None else n for n in lists.value_lengths().to_pylist()])
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(float)
            starts = np.cumsum(lengths) - lengths
            for dims in np.unique(lengths[lengths > 0]).tolist():
                at = np.flatnonzero(lengths == dims)
                vectors = values[starts[at, None] + np.arange(dims)]
                counts = np.isfinite(vectors).all(axis=1) & (vectors != 0).any(axis=1)
                at, vectors = at[counts], vectors[counts]
                if not len(at):
                    continue
                code, norm, fit = encode(vectors)
                own = part.select([FILE, ROW, "id", "query"]).take(pa.array(at))
                yield batch_of(
                    {
                        **{name: own.column(name) for name in own.schema.names},
                        "dims": [dims] * len(at),
                        "vector": [v.tobytes() for v in vectors.astype("<f8")],
                        "code": [c.tobytes() for c in code],
                        "norm": norm,
                        "fit": fit,
                    },
                    _ROWS,
                )


def estimates(queries: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Inner products of rotated queries with the unit vectors along packed signs."""
    width = queries.shape[1]
    signs = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little") * 2.0 - 1.0
    found = np.zeros((len(queries), len(code)))
    for byte in range(width // 8):
        sums, at = queries[:, 8 * byte : 8 * byte + 8] @ signs.T, np.ascontiguousarray(code[:, byte])
        for row, own in zip(found, sums, strict=True):
            row += own.take(at)
    return found / np.sqrt(width)


def inner_products(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Scores of row ``a[i]`` of one side and ``b[i]`` of the other; both are stored component by component."""
    found = np.zeros(len(a))
    with np.errstate(over="ignore", invalid="ignore"):
        for begin in range(0, len(a), _PAIRS_AT_ONCE):
            these = slice(begin, begin + _PAIRS_AT_ONCE)
            for x, y in zip(left, right, strict=True):
                found[these] += x[a[these]] * y[b[these]]
    return np.where(np.isnan(found), -np.inf, found)


def search_block(
    queries: np.ndarray, vectors: np.ndarray, code: np.ndarray, norm: np.ndarray, fit: np.ndarray, own: np.ndarray, top: int, sureness: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (query, vector) measured exactly, and their scores; ``top`` of each query's best are among them.

    ``own`` has, for each query, the number of its own row among the vectors, or -1.
    """
    by_query, by_vector = np.ascontiguousarray(queries.T), np.ascontiguousarray(vectors.T)
    # A query's length changes neither order nor threshold test if both sides are in its unit.
    unit = np.abs(queries).max(axis=1)
    turned = rotated(queries / unit[:, None])
    size = np.sqrt((turned**2).sum(axis=1))
    width = turned.shape[1]
    spread = sureness * norm * np.sqrt(np.maximum(1 - fit**2, 0)) / (fit * np.sqrt(max(width - 1, 1)))
    count, first = len(vectors), FIRST_LOOKS * top
    found_a, found_b, found_s = [], [], []
    for begin in range(0, len(queries), _AT_ONCE):
        these = np.arange(begin, min(begin + _AT_ONCE, len(queries)))
        with np.errstate(over="ignore", invalid="ignore"):
            guess = estimates(turned[these], code) * (norm / fit)
            reach = (guess + spread * size[these, None]) * unit[these, None]
        guess = np.where(np.isnan(guess), np.inf, guess)
        mine = np.flatnonzero(own[these] >= 0)
        guess[mine, own[these][mine]] = -np.inf
        picked = np.ones(guess.shape, bool)
        limit = np.full(len(these), -np.inf)
        if count > first:
            best = np.argpartition(-guess, first - 1, axis=1)[:, :first]
            a, b = np.repeat(these, first), best.ravel()
            looked = inner_products(by_query, by_vector, a, b)
            looked[own[a] == b] = -np.inf
            # So many other rows reach this that a row below it is none of the best.
            limit = -np.partition(-looked.reshape(-1, first), top - 1, axis=1)[:, top - 1]
            picked = ~(reach < (limit - 1e-9 * np.abs(limit))[:, None])
            picked[np.repeat(np.arange(len(these)), first), b] = True
        picked[mine, own[these][mine]] = False
        a, b = np.nonzero(picked)
        scores = inner_products(by_query, by_vector, these[a], b)
        good = scores >= limit[a]
        found_a.append(these[a[good]])
        found_b.append(b[good])
        found_s.append(scores[good])
    return np.concatenate(found_a), np.concatenate(found_b), np.concatenate(found_s)


def _searcher(top: int, sureness: float):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_batches([batch_of({name: [] for name in _FOUND.names}, _FOUND)])
        left, right = left.combine_chunks(), right.combine_chunks()
        right = right.rename_columns([name.removeprefix(_RIGHT) for name in right.schema.names])

        def matrix(side: pa.Table, name: str, kind: str) -> np.ndarray:
            return np.frombuffer(b"".join(side.column(name).to_pylist()), kind).reshape(side.num_rows, -1)

        places = {p: i for i, p in enumerate(zip(right.column(FILE).to_pylist(), right.column(ROW).to_pylist(), strict=True))}
        own = np.array([places.get(p, -1) for p in zip(left.column(FILE).to_pylist(), left.column(ROW).to_pylist(), strict=True)])
        norm, fit = right.column("norm").to_numpy(), right.column("fit").to_numpy()
        a, b, score = search_block(
            matrix(left, "vector", "<f8"), matrix(right, "vector", "<f8"), matrix(right, "code", "u1"), norm, fit, own, top, sureness
        )
        ids = right.column("id").to_pylist()
        by_id = np.empty(len(ids), np.int64)
        by_id[sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, i))] = np.arange(len(ids))
        order = np.lexsort((by_id[b], -score, a))
        a, b, score = a[order], b[order], score[order]
        starts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, int)
        rank = np.arange(len(a)) - np.repeat(starts, np.diff(np.append(starts, len(a))))
        a, b, score = a[rank < top], b[rank < top], score[rank < top]
        q, v = left.take(pa.array(a)), right.take(pa.array(b))
        found = {"query_file": q[FILE], "query_row": q[ROW], "query_id": q["id"], "vec_file": v[FILE], "vec_row": v[ROW], "vec_id": v["id"]}
        found = {name: column.combine_chunks() for name, column in found.items()}
        return pa.Table.from_batches([batch_of(found | {"score": score}, _FOUND)])

    return run


def nearest(
    df: DataFrame,
    is_query: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    top: int = 20,
    sureness: float = SURENESS,
    scratch: Scratch | None = None,
) -> DataFrame:
    """The ``top`` nearest rows of each query row: ``query_id``, ``rank``, ``vec_id``, ``score``, and the places of both rows.

    ``is_query`` is a condition over the columns of ``df``.
    """
    scratch = scratch or Scratch(df.sparkSession, "nearest")
    asked = F.coalesce(is_query, F.lit(False)).alias("query")
    given = df.select(F.col(key).cast("long").alias("id"), asked, F.col(vector).cast("array<double>").alias("vector"))
    rows = scratch.write(scratch.placed(given).mapInArrow(_encoded, _ROWS), "codes")
    total = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if("query").alias("queries")).first()
    right_blocks = max(1, -(-total.rows // CANDIDATES_PER_BLOCK))
    left_blocks = max(1, -(-total.queries // QUERIES_PER_BLOCK))

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    place = F.xxhash64(*PLACE)
    left = rows.where("query").withColumns({"q": F.pmod(F.xxhash64(place), F.lit(left_blocks)).cast("int"), "v": every(right_blocks)})
    right = rows.withColumns({"v": F.pmod(place, F.lit(right_blocks)).cast("int"), "q": every(left_blocks)})
    left = left.drop("query", "code", "norm", "fit")
    # Both sides come from one table, so one of them needs names of its own.
    right = right.drop("query").withColumnsRenamed({name: f"{_RIGHT}{name}" for name in right.columns})
    found = (
        left.groupBy("dims", "q", "v")
        .cogroup(right.groupBy(*[f"{_RIGHT}{name}" for name in ("dims", "q", "v")]))
        .applyInArrow(_searcher(top, sureness), _FOUND)
    )
    order = Window.partitionBy("query_file", "query_row").orderBy(
        F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "vec_file", "vec_row"
    )
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
