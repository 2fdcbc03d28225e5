"""Exact duplicates by block naming.

The normalised bytes of a text are cut into blocks of a fixed size. All blocks are sorted, and
equal ones get the same whole number as their name; a text is then a row of names. Adjacent
names are paired and the pairs named in the same way, again and again, until every text has
one name. Names stand for the bytes themselves, so two texts have the same name (of the same
round) if and only if they are equal: digests take no part in the comparison.

The sort is by a fingerprint of the block, then by the block, and rows are dealt to sorted
ranges by fingerprint and place, so that a block that very many rows share is spread over many
tasks. Only a task's first and last fingerprint can occur in other tasks: the blocks of those
two are compared again, which is a handful of rows per task.

Defined results: a NULL text counts as empty, empty texts are equal to each other. Equality
ignores the case of A-Z only. Of equal texts the row with the largest id stays (NULL is the
smallest; among equal ids, the last in the input files). Every row comes back once, repeated
rows included; other columns, whatever their names, play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.llm.frames import batch_of, slices, text_or_empty
from fareloom.llm.tables import FILE, PLACE, ROW, Scratch, apart

BLOCK_BYTES = 2048
_POSITION_BITS = 33
_NO_NAME = -1
_HASH, _NAME, _POS, _N = "_hash", "_name", "_pos", "_n"
_ID, _SHA = "_id", "_sha"

_BLOCKS = T.StructType(
    [
        T.StructField(FILE, T.LongType()),
        T.StructField(ROW, T.LongType()),
        T.StructField(_ID, T.LongType()),
        T.StructField(_SHA, T.BinaryType()),
        T.StructField(_N, T.LongType()),
        T.StructField(_POS, T.LongType()),
        T.StructField("_block", T.BinaryType()),
    ]
)


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per block; the first one carries the text's digest."""
    for batch in batches:
        for part in slices(batch, "_text"):
            out: dict[str, list] = {name: [] for name in _BLOCKS.names}
            for file, row, key, text in zip(*(part.column(c).to_pylist() for c in (FILE, ROW, _ID, "_text")), strict=True):
                raw = text.encode().lower()
                cuts = range(0, max(1, len(raw)), BLOCK_BYTES)
                out[FILE] += [file] * len(cuts)
                out[ROW] += [row] * len(cuts)
                out[_ID] += [key] * len(cuts)
                out[_SHA] += [hashlib.sha256(raw).digest(), *[None] * (len(cuts) - 1)]
                out[_N] += [len(cuts)] * len(cuts)
                out[_POS] += range(len(cuts))
                out["_block"] += [raw[at : at + BLOCK_BYTES] for at in cuts]
            yield batch_of(out, _BLOCKS)


def _namer(key: Sequence[str], schema: T.StructType):
    """Names for the rows of a sorted task; its edge blocks follow as rows without a place."""
    rest = [name for name in schema.names if name not in (*key, _NAME)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_name = TaskContext.get().partitionId() << _POSITION_BITS
        last: list | None = None
        first_hash = last_hash = None
        first_edge: dict[int, list] = {}
        last_edge: dict[int, list] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            hashes = batch.column(_HASH).to_numpy()
            columns = [batch.column(name) for name in key]
            new = np.empty(batch.num_rows, bool)
            new[0] = [hashes[0], *[c[0].as_py() for c in columns]] != last
            new[1:] = hashes[1:] != hashes[:-1]
            for c in columns:
                new[1:] |= pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False)
            names = next_name - 1 + np.cumsum(new)
            if first_hash is None:
                first_hash = hashes[0]
            begun = np.flatnonzero(new)
            for at in begun[hashes[begun] == first_hash]:
                first_edge[int(names[at])] = [c[at].as_py() for c in columns]
            if hashes[-1] != last_hash:
                last_hash, last_edge = hashes[-1], {}
            for at in begun[hashes[begun] == last_hash]:
                last_edge[int(names[at])] = [c[at].as_py() for c in columns]
            last = [hashes[-1], *[c[-1].as_py() for c in columns]]
            next_name = int(names[-1]) + 1
            none = {name: [None] * batch.num_rows for name in key}
            yield batch_of({name: batch.column(name) for name in rest} | none | {_NAME: names}, schema)
        edges = first_edge | last_edge
        if edges:
            none = {name: [None] * len(edges) for name in rest}
            blocks = {name: [block[i] for block in edges.values()] for i, name in enumerate(key)}
            yield batch_of(none | blocks | {_NAME: list(edges)}, schema)

    return run


def _named(rows: DataFrame, key: Sequence[str], scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``rows`` with equal names for equal ``key`` columns, which go; and the table behind them."""
    hashed = rows.withColumn(_HASH, F.xxhash64(*key))
    order = [F.col(name) for name in (*PLACE, _POS)]
    ordered = hashed.repartitionByRange(_HASH, *order).sortWithinPartitions(_HASH, *key, *order)
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in rows.schema], T.StructField(_NAME, T.LongType())])
    table = scratch.write(ordered.mapInArrow(_namer(key, schema), schema), "names")
    edges = table.where(F.col(ROW).isNull())
    one = edges.groupBy(*key).agg(F.min(_NAME).alias("_one"))
    moved = edges.join(one, list(key)).where(F.col(_NAME) != F.col("_one")).select(_NAME, "_one")
    named = table.where(F.col(ROW).isNotNull()).drop(*key).join(moved, _NAME, "left")
    return named.withColumn(_NAME, F.coalesce("_one", _NAME)).drop("_one"), table


def name_texts(df: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per text: its place, id, digest and name. Texts of one round and name are equal."""
    narrow = scratch.texts(df, key, text).withColumn("_text", text_or_empty("_text"))
    rows, table = _named(narrow.mapInArrow(_cut, _BLOCKS), ["_block"], scratch)
    kept = [*PLACE, _ID, _SHA]
    found = []
    for level in range(64):
        found.append(rows.where(F.col(_N) == 1).select(*kept, F.lit(level).alias("_round"), _NAME))
        longest = table.agg(F.max(_N)).first()[0] or 1
        if longest == 1:
            break
        pairs = (
            rows.where(F.col(_N) > 1)
            .groupBy(*PLACE, F.shiftright(_POS, 1).alias(_POS))
            .agg(
                F.max(_ID).alias(_ID),
                F.max(_SHA).alias(_SHA),
                F.max(F.shiftright(F.col(_N) + 1, 1)).alias(_N),
                F.max(F.when(F.col(_POS) % 2 == 0, F.col(_NAME))).alias("_left"),
                F.coalesce(F.max(F.when(F.col(_POS) % 2 == 1, F.col(_NAME))), F.lit(_NO_NAME)).alias("_right"),
            )
        )
        rows, table = _named(pairs, ["_left", "_right"], scratch)
    named = found[0]
    for more in found[1:]:
        named = named.unionAll(more)
    return scratch.write(named, "texts")


def exact_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", scratch: Scratch | None = None
) -> DataFrame:
    """A row per row of ``df``: place, ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    scratch = scratch or Scratch(df.sparkSession, "exact")
    texts = name_texts(df, scratch, key, text)
    groups = (
        texts.groupBy("_round", _NAME)
        .agg(F.max(F.struct(_ID, *PLACE)).alias("_keep"), F.count(F.lit(1)).alias("_size"))
        .where(F.col("_size") > 1)
    )
    # Both sides are tables, so that adaptive execution can split the rows of a large group.
    joined = texts.join(scratch.write(groups, "groups"), ["_round", _NAME], "left")
    alone = F.col("_size").isNull()
    same = (F.col(f"_keep.{FILE}") == F.col(FILE)) & (F.col(f"_keep.{ROW}") == F.col(ROW))
    return joined.select(
        *PLACE,
        F.col(_ID).alias("doc_id"),
        F.when(alone, F.col(_ID)).otherwise(F.col(f"_keep.{_ID}")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | same).alias("kept"),
        F.lower(F.hex(_SHA)).alias("text_sha256"),
    )


def without_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` without the rows that are equal to a row that stays. All columns are kept."""
    scratch = Scratch(df.sparkSession, "exact")
    inner, names = apart(df)
    placed = scratch.placed(inner)
    dropped = exact_duplicates(placed, names[key], names[text], scratch).where(~F.col("kept"))
    # The list grows with the corpus, so it is shuffled like the rows, whatever its size here.
    dropped = scratch.write(dropped.select(*PLACE), "dropped").hint("merge")
    return placed.join(dropped, list(PLACE), "left_anti").drop(*PLACE).toDF(*df.columns)
