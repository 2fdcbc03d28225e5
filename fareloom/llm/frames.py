"""Helpers the operators share: Arrow passes over a column, names that clash with nothing, tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# A batch that an Arrow function works on at once holds about this much text.
BATCH_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in pieces that hold about ``most`` bytes of one column, one row at least."""
    rows = batch.num_rows
    if not rows:
        return
    at = 0
    each = max(1, int(rows * most / max(most, batch.column(column).nbytes)))
    while at < rows:
        yield batch.slice(at, each)
        at += each


def append_column(
    df: DataFrame, source: str, name: str, kind: T.DataType, run: Callable[[pa.Array], pa.Array]
) -> DataFrame:
    """``df`` with a column that ``run`` works out from another one, batch by batch.

    A column that has that name already is replaced.
    """
    inner = df.toDF(*[f"given_{i}" for i in range(len(df.columns))])
    taken = inner.columns[df.columns.index(source)]
    rest = [own for own, column in zip(inner.columns, df.columns, strict=True) if column != name]
    schema = T.StructType([*[inner.schema[own] for own in rest], T.StructField("made", kind)])
    read = inner.select(*dict.fromkeys([*rest, taken]))

    def batches(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for piece in slices(part, taken):
                made = run(piece.column(taken))
                yield pa.RecordBatch.from_arrays([*[piece.column(own) for own in rest], made], schema.names)

    return read.mapInArrow(batches, schema).toDF(*[column for column in df.columns if column != name], name)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    return to_arrow_schema(schema)


def batch_of(columns: dict[str, object], schema: T.StructType) -> pa.RecordBatch:
    """Lists or arrays by name as a batch of the schema's types."""
    wanted = arrow_schema(schema)
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c := columns[f.name], pa.Array) and c.type == f.type else pa.array(c, f.type, from_pandas=False) for f in wanted],
        schema=wanted,
    )


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
