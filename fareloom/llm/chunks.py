"""Substring dedup over content-defined chunks.

A gear hash rolls over the bytes of a text: each byte's number is added to the hash shifted by
one bit, so the hash depends on as many bytes as it has bits. A chunk ends where the hash is higher
than at each of the ``reach`` bytes before and no lower than at each of the ``reach`` bytes after, which
is a property of the bytes around alone: no end depends on the one before, so that in two copies of
a passage the same places are ends but for ``GEAR_BITS + reach`` bytes at its front and ``reach`` at its back,
whatever stands around it. Chunks are thus longer than ``reach``, have a most size and end between
characters. They are compared by their 128-bit digests; the first occurrence of a chunk, in the
order of ids and places, is its source, every other one a repeat of it.

A stretch of chunks in a row that are all repeats is cut from the text if it is at least
``least_run`` bytes long. Shorter ones stay: two or three words that texts share by chance are no
copied passage. The source of every cut chunk is left in the corpus, since a first occurrence
is never cut.

First occurrences come from an aggregation (partial before its shuffle); the join that looks them
up is one of two tables, so that adaptive execution can split a passage that very many texts share.

Defined results: a NULL text stays NULL and has no chunks, an empty one is left as it is. Rows with
a NULL id come last in the order, rows with the same id in the order of the input files. Rows
are neither dropped nor merged, all columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.llm.frames import batch_of, slices
from fareloom.llm.tables import FILE, PLACE, ROW, Scratch, apart

GEAR_BITS = 16


@dataclass(frozen=True)
class Chunking:
    """Sizes in bytes: of chunks, and of the shortest stretch of repeated ones that is cut."""

    #: How far around it a chunk's end has the highest hash. Chunks have twice as many bytes and a few on average.
    reach: int = 16
    most: int = 256
    least_run: int = 96

    def __post_init__(self):
        if not 0 < self.reach < self.most or self.most < 4:
            raise ValueError("chunks need a reach, and a most size that is larger and holds a character")


CHUNKS = T.StructType(
    [
        T.StructField(FILE, T.LongType()),
        T.StructField(ROW, T.LongType()),
        T.StructField("_id", T.LongType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("length", T.IntegerType()),
        T.StructField("d1", T.LongType()),
        T.StructField("d2", T.LongType()),
    ]
)


def gear_numbers() -> np.ndarray:
    """A number per byte value: the upper bits of the multiples of an odd constant, well mixed."""
    mixed = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ mixed >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ mixed >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return (mixed >> np.uint64(64 - GEAR_BITS)).astype(np.uint16)


def rolling_gear(raw: np.ndarray) -> np.ndarray:
    """The gear hash that ends at each byte, for all bytes at once.

    The sum over the last 2n bytes is the sum over the last n and, shifted, over the n before.
    """
    value = gear_numbers()[raw]
    reach = 1
    while reach < GEAR_BITS:
        longer = value.copy()
        longer[reach:] += value[:-reach] << np.uint16(reach)
        value, reach = longer, 2 * reach
    return value


def _highest(value: np.ndarray, n: int) -> np.ndarray:
    """The highest of the last n numbers up to each place."""
    high, reach = value, 1
    while reach < n:
        step = min(reach, n - reach)
        longer = high.copy()
        np.maximum(high[step:], high[:-step], out=longer[step:])
        high, reach = longer, reach + step
    return high


def chunk_ends(texts: list[bytes], chunking: Chunking) -> list[list[int]]:
    """Where the chunks of each text end. Texts don't influence each other."""
    reach, gap = chunking.reach, bytes(chunking.reach)
    raw = np.frombuffer(b"".join([gap, gap.join(texts), gap]), np.uint8)
    value = rolling_gear(raw)
    starts, at = [], reach
    for text in texts:
        # Between texts, and until all bytes of a hash are the text's own, nothing can be highest.
        value[at - reach : at + GEAR_BITS - 1] = 0
        starts.append(at)
        at += len(text) + reach
    value[-reach:] = 0
    goes_on = raw & 0xC0 == 0x80
    value[:-1][goes_on[1:]] = 0
    high = _highest(value, reach)
    middle = value[reach:-reach]
    ends = np.flatnonzero((middle > high[reach - 1 : -reach - 1]) & (middle >= high[2 * reach :])) + reach + 1
    upto = np.searchsorted(ends, starts, "right").tolist() + [len(ends)]
    ends, found = ends.tolist(), []
    for i, (text, begin) in enumerate(zip(texts, starts, strict=True)):
        start, cuts = begin, []
        for end in [*ends[upto[i] : upto[i + 1]], begin + len(text)]:
            while end - start > chunking.most:
                start += chunking.most
                while goes_on[start]:
                    start -= 1
                cuts.append(start - begin)
            if end > start:
                cuts.append(end - begin)
                start = end
        found.append(cuts)
    return found


def _chunker(chunking: Chunking):
    digest = xxhash.xxh3_128_digest

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                texts = [(text or "").encode() for text in part.column("_text").to_pylist()]
                ends = chunk_ends(texts, chunking)
                counts = np.array([len(cuts) for cuts in ends], np.int64)
                stops = np.array([cut for cuts in ends for cut in cuts], np.int32)
                starts = np.concatenate([[0], stops[:-1]]).astype(np.int32) if len(stops) else stops
                some = counts > 0
                starts[(np.cumsum(counts) - counts)[some]] = 0
                digests = b"".join(
                    digest(text[a:b]) for text, cuts in zip(texts, ends, strict=True) for a, b in zip([0, *cuts], cuts, strict=False)
                )
                halves = np.frombuffer(digests, "<i8").reshape(-1, 2)
                take = pa.array(np.repeat(np.arange(part.num_rows), counts))
                yield batch_of(
                    {name: part.column(name).take(take) for name in (FILE, ROW, "_id")}
                    | {"start": starts, "length": stops - starts, "d1": halves[:, 0].copy(), "d2": halves[:, 1].copy()},
                    CHUNKS,
                )

    return run


def repeated_spans(
    df: DataFrame, key: str = "doc_id", text: str = "text", chunking: Chunking = Chunking(), scratch: Scratch | None = None
) -> DataFrame:
    """A row per stretch to cut: place, ``doc_id``, ``start`` and ``length`` in bytes, ``source_ids``.

    ``source_ids`` lists the ids of the rows that hold the first occurrences of its chunks.
    """
    scratch = scratch or Scratch(df.sparkSession, "chunks")
    chunks = scratch.write(scratch.texts(df, key, text).mapInArrow(_chunker(chunking), CHUNKS), "chunks")
    # Most chunks occur once. Half a digest and a count tell which, before anything else moves.
    common = scratch.write(chunks.groupBy("d1").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("d1"), "common")
    shared = scratch.write(chunks.join(common, "d1", "left_semi"), "shared")
    scratch.drop(chunks, common)
    at = F.struct(F.col("_id").isNull().alias("none"), F.col("_id"), *PLACE, F.col("start"))
    firsts = shared.groupBy("d1", "d2").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = scratch.write(firsts.select("d1", "d2", "first"), "firsts")
    here = [F.col(f"first.{name}") == F.col(name) for name in (FILE, ROW, "start")]
    later = shared.join(firsts, ["d1", "d2"]).where(~(here[0] & here[1] & here[2]))
    repeats = later.select(*PLACE, "_id", "start", "length", F.col("first._id").alias("source"))
    # A document's repeats in order; a stretch ends where the next one does not follow at once.
    ordered = Window.partitionBy(*PLACE).orderBy("start")
    begins = F.coalesce(F.lag(F.col("start") + F.col("length")).over(ordered) != F.col("start"), F.lit(True))
    numbered = repeats.withColumn("begins", begins.cast("int")).withColumn("run", F.sum("begins").over(ordered))
    spans = numbered.groupBy(*PLACE, "run").agg(
        F.first("_id").alias("doc_id"),
        F.min("start").alias("start"),
        F.sum("length").cast("int").alias("length"),
        F.sort_array(F.collect_set("source")).alias("source_ids"),
    )
    return scratch.write(spans.where(F.col("length") >= chunking.least_run).drop("run"), "spans")


def _cut(texts: pa.Array, starts: pa.Array, lengths: pa.Array) -> pa.Array:
    out = []
    for text, begin, size in zip(texts.to_pylist(), starts.to_pylist(), lengths.to_pylist(), strict=True):
        if not begin or text is None:
            out.append(text)
            continue
        raw, at, kept = text.encode(), 0, []
        for a, n in sorted(zip(begin, size, strict=True)):
            kept.append(raw[at:a])
            at = a + n
        out.append(b"".join([*kept, raw[at:]]).decode())
    return pa.array(out, pa.string())


def without_repeats(
    df: DataFrame, key: str = "doc_id", text: str = "text", chunking: Chunking = Chunking()
) -> DataFrame:
    """``df`` with the repeated stretches cut from its text column."""
    scratch = Scratch(df.sparkSession, "chunks")
    inner, names = apart(df)
    placed, body = scratch.placed(inner), names[text]
    spans = repeated_spans(placed, names[key], body, chunking, scratch)
    cuts = spans.groupBy(*PLACE).agg(F.collect_list("start").alias("_starts"), F.collect_list("length").alias("_lengths"))
    # The cuts grow with the corpus, so they are shuffled like the rows, whatever their size here.
    joined = placed.join(scratch.write(cuts, "cuts").hint("merge"), list(PLACE), "left").drop(*PLACE)
    joined = joined.withColumn(body, F.col(body).cast("string"))
    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name == body else f.dataType) for f in inner.schema])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, body):
                done = _cut(part.column(body), part.column("_starts"), part.column("_lengths"))
                columns = [done if name == body else part.column(name) for name in schema.names]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return joined.mapInArrow(run, schema).toDF(*df.columns)
