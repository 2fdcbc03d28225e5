"""SimHash near-duplicates: fingerprints of word shingles, linked by Hamming distance.

Fingerprints are cut into blocks, so many that two within the distance agree in some choice of
``SHARED_BLOCKS`` of them (pigeonhole). Every distinct fingerprint goes to one bucket per
choice; fingerprints that meet in a bucket are verified by their distance. A bucket can hold
no more fingerprints than its free bits tell apart, and a full one is not searched pair by
pair: the fingerprints at the allowed distances are looked up in the sorted bucket, so the
work grows with the bucket and not with its square. A bucket hands on what links its members
to the smallest of their cluster, and the clusters of all buckets are put together as
connected components.

Equal fingerprints are one row from the start, so copies, however many, are never paired.

Defined results: a NULL text counts as empty; a text of fewer words than a shingle has is one
shingle, one without words has the fingerprint zero. A component's id is the smallest id in it;
NULL ids come last. Every row of the input comes back once, repeated rows included.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.llm.components import components
from fareloom.llm.frames import append_column, batch_of, text_or_empty
from fareloom.llm.tables import FILE, PLACE, ROW, Scratch, apart

SHINGLE_WORDS = 3
MOST_BITS = 2
SEED = 42
#: Blocks two fingerprints must share; there are this many and ``most_bits`` more.
SHARED_BLOCKS = 3
# A bucket up to this size is compared pair by pair, a larger one by look-up; the links are the same.
PAIRED = 32

_BYTE_LANES = np.uint64(0x0101010101010101)
_LANE_ROWS = 255
_LINKS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def fingerprints(texts: list[str | None], shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """The SimHash of each text: a bit is set if it is set in over half the shingles' hashes."""
    hashes: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    digest = xxhash.xxh64_intdigest
    for i, text in enumerate(texts):
        words = (text or "").encode().lower().split()
        if not words:
            continue
        joined = b" ".join(words)
        if len(words) <= shingle_words:
            hashes.append(digest(joined, SEED))
            counts[i] = 1
            continue
        ends = np.cumsum([len(word) + 1 for word in words])
        starts = (ends[: 1 - shingle_words] - [len(word) + 1 for word in words[: 1 - shingle_words]]).tolist() if shingle_words > 1 else [0, *ends[:-1].tolist()]
        ends = (ends[shingle_words - 1 :] - 1).tolist()
        hashes += [digest(joined[a:b], SEED) for a, b in zip(starts, ends, strict=True)]
        counts[i] = len(starts)
    values = np.array(hashes, np.uint64)
    found = np.zeros(len(texts), np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return found
    # Bits are summed eight at a time in the bytes of one number, over rows a byte can count.
    parts = -(-counts[some] // _LANE_ROWS)
    begins = np.cumsum(counts[some]) - counts[some]
    first_part = np.cumsum(parts) - parts
    at = np.repeat(begins, parts) + (np.arange(parts.sum()) - np.repeat(first_part, parts)) * _LANE_ROWS
    for bit in range(8):
        lanes = np.add.reduceat(values >> np.uint64(bit) & _BYTE_LANES, at)
        sums = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8), first_part, axis=0, dtype=np.int64)
        for byte in range(8):
            over = 2 * sums[:, byte] > counts[some]
            found[some] |= over.astype(np.uint64) << np.uint64(8 * byte + bit)
    return found


def with_fingerprint(df: DataFrame, text: str = "text", name: str = "fingerprint", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``df`` with the SimHash of a text column as a long (the 64 bits as a signed number)."""

    def run(texts: pa.Array) -> pa.Array:
        return pa.array(fingerprints(texts.to_pylist(), shingle_words).view(np.int64))

    return append_column(df, text, name, T.LongType(), run)


def block_masks(most_bits: int) -> list[int]:
    """For each choice of blocks the bits they hold."""
    blocks = SHARED_BLOCKS + most_bits
    edges = [64 * i // blocks for i in range(blocks + 1)]
    bits = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(choice) for choice in combinations(bits, SHARED_BLOCKS)]


def _flips(free: int, most_bits: int) -> np.ndarray:
    """All patterns of up to so many of the free bits."""
    bits = [1 << i for i in range(64) if free >> i & 1]
    return np.array([sum(some) for n in range(1, most_bits + 1) for some in combinations(bits, n)], np.uint64)


def _clusters(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that links (a, b) lead to, for each of n indices."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while not np.array_equal(root, root[root]):
            root = root[root]
        if np.array_equal(before, root):
            break
    return root


def linked_in_buckets(bucket: np.ndarray, prints: np.ndarray, free: np.ndarray, most_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Members of buckets and the smallest fingerprint of their cluster in it, where that is another one.

    Rows of one bucket number follow each other in ascending order of the fingerprints.
    ``free`` has, for each row, the bits its bucket leaves open.
    """
    starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    sizes = np.diff(np.append(starts, len(bucket)))
    size_of = np.repeat(sizes, sizes)
    left, right = [], []
    small = size_of <= PAIRED
    for gap in range(1, int(min(PAIRED, sizes.max()))):
        at = np.flatnonzero(small[:-gap] & (bucket[:-gap] == bucket[gap:]))
        at = at[np.bitwise_count(prints[at] ^ prints[at + gap]) <= most_bits]
        left.append(at)
        right.append(at + gap)
    for start, size in zip(starts[sizes > PAIRED].tolist(), sizes[sizes > PAIRED].tolist(), strict=True):
        members = prints[start : start + size]
        for flip in _flips(int(free[start]), most_bits):
            wanted = members ^ flip
            at = np.minimum(np.searchsorted(members, wanted), size - 1)
            hit = np.flatnonzero((members[at] == wanted) & (wanted > members))
            left.append(start + hit)
            right.append(start + at[hit])
    if not left:
        return prints[:0], prints[:0]
    root = _clusters(len(prints), np.concatenate(left), np.concatenate(right))
    others = np.flatnonzero(root != np.arange(len(root)))
    return prints[others], prints[root[others]]


def _linker(masks: list[int], most_bits: int):
    free_bits = np.array([~mask & (1 << 64) - 1 for mask in masks], np.uint64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def links(choice: np.ndarray, key: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
            change = (choice[1:] != choice[:-1]) | (key[1:] != key[:-1])
            bucket = np.concatenate([[0], np.cumsum(change)])
            unsigned = prints.view(np.uint64)
            order = np.lexsort((unsigned, bucket))
            a, b = linked_in_buckets(bucket[order], unsigned[order], free_bits[choice[order]], most_bits)
            return batch_of({"a": a.view(np.int64), "b": b.view(np.int64)}, _LINKS)

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = tuple(batch.column(c).to_numpy() for c in ("choice", "key", "print"))
            # The last bucket may go on in the next batch.
            other = (rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1])
            cut = int(other.nonzero()[0][-1]) + 1 if other.any() else 0
            if not cut and held and (held[-1][0][-1], held[-1][1][-1]) != (rows[0][0], rows[1][0]):
                yield links(*map(np.concatenate, zip(*held, strict=True)))
                held = []
            if cut:
                yield links(*map(np.concatenate, zip(*held, tuple(c[:cut] for c in rows), strict=True)))
                held = []
            held.append(tuple(c[cut:] for c in rows))
        if held:
            yield links(*map(np.concatenate, zip(*held, strict=True)))

    return run


def links_within(prints: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """Links (``a``, ``b``) whose components are those of all pairs within the distance.

    ``prints`` has one column ``print`` of distinct longs.
    """
    masks = block_masks(most_bits)
    signed = [mask - (1 << 64) if mask >> 63 else mask for mask in masks]
    keys = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("print").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed)])
    buckets = prints.select("print", F.explode(keys).alias("k")).select("k.choice", "k.key", "print")
    dealt = buckets.repartition("choice", "key").sortWithinPartitions("choice", "key")
    return dealt.mapInArrow(_linker(masks, most_bits), _LINKS)


def near_duplicates(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    most_bits: int = MOST_BITS,
    scratch: Scratch | None = None,
) -> DataFrame:
    """A row per row of ``df``: place, ``doc_id``, ``print`` (long), ``component_id``, ``kept``.

    ``kept`` marks one row of each component, the one with the smallest id.
    """
    scratch = scratch or Scratch(df.sparkSession, "simhash")
    narrow = scratch.texts(df, key, text).withColumn("_text", text_or_empty("_text"))
    rows = scratch.write(with_fingerprint(narrow, "_text", "print", shingle_words).drop("_text"), "prints")
    first = F.min(F.struct(F.col("_id").isNull().alias("_none"), "_id", *PLACE)).alias("_first")
    prints = scratch.write(rows.groupBy("print").agg(first, F.count(F.lit(1)).alias("_rows")), "distinct")
    roots = components(links_within(prints.select("print"), most_bits), scratch)
    known = prints.join(roots.withColumnRenamed("node", "print"), "print", "left")
    rooted = scratch.write(known.withColumn("root", F.coalesce("root", "print")), "rooted")
    heads = rooted.groupBy("root").agg(F.min("_first").alias("_first"), F.sum("_rows").alias("_rows")).where(F.col("_rows") > 1)
    heads = scratch.write(heads.select("root", "_first"), "heads")
    members = scratch.write(rooted.select("print", "root").join(heads, "root").select("print", "_first"), "members")
    joined = rows.join(members, "print", "left")
    alone = F.col("_first").isNull()
    same = (F.col(f"_first.{FILE}") == F.col(FILE)) & (F.col(f"_first.{ROW}") == F.col(ROW))
    return joined.select(
        *PLACE,
        F.col("_id").alias("doc_id"),
        "print",
        F.when(alone, F.col("_id")).otherwise(F.col("_first._id")).alias("component_id"),
        (alone | same).alias("kept"),
    )


def without_near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS, most_bits: int = MOST_BITS
) -> DataFrame:
    """``df`` with one row of each component. All columns are kept."""
    scratch = Scratch(df.sparkSession, "simhash")
    inner, names = apart(df)
    placed = scratch.placed(inner)
    dropped = near_duplicates(placed, names[key], names[text], shingle_words, most_bits, scratch).where(~F.col("kept"))
    # The list grows with the corpus, so it is shuffled like the rows, whatever its size here.
    dropped = scratch.write(dropped.select(*PLACE), "dropped").hint("merge")
    return placed.join(dropped, list(PLACE), "left_anti").drop(*PLACE).toDF(*df.columns)
