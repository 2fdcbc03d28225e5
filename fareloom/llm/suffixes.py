"""Repeated passages by sparse suffix arrays.

Not every suffix of the corpus is sorted, only those that begin at minimisers: places whose
hash of ``gram`` words is the smallest of ``window`` consecutive ones. The choice looks at the
words alone, so two texts that share a passage of ``gram + window - 1`` words have chosen the same
place in it. Suffixes whose first gram occurs once have no partner and go at once.

The others, with ``reach`` words to the right and to the left, are sorted by their words, in ranges
that Spark deals to tasks. A task walks its sorted suffixes in both directions and compares
neighbours; on the way it keeps, for every length of common prefix, the earliest suffix seen that
still shares as much. Each of these is compared to the left as well, and the longest match is reported if it
has ``least`` words.

A run of suffixes that share a prefix may go over the end of a range, or over many ranges when very many
texts share a passage. So each task also hands on the earliest suffix for each prefix length of its
first and its last suffix; an aggregation over these (a bounded number of rows per task) tells the
tasks' open suffixes about partners in other ranges.

The earliest suffix to the right may differ on the left where a later one, still an earlier partner, agrees. A suffix
that is hidden in this way, one that may have a hidden partner and one that is open name every
stretch of ``least`` words that could occur twice and lies in none of their matches by a digest, and an
aggregation over the digests finds where it occurs first. Each stretch belongs to one suffix, the first
of its smallest grams, and could occur twice only if some neighbour shares its part to the right. With it all
stretches of ``least`` words that occur earlier are found, and nothing else.

Earlier means a smaller id, then an earlier place. So a passage stays where it occurs first and
is reported everywhere else. Matches that overlap are merged.

Defined results: a NULL text has no words; texts of fewer than ``least`` words can repeat nothing. Rows with a
NULL id come last in the order, rows with the same id in the order of the input files. Other
columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.llm.frames import append_column, batch_of, slices
from fareloom.llm.tables import FILE, PLACE, ROW, Scratch, apart


@dataclass(frozen=True)
class Sparse:
    """Words in a hashed gram, grams in a window, words compared each way, words of a reported match."""

    gram: int = 8
    window: int = 40
    reach: int = 50
    least: int = 50

    def __post_init__(self):
        if not 0 < self.gram + self.window - 1 <= self.least <= self.reach:
            raise ValueError("a match could lie between two minimisers or beyond the reach")


#: A task holds the suffixes of its range, so there are as many ranges as it takes.
SUFFIXES_PER_RANGE = 50_000
# Sort keys per range that the driver sees when ranges are chosen. They hold words, so there should be few.
_SAMPLES = ("spark.sql.execution.rangeExchange.sampleSizePerPartition", 16)

_KEYS = (FILE, ROW, "_id")
_ID = [T.StructField(FILE, T.LongType()), T.StructField(ROW, T.LongType()), T.StructField("_id", T.LongType())]
# Words from the starts of a suffix's own stretches to it: the least and the most.
_OWN = [T.StructField("near", T.IntegerType()), T.StructField("far", T.IntegerType())]
_CHOSEN = T.StructType([*_ID, T.StructField("pos", T.IntegerType()), *_OWN, T.StructField("gram", T.LongType())])
_CONTEXT = [T.StructField("pos", T.IntegerType()), T.StructField("right", T.BinaryType()), T.StructField("left", T.BinaryType())]
_SUFFIXES = T.StructType([*_ID, *_CONTEXT, *_OWN])
_MATCH = [
    T.StructField("start", T.IntegerType()),
    T.StructField("length", T.IntegerType()),
    T.StructField("source", T.LongType()),
]
# kind 0: a match; 1: an edge, the earliest suffix with a prefix; 2: an open suffix, with its best match so far;
# 3: the digest of a stretch that no match of its suffix holds.
_WALKED = T.StructType(
    [
        T.StructField("kind", T.IntegerType()),
        T.StructField("task", T.LongType()),
        *_ID,
        *_CONTEXT,
        T.StructField("ahead", T.IntegerType()),
        T.StructField("behind", T.IntegerType()),
        *_MATCH,
        T.StructField("d1", T.LongType()),
        T.StructField("d2", T.LongType()),
    ]
)
_FOUND = T.StructType([*_ID, *_MATCH])


# Choice of suffixes


def gram_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each range, the same wherever they lie."""
    base = np.uint64(0x9E3779B97F4A7C15)
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(len(raw), base))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers)])
        back = np.cumprod(np.full(len(raw) + 1, inverse))
        value = (sums[ends] - sums[starts]) * back[starts]
        value = (value ^ value >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
        return value ^ value >> np.uint64(29)


def _sliding(values: np.ndarray, width: int, take) -> np.ndarray:
    """``take`` (min or max) of each ``width`` consecutive values, by doubling."""
    reach = 1
    while 2 * reach <= width:
        values = take(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return take(values[: len(values) - rest], values[rest:]) if rest else values


def minimisers(hashes: np.ndarray, counts: np.ndarray, window: int) -> np.ndarray:
    """Which grams are the smallest of a window of their text (of the whole text if it has fewer).

    ``hashes`` holds the grams of several texts one after the other, ``counts`` how many each has.
    """
    room = counts + window
    begins = np.cumsum(room) - room + window
    inside = np.repeat(begins - (np.cumsum(counts) - counts), counts) + np.arange(len(hashes))
    padded = np.full(int(room.sum()) + window, np.iinfo(np.uint64).max)
    padded[inside] = hashes
    smallest = _sliding(padded, window, np.minimum)
    # Windows that reach over a text's end choose nothing, but for texts with less than a window.
    first = np.zeros(len(smallest), bool)
    first[inside] = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts) <= np.repeat(np.maximum(counts - window, 0), counts)
    valid = np.where(first, smallest, 0)
    largest = _sliding(np.concatenate([np.zeros(window - 1, np.uint64), valid]), window, np.maximum)
    return largest[inside] == hashes


def owned_windows(hashes: np.ndarray, counts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """How far before each gram the windows begin whose first smallest gram it is: least and most (1 and 0 if none)."""
    near, far = np.ones(len(hashes), np.int32), np.zeros(len(hashes), np.int32)
    if len(hashes) < window:
        return near, far
    # The smallest gram moves on with the window, so the windows of a gram lie side by side.
    smallest = _sliding(np.arange(len(hashes)), window, lambda a, b: np.where(hashes[b] < hashes[a], b, a))
    ends = np.repeat(np.cumsum(counts), counts)
    begins = np.flatnonzero(np.arange(len(smallest)) + window <= ends[: len(smallest)])
    owner = smallest[begins]
    change = np.flatnonzero(np.diff(owner)) + 1
    firsts = np.concatenate([[0], change])[: len(owner)]
    lasts = np.append(change, len(owner))[: len(firsts)] - 1
    far[owner[firsts]] = owner[firsts] - begins[firsts]
    near[owner[firsts]] = owner[firsts] - begins[lasts]
    return near, far


def _chooser(sparse: Sparse):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                split = [(text or "").encode().split() for text in part.column("_text").to_pylist()]
                n = np.array([len(words) if len(words) >= sparse.least else 0 for words in split], np.int64)
                raw = b" ".join(word for words, size in zip(split, n, strict=True) if size for word in words)
                data = np.frombuffer(raw, np.uint8)
                blanks = np.flatnonzero(data == 0x20)
                starts, ends = np.concatenate([[0], blanks + 1]), np.append(blanks, len(data))
                counts = np.maximum(n - sparse.gram + 1, 0)
                own = np.repeat(np.arange(part.num_rows), counts)
                pos = np.arange(len(own)) - np.repeat(np.cumsum(counts) - counts, counts)
                word = np.repeat(np.cumsum(n) - n, counts) + pos
                hashes = gram_hashes(data, starts[word], ends[word + sparse.gram - 1])
                at = np.flatnonzero(minimisers(hashes, counts, sparse.window))
                near, far = owned_windows(hashes, counts, sparse.window)
                take = pa.array(own[at])
                yield batch_of(
                    {name: part.column(name).take(take) for name in _KEYS}
                    | {"pos": pos[at].astype(np.int32), "near": near[at], "far": far[at], "gram": hashes[at].view(np.int64)},
                    _CHOSEN,
                )

    return run


def _contexts(sparse: Sparse):
    """The words right and left of each chosen place. Each word ends in a blank; left is turned round."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                out: dict[str, list] = {name: [] for name in _SUFFIXES.names}
                columns = [part.column(name).to_pylist() for name in (*_KEYS, "_text", "places")]
                for file, row, key, text, places in zip(*columns, strict=True):
                    words = text.encode().split()
                    for place in places:
                        pos = place["pos"]
                        right = words[pos : pos + sparse.reach]
                        left = words[max(0, pos - sparse.reach) : pos]
                        out["right"].append(b" ".join(right) + b" ")
                        out["left"].append(b" ".join([b"", *left])[::-1])
                        for name, value in place.items():
                            out[name].append(value)
                    for name, value in zip(_KEYS, (file, row, key), strict=True):
                        out[name] += [value] * len(places)
                yield batch_of(out, _SUFFIXES)

    return run


@contextmanager
def few_samples(spark: SparkSession) -> Iterator[None]:
    """The sample that ranges are chosen from is small while the block runs."""
    name, value = _SAMPLES
    before = spark.conf.get(name)
    spark.conf.set(name, min(value, int(before)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


# Comparison of neighbours


def common_words(a: bytes, b: bytes) -> int:
    """Whole words that two contexts have in common from their beginning."""
    if a == b:
        return a.count(b" ")
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return a.count(b" ", 0, low)


class _Suffix:
    """A suffix with its place in the order of ids and the matches found for it, none of which holds another."""

    __slots__ = ("order", "right", "left", "near", "far", "matches", "more")

    def __init__(self, file, row, key, pos, right, left, near=1, far=0):
        self.order = (key is None, key or 0, file, row, pos)
        self.right, self.left = right, left
        self.near, self.far = near, far
        self.matches: list[tuple[int, int, int | None]] = []  # words, of them to the left, source id
        self.more = False  # whether it is hidden, or comes after a hidden one

    @property
    def best(self) -> tuple[int, int, int | None]:
        """The longest match."""
        return max(self.matches, key=lambda match: match[0], default=(0, 0, None))

    def offer(self, common: int, other: tuple, left: bytes, least: int) -> None:
        """A match of ``common`` words with a suffix of that order and left context, if it is earlier and long enough."""
        if other >= self.order:
            return
        before = common_words(self.left, left)
        if common + before < least or any(before <= own and common <= words - own for words, own, _ in self.matches):
            return
        kept = [match for match in self.matches if match[1] > before or match[0] - match[1] > common]
        self.matches = [*kept, (common + before, before, None if other[0] else other[1])]


def walk(suffixes: list[_Suffix], commons: list[int], gram: int, least: int) -> None:
    """Offers each suffix the earliest ones before it, for every length of prefix they share.

    ``commons[i]`` is what suffix i shares with the one before. The stack has one entry per
    length, shortest first: the earliest suffix, and the order of the earliest one that it hides. An entry
    that is later than one with a longer prefix is of no use. Hidden suffixes are marked, and those that come after one.
    """
    stack: list[tuple[int, _Suffix, tuple | None]] = []
    for i, suffix in enumerate(suffixes):
        if i:
            common, earliest, hidden = commons[i], suffixes[i - 1], None
            while stack and stack[-1][0] >= common:
                _, top, behind = stack.pop()
                if top.order < earliest.order:
                    top, earliest = earliest, top
                top.more = True
                hidden = min(order for order in (hidden, behind, top.order) if order is not None)
            while stack and stack[-1][1].order >= earliest.order:
                top = stack.pop()[1]
                top.more = True
                hidden = top.order if hidden is None else min(hidden, top.order)
            if common >= gram:
                stack.append((common, earliest, hidden))
            else:
                stack.clear()
        for common, earlier, hidden in stack:
            suffix.offer(common, earlier.order, earlier.left, least)
            if hidden is not None and hidden < suffix.order:
                suffix.more = True


def _edges(suffixes: list[_Suffix], commons: list[int], least: int) -> tuple[list[tuple[bytes, _Suffix]], list[int]]:
    """For each prefix of the first suffix the earliest one that has it; how far each shares the first one's."""
    shared = [suffixes[0].right.count(b" ")]
    for common in commons[1:]:
        shared.append(min(shared[-1], common))
    words = suffixes[0].right.split()
    found, earliest, at = [], suffixes[0], 0
    for length in range(len(words), least - 1, -1):
        while at < len(suffixes) and shared[at] >= length:
            earliest = min(earliest, suffixes[at], key=lambda s: s.order)
            at += 1
        found.append((b" ".join(words[:length]) + b" ", earliest))
    return found, shared


def unmatched(suffix: _Suffix, shared: int, least: int) -> list[tuple[int, bytes]]:
    """A suffix's own stretches that its matches do not hold: words before it, and digest.

    ``shared`` is the most that any other suffix can have in common with it to the right.
    """
    low, high = max(suffix.near, least - shared), min(suffix.far, suffix.left.count(b" "))
    held = [range(before + least - words, before + 1) for words, before, _ in suffix.matches]
    wanted = [k for k in range(low, high + 1) if not any(k in places for places in held)]
    if not wanted:
        return []
    text = suffix.left[::-1] + b" " + suffix.right
    blanks = np.flatnonzero(np.frombuffer(text, np.uint8) == 0x20).tolist()
    at = suffix.left.count(b" ")
    return [(k, xxhash.xxh3_128_digest(text[blanks[at - k] + 1 : blanks[at - k + least] + 1])) for k in wanted]


def _walker(sparse: Sparse):
    least = sparse.gram

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        suffixes: list[_Suffix] = []
        for batch in batches:
            suffixes += map(_Suffix, *(batch.column(name).to_pylist() for name in _SUFFIXES.names))
        if not suffixes:
            return
        commons = [0, *(common_words(a.right, b.right) for a, b in zip(suffixes, suffixes[1:], strict=False))]
        walk(suffixes, commons, least, sparse.least)
        turned, commons_turned = suffixes[::-1], [0, *commons[:0:-1]]
        walk(turned, commons_turned, least, sparse.least)
        out: dict[str, list] = {name: [] for name in _WALKED.names}

        def add(kind, suffix, match, right, left, ahead, behind):
            none, key, file, row, pos = suffix.order
            words, before, source = match
            values = (kind, task, file, row, None if none else key, pos, right, left, ahead, behind, pos - before, words, source, None, None)
            for name, value in zip(_WALKED.names, values, strict=True):
                out[name].append(value)

        first_edges, from_first = _edges(suffixes, commons, least)
        last_edges, from_last = _edges(turned, commons_turned, least)
        for prefix, suffix in {**dict(first_edges), **dict(last_edges)}.items():
            add(1, suffix, suffix.best, prefix, suffix.left, None, None)
        for suffix, ahead, behind, *beside in zip(suffixes, from_first, reversed(from_last), commons, [*commons[1:], 0], strict=True):
            best, opened = suffix.best, ahead >= least or behind >= least
            for match in suffix.matches:
                if not opened or match is not best:
                    add(0, suffix, match, None, None, None, None)
            if opened:
                add(2, suffix, best, suffix.right, suffix.left, ahead, behind)
            elif not suffix.more:
                continue
            none, key, file, row, pos = suffix.order
            for before, digest in unmatched(suffix, max(ahead, behind, *beside), sparse.least):
                d1, d2 = np.frombuffer(digest, "<i8").tolist()
                values = (3, task, file, row, None if none else key, pos, None, None, None, None, pos - before, sparse.least, None, d1, d2)
                for name, value in zip(_WALKED.names, values, strict=True):
                    out[name].append(value)
            if len(out["kind"]) >= 10_000:
                yield batch_of(out, _WALKED)
                out.update({name: [] for name in out})
        yield batch_of(out, _WALKED)

    return run


def _closer(sparse: Sparse):
    """A task's matches: its open suffixes are offered the earliest ones that all tasks have for its edges."""

    def run(handed: pa.Table, edges: pa.Table) -> pa.Table:
        out: dict[str, list] = {name: [] for name in _FOUND.names}
        closed = handed.filter(pc.equal(handed["kind"], 0)).select(_FOUND.names)
        opened = handed.filter(pc.equal(handed["kind"], 2))
        longest: dict[tuple, tuple[bytes, bytes]] = {}
        for edge in edges.to_pylist():
            first, prefix = edge["first"], edge["prefix"]
            order = (first["none"], first["_id"] or 0, first[FILE], first[ROW], first["pos"])
            if order not in longest or len(prefix) > len(longest[order][0]):
                longest[order] = (prefix, first["left"])
        for batch in opened.to_batches(max_chunksize=10_000):
            for row in batch.to_pylist():
                suffix = _Suffix(row[FILE], row[ROW], row["_id"], row["pos"], row["right"], row["left"])
                own = (row["length"], row["pos"] - row["start"], row["source"])
                for order, (prefix, left) in longest.items():
                    common = common_words(suffix.right, prefix)
                    if common >= sparse.gram:
                        suffix.offer(common, order, left, sparse.least)
                # The task's own match holds stretches that have no digest, so it counts beside longer ones.
                for words, before, source in {*suffix.matches, own}:
                    if words >= sparse.least:
                        values = (row[FILE], row[ROW], row["_id"], row["pos"] - before, words, source)
                        for name, value in zip(_FOUND.names, values, strict=True):
                            out[name].append(value)
        found = pa.Table.from_batches([batch_of(out, _FOUND)])
        return pa.concat_tables([closed.cast(found.schema), found])

    return run


def _later_stretches(walked: DataFrame, scratch: Scratch) -> DataFrame:
    """The stretches without a match that occur at an earlier place, with the id of the first one."""
    stretches = walked.where("kind = 3").select(*_KEYS, "start", "length", "d1", "d2")
    # Half a digest and a count tell which occur twice, before anything else moves.
    common = stretches.groupBy("d1").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("d1")
    shared = scratch.write(stretches.join(scratch.write(common, "common_stretches"), "d1", "left_semi"), "stretches")
    at = F.struct(F.col("_id").isNull().alias("none"), "_id", *PLACE, "start")
    firsts = shared.groupBy("d1", "d2").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    joined = shared.join(scratch.write(firsts.drop("n"), "first_stretches"), ["d1", "d2"])
    here = [F.col(f"first.{name}") == F.col(name) for name in (*PLACE, "start")]
    later = joined.where(~(here[0] & here[1] & here[2]))
    return later.select(*_KEYS, "start", "length", F.col("first._id").alias("source"))


def repeated_passages(
    df: DataFrame, key: str = "doc_id", text: str = "text", sparse: Sparse = Sparse(), scratch: Scratch | None = None
) -> DataFrame:
    """A row per repeated passage: place, ``doc_id``, ``start`` and ``length`` in words, ``source_ids``."""
    spark = df.sparkSession
    scratch = scratch or Scratch(spark, "suffixes")
    texts = scratch.texts(df, key, text)
    chosen = scratch.write(texts.mapInArrow(_chooser(sparse), _CHOSEN), "chosen")
    common = scratch.write(chosen.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram"), "common")
    paired = chosen.join(common, "gram", "left_semi").groupBy(*PLACE).agg(F.sort_array(F.collect_list(F.struct("pos", "near", "far"))).alias("places"))
    paired = scratch.write(paired, "paired")
    # The places grow with the corpus, so they are shuffled like the texts, whatever their size here.
    suffixes = scratch.write(texts.join(paired.hint("merge"), list(PLACE)).mapInArrow(_contexts(sparse), _SUFFIXES), "suffixes")
    scratch.drop(chosen, common, paired)
    order = ["right", F.col("_id").asc_nulls_last(), FILE, ROW, "pos"]
    ranges = max(1, -(-suffixes.count() // SUFFIXES_PER_RANGE))
    dealt = suffixes.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    with few_samples(spark):
        walked = scratch.write(dealt.mapInArrow(_walker(sparse), _WALKED), "walked")
    scratch.drop(suffixes)
    edges = walked.where("kind = 1").withColumn("prefix", F.col("right"))
    first = F.struct(F.col("_id").isNull().alias("none"), "_id", *PLACE, "pos", "left")
    prefixes = edges.groupBy("prefix").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("tasks")).where("tasks > 1")
    told = edges.select("task", "prefix").join(scratch.write(prefixes, "prefixes"), "prefix")
    told = scratch.write(told, "told")
    handed = walked.where("kind IN (0, 2)").groupBy("task")
    closed = handed.cogroup(told.groupBy("task")).applyInArrow(_closer(sparse), _FOUND)
    found = scratch.write(closed, "found").unionByName(scratch.write(_later_stretches(walked, scratch), "later"))
    # Overlapping matches of a text become one passage.
    ordered = Window.partitionBy(*PLACE).orderBy("start", "length", "source")
    reached = F.max(F.col("start") + F.col("length")).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    marked = found.withColumn("begins", F.coalesce(F.col("start") > reached, F.lit(True)).cast("int"))
    runs = marked.withColumn("run", F.sum("begins").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*PLACE, "run").agg(
        F.first("_id").alias("doc_id"),
        F.min("start").alias("start"),
        (F.max(F.col("start") + F.col("length")) - F.min("start")).alias("length"),
        F.sort_array(F.collect_set("source")).alias("source_ids"),
    ).drop("run")


def without_passages(
    df: DataFrame, key: str = "doc_id", text: str = "text", sparse: Sparse = Sparse()
) -> DataFrame:
    """``df`` with the repeated passages cut from its text column, white space around them included."""
    scratch = Scratch(df.sparkSession, "suffixes")
    inner, names = apart(df)
    placed, body = scratch.placed(inner), names[text]
    cuts = repeated_passages(placed, names[key], body, sparse, scratch).groupBy(*PLACE)
    cuts = scratch.write(cuts.agg(F.collect_list(F.struct("start", "length")).alias("_cuts")), "cuts")
    joined = placed.join(cuts, list(PLACE), "left").withColumn("_both", F.struct(F.col(body).cast("string").alias("t"), F.col("_cuts").alias("c")))

    def run(both: pa.Array) -> pa.Array:
        return pa.array([cut_words(x["t"], x["c"]) for x in both.to_pylist()], pa.string())

    done = append_column(joined.select("*"), "_both", "_done", T.StringType(), run)
    return done.select(*["_done" if c == body else c for c in inner.columns]).toDF(*df.columns)


def cut_words(text: str | None, cuts: list[dict] | None) -> str | None:
    """A text without some stretches of its words."""
    if text is None or not cuts:
        return text
    raw = np.frombuffer(text.encode(), np.uint8)
    blank = np.isin(raw, np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8))
    starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    stops = np.append(starts, len(raw))
    kept, at = [], 0
    for cut in sorted(cuts, key=lambda c: c["start"]):
        kept.append(raw[at : stops[cut["start"]]].tobytes())
        at = stops[cut["start"] + cut["length"]]
    return b"".join([*kept, raw[at:].tobytes()]).decode()
