"""Spelling variants: words at an edit distance of one, found through grams of variable length.

* **Dictionary.** Grams of ``SHORTEST`` code points are extended, point by point up to ``LONGEST``,
  as long as they are frequent (over one in ``FREQUENT_SHARE`` of all grams of that length). So frequent short grams are
  pruned in favour of longer, rarer ones. Only the frequent ones need to be known: the gram at a
  place is the shortest that is not frequent. There are at most ``FREQUENT_SHARE`` of each length.
* **Decomposition.** A word, with ``LONGEST - 1`` marks before and after it, becomes the grams that start at its places, but
  for those inside an earlier one.
* **Bound.** For every edit of a word, the grams it may change are counted: those that hold the
  edited place, those after such a one in front of the place (a gram that has grown may swallow them), and those behind it that
  a new gram may swallow, as far as a frequent gram goes on that way. The largest count bounds how many grams any single
  edit costs. At least the rest is found, at the same place or one off, in every near word.
  With the marks, and words of two points or more, the rest is never empty (the first and the last gram are too far apart
  for one edit), so no word needs another road.
* **Merging.** Of a word's grams only the rarest are needed, one more than the bound: two near
  words share one of those (of the grams they share, the rarest, leftmost one is among them on both sides).
  So the long lists of frequent grams are never merged. Lists are by gram, place and length of the word.
* **Verifying.** Pairs from a list are compared by their letters' bits and then by edit distance.

A list that holds a large share of the words is split by the joins of adaptive execution, as both sides are tables. A pair
of words is emitted only if it is verified. Texts are counted in Spark with partial sums, so a very frequent word is
one row per task before it is shuffled.

Defined results: a NULL text has no words, a NULL id is the empty text in the rule that alters
some of the runs. Repeated rows count again. Other columns play no part. A run of letters may be as long as a text.
Words of fewer than two code points are not compared.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.llm.frames import batch_of, slices
from fareloom.llm.tables import Scratch

RUNS = "[A-Za-zÀ-ÿ]+"
SHORTEST, LONGEST = 2, 4
#: A gram is frequent if it is over one in so many of its length; of the grams of words, to tell rare lists apart.
FREQUENT_SHARE, LISTED_SHARE = 10_000, 100_000
_BEFORE, _AFTER = "\x02", "\x03"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_DECOMPOSED = T.StructType(
    [
        T.StructField("word", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("grams", T.ArrayType(T.StringType())),
        T.StructField("places", T.ArrayType(T.IntegerType())),
        T.StructField("bound", T.IntegerType()),
    ]
)
_LISTED = T.StructType(
    [
        T.StructField("word", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("length", T.IntegerType()),
        T.StructField("letters", T.LongType()),
        T.StructField("gram", T.StringType()),
        T.StructField("place", T.IntegerType()),
    ]
)


def altered_words(run: Column, key: Column, every: int = 97) -> Column:
    """Lower-cased runs; of those whose crc32 with the id is divisible by ``every``, one code point is left out."""
    code = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), run))
    gone = (code % F.length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), gone), F.substring(run, gone + 2, F.length(run)))
    return F.when(code % every == 0, shorter).otherwise(run)


def count_words(df: DataFrame, key: str = "doc_id", text: str = "text", least_points: int = 5, least_rows: int = 3) -> DataFrame:
    """Words of all texts, after the rule that alters some runs, with how often they occur: ``word``, ``n``."""
    lowered = F.translate(F.col(text).cast("string"), _UPPER, _LOWER)
    runs = df.select(F.col(key).alias("id"), F.explode(F.regexp_extract_all(lowered, F.lit(RUNS), 0)).alias("run"))
    words = runs.select(altered_words(F.col("run"), F.col("id")).alias("word"))
    counted = words.where(F.length("word") >= least_points).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= least_rows)


def marked(word: str) -> str:
    return _BEFORE * (LONGEST - 1) + word + _AFTER * (LONGEST - 1)


def frequent_grams(words: DataFrame, share: int = FREQUENT_SHARE) -> set[str]:
    """Grams that longer ones stand for, at most ``share`` of each length below the longest."""
    pad = LONGEST - 1
    framed = words.select(F.concat(F.lit(_BEFORE * pad), F.col("word"), F.lit(_AFTER * pad)).alias("w"))
    found: set[str] = set()
    for size in range(SHORTEST, LONGEST):
        places = F.explode(F.sequence(F.lit(1), F.length("w") - size + 1))
        grams = framed.select("w", places.alias("p")).select(F.substring(F.col("w"), F.col("p"), F.lit(size)).alias("gram"))
        counted = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
        total = words.agg(F.sum(F.length("word") + 2 * pad - size + 1)).first()[0] or 0
        found |= {row.gram for row in counted.where(F.col("n") > total / share).collect()}
    return found


class Grams:
    """The dictionary of frequent grams, and what it makes of a word."""

    def __init__(self, frequent: set[str]):
        self.frequent = frequent
        self.tails = {gram[i:] for gram in frequent for i in range(1, len(gram))}

    def reads(self, word: str) -> list[tuple[int, int]]:
        """For each place of a marked word the end of its gram, and how far it had to read."""
        size, found = len(word), []
        for p in range(size - SHORTEST + 1):
            end = p + SHORTEST
            while end - p < LONGEST and word[p:end] in self.frequent:
                if end == size:
                    # It would have read on, so a point added at the end changes it.
                    end += 1
                    break
                end += 1
            found.append((min(end, size), end))
        return found

    def swallowed(self, word: str, place: int) -> int:
        """How far a new gram that starts before ``place`` may reach."""
        far = place + SHORTEST - 1
        for end in range(place + 1, min(len(word), place + LONGEST - 2) + 1):
            if word[place:end] in self.tails:
                far = max(far, end + 1)
        return far

    def decompose(self, word: str) -> tuple[list[str], list[int], int]:
        """A word's grams, their places, and how many of them one edit may change."""
        text = marked(word)
        reads = self.reads(text)
        starts, ends, last = [], [], -1
        for p, (end, _) in enumerate(reads):
            if end > last:
                starts.append(p)
                ends.append(end)
                last = end
        pad, size = LONGEST - 1, len(text)
        reach = [max(0, i - LONGEST) for i in range(size + 1)]
        bound = 0
        for i in range(pad, size - pad + 1):
            # The first place before i whose gram reads the point at i.
            first = next((p for p in range(reach[i], i) if p < len(reads) and reads[p][1] > i), i)
            low = bisect_left(starts, first)
            # A point put in before i.
            bound = max(bound, max(bisect_left(starts, i), bisect_right(ends, self.swallowed(text, i))) - low)
            if i < size - pad:
                # The point at i replaced or left out.
                bound = max(bound, max(bisect_right(starts, i), bisect_right(ends, self.swallowed(text, i + 1))) - low)
        return [text[a:b] for a, b in zip(starts, ends, strict=True)], starts, bound


def _decomposer(frequent: set[str]):
    grams = Grams(frequent)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "word", 1 << 17):
                made = [grams.decompose(word) for word in part.column("word").to_pylist()]
                yield batch_of(
                    {"word": part.column("word"), "n": part.column("n"), "grams": [m[0] for m in made], "places": [m[1] for m in made], "bound": [m[2] for m in made]},
                    _DECOMPOSED,
                )

    return run


def _lister(counts: dict[str, int]):
    """A row for each of a word's rarest grams, one more than its bound."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "word", 1 << 17):
                out: dict[str, list] = {name: [] for name in _LISTED.names}
                for word, n, grams, places, bound in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    rarest = sorted((counts.get(g, 0), g, p) for g, p in zip(grams, places, strict=True))[: bound + 1]
                    letters = 0
                    for letter in set(word):
                        letters |= 1 << ord(letter) % 63
                    out["word"] += [word] * len(rarest)
                    out["n"] += [n] * len(rarest)
                    out["length"] += [len(word)] * len(rarest)
                    out["letters"] += [letters] * len(rarest)
                    out["gram"] += [g for _, g, _ in rarest]
                    out["place"] += [p for _, _, p in rarest]
                yield batch_of(out, _LISTED)

    return run


def near_words(words: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs of words that one inserted, deleted or replaced code point tells apart, each pair once.

    ``words`` has distinct ``word`` of two code points or more, and ``n``. Columns: ``a``, ``a_n``, ``b``, ``b_n``.
    """
    cut = scratch.write(words.mapInArrow(_decomposer(frequent_grams(words)), _DECOMPOSED), "grams")
    listed = cut.select(F.explode("grams").alias("gram"))
    total = cut.agg(F.sum(F.size("grams"))).first()[0] or 0
    counted = listed.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > total / LISTED_SHARE)
    counts = {row.gram: row.n for row in counted.collect()}
    lists = scratch.write(cut.mapInArrow(_lister(counts), _LISTED), "lists")
    # Words of one length share a gram at the same place; in a word longer by one it is there or one further on.
    asking = F.array(
        *[F.struct((F.col("length") + more).alias("length"), (F.col("place") + on).alias("place")) for more, on in ((0, 0), (1, 0), (1, 1))]
    )
    left = lists.select(
        F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("letters").alias("a_letters"), F.col("length").alias("a_length"), "gram", F.explode(asking).alias("at")
    ).select("a", "a_n", "a_letters", "a_length", "gram", F.col("at.length").alias("length"), F.col("at.place").alias("place"))
    right = lists.withColumnsRenamed({"word": "b", "n": "b_n", "letters": "b_letters"})
    once = (F.col("a_length") < F.col("length")) | (F.col("a") < F.col("b"))
    close = F.bit_count(F.col("a_letters").bitwiseXOR(F.col("b_letters"))) <= 2
    pairs = left.join(right, ["gram", "length", "place"]).where(once & close).where(F.levenshtein("a", "b", 1) == 1)
    return scratch.write(pairs.select("a", "a_n", "b", "b_n").distinct(), "near")


def grouped_variants(
    df: DataFrame, key: str = "doc_id", text: str = "text", least_points: int = 5, least_rows: int = 3, scratch: Scratch | None = None
) -> DataFrame:
    """All words with the spelling they belong to: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    ``form`` is the near word that occurs most (ties: the first in code-point order), if it occurs twice as
    often as the word or more; ``root`` is where forms lead to, the word itself if it has none.
    """
    if least_points < 2:
        raise ValueError("words of fewer than two code points have no bound")
    scratch = scratch or Scratch(df.sparkSession, "variants")
    words = scratch.write(count_words(df, key, text, least_points, least_rows), "words")
    pairs = near_words(words, scratch)
    both = pairs.unionAll(pairs.select("b", "b_n", "a", "a_n")).toDF("word", "n", "near", "near_n")
    best = both.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    strong = -F.col("best.less") >= 2 * F.col("n")
    known = best.select("word", "n_near", F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n"))
    known = scratch.write(known, "forms")
    # Counts at least double from a word to its form, so ways are short and have no circles; every round doubles the steps.
    ways = scratch.write(known.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "ways")
    went = True
    while went:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        joined = ways.select("word", "root").join(further, "root", "left")
        longer = scratch.write(joined.select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("went")), "ways")
        scratch.drop(ways)
        ways, went = longer, not longer.where("went").isEmpty()
    ways = ways.select("word", "root")
    return (
        words.join(known, "word", "left")
        .join(ways, "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
    )
