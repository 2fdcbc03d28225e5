"""Quality rules over the words of a text, with repetition found by suffix arrays.

Many texts are sorted at once: the words of a batch lie in one flat array, a suffix of one
text is never compared with another text's, and each round of prefix doubling sorts only
suffixes that still share all words looked at. Neighbours in the sorted order give the
longest-common-prefix intervals; a suffix's deepest interval, the longest repeated substring
that starts there, is the larger of its two neighbours' common prefixes. The union of those
spans is the part of a text that occurs at least twice in it.

Words are runs of bytes other than the blank, tab, line and form feeds and carriage return.

Defined results: a NULL text counts as empty; a text without words fails the base rules (too
few words) and has no spans. Long texts are read whole. Rows are independent of each other,
so repeated rows and ties do not matter; a column named as the result is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fareloom.llm.frames import append_column, arrow_schema

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
#: Words in the windows of the base rule.
WINDOW_WORDS = 5


@dataclass(frozen=True)
class RepetitionLimits:
    """Limits of the suffix-array rule; repeats of fewer than ``least_words`` words don't count."""

    least_words: int = 8
    most_covered_percent: int = 15
    most_longest_words: int = 100


QUALITY = T.StructType(
    [
        *[
            T.StructField(name, T.LongType(), False)
            for name in (
                "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_words", "longest_repeat",
            )
        ],
        T.StructField("repeat_starts", T.ArrayType(T.IntegerType(), False), False),
        T.StructField("repeat_lengths", T.ArrayType(T.IntegerType(), False), False),
        T.StructField("base_failed", T.BooleanType(), False),
        T.StructField("kept", T.BooleanType(), False),
    ]
)


class _Numbers(dict):
    """Words numbered from 1 in the order they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) + 1
        return number


def deepest_repeats(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each word of texts put together: words in the longest repeat that starts there.

    ``words`` are numbers from 1, ``lengths`` the words of each text. Both occurrences of a
    repeat lie in the same text.
    """
    n = len(words)
    if not n:
        return np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(lengths)), lengths)
    end = np.repeat(np.cumsum(lengths), lengths)
    place = np.arange(n)

    def after(ranks: np.ndarray, at: np.ndarray, step: int) -> np.ndarray:
        """Rank ``step`` words on, 0 past the end of the text."""
        return np.where(at + step < end[at], ranks[np.minimum(at + step, n - 1)], 0)

    second = after(words, place, 1)
    bits = int(words.max()).bit_length()
    if 2 * bits + len(lengths).bit_length() <= 63:
        key = (text << bits | words) << bits | second
        suffixes = np.argsort(key, kind="stable")
        key = key[suffixes]
        new = np.concatenate([[True], key[1:] != key[:-1]])
    else:
        suffixes = np.lexsort((second, words, text))
        change = [x[suffixes][1:] != x[suffixes][:-1] for x in (text, words, second)]
        new = np.concatenate([[True], change[0] | change[1] | change[2]])
    # A suffix's rank is the place of its group's first member in the sorted order, plus one.
    rank = np.empty(n, np.int64)
    rank[suffixes] = np.maximum.accumulate(np.where(new, place, 0)) + 1
    levels = [(1, words), (2, rank.copy())]
    step = 2
    shared = ~new | np.append(~new[1:], False)
    places = np.flatnonzero(shared)
    while len(places):
        active = suffixes[places]
        key = rank[active] * (n + 1) + after(rank, active, step)
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        suffixes[places] = active
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[active] = places[np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))] + 1
        step *= 2
        levels.append((step, rank.copy()))
        places = places[~new | np.append(~new[1:], False)]
    left, right = suffixes[:-1], suffixes[1:]
    pairs = np.flatnonzero(levels[1][1][left] == levels[1][1][right])
    left, right = left[pairs], right[pairs]
    common = np.zeros(len(pairs), np.int64)
    room = np.minimum(end[left] - left, end[right] - right)
    for step, ranks in reversed(levels):
        inside = np.flatnonzero(common + step <= room)
        same = ranks[left[inside] + common[inside]] == ranks[right[inside] + common[inside]]
        common[inside[same]] += step
    deepest = np.zeros(n, np.int64)
    np.maximum.at(deepest, left, common)
    np.maximum.at(deepest, right, common)
    return deepest


def covered(deepest: np.ndarray, least: int) -> np.ndarray:
    """Which words lie in a repeat of at least so many words."""
    starts = np.flatnonzero(deepest >= least)
    change = np.bincount(starts, minlength=len(deepest) + 1).astype(np.int64)
    np.subtract.at(change, starts + deepest[starts], 1)
    return np.cumsum(change)[:-1] > 0


def measure(texts: list[str | None], limits: RepetitionLimits) -> dict[str, np.ndarray | list]:
    """The measures of ``QUALITY`` for some texts."""
    texts = [text or "" for text in texts]
    numbers = _Numbers()
    split = [text.encode().split() for text in texts]
    lengths = np.array([len(words) for words in split], np.int64)
    words = np.fromiter(map(numbers.__getitem__, (w for words in split for w in words)), np.int64, int(lengths.sum()))
    deepest = deepest_repeats(words, lengths)
    ends = np.cumsum(lengths)
    begins = ends - lengths

    def per_text(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[ends] - sums[begins]

    in_repeat = covered(deepest, limits.least_words)
    # Spans of neighbouring texts may touch, so they are cut where texts begin.
    edge = np.zeros(len(words) + 1, bool)
    edge[begins], edge[-1] = True, True
    opened = in_repeat & (edge[:-1] | np.concatenate([[True], ~in_repeat[:-1]]))
    closed = in_repeat & (edge[1:] | np.append(~in_repeat[1:], True))
    span_starts, span_ends = np.flatnonzero(opened), np.flatnonzero(closed) + 1
    first_span = np.searchsorted(span_starts, begins)
    last_span = np.searchsorted(span_starts, ends)
    own = span_starts - np.repeat(begins, last_span - first_span)
    longest = np.zeros(len(texts), np.int64)
    some = lengths > 0
    if some.any():
        longest[some] = np.maximum.reduceat(deepest, begins[some])
    longest[longest < limits.least_words] = 0
    n_repeat = per_text(covered(deepest, WINDOW_WORDS))
    n_covered = per_text(in_repeat)
    dup_lines = []
    for text in texts:
        lines = [line for line in text.split("\n") if line.strip(BLANKS)]
        dup_lines.append(len(lines) - len(set(lines)))
    base_failed = (lengths < 10) | (100 * n_repeat > 20 * lengths)
    good = (100 * n_covered <= limits.most_covered_percent * lengths) & (longest <= limits.most_longest_words)
    return {
        "n_words": lengths,
        "word_chars": np.array([len(t) - sum(map(t.count, BLANKS)) for t in texts], np.int64),
        "n_symbols": np.array([sum(map(t.count, SYMBOLS)) for t in texts], np.int64),
        "n_dup_lines": np.array(dup_lines, np.int64),
        "n_repeat_words": n_repeat,
        "n_covered_words": n_covered,
        "longest_repeat": longest,
        "repeat_starts": [own[a:b] for a, b in zip(first_span, last_span, strict=True)],
        "repeat_lengths": [(span_ends - span_starts)[a:b] for a, b in zip(first_span, last_span, strict=True)],
        "base_failed": base_failed,
        "kept": ~base_failed & good,
    }


def with_quality(
    df: DataFrame, text: str = "text", name: str = "quality", limits: RepetitionLimits = RepetitionLimits()
) -> DataFrame:
    """``df`` with a struct of measures and the verdict ``kept``; spans are in words."""
    fields = arrow_schema(QUALITY)

    def run(texts: pa.Array) -> pa.Array:
        found = measure(texts.to_pylist(), limits)
        return pa.StructArray.from_arrays([pa.array(found[f.name], f.type) for f in fields], fields=list(fields))

    return append_column(df, text, name, QUALITY, run)
