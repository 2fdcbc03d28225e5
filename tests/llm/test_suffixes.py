"""Minimisers from their definition, passages against all windows of words."""

import random

import numpy as np
import pytest

from fareloom.llm import suffixes
from fareloom.llm.queries import op3_suffix_dedup
from fareloom.llm.suffixes import Sparse, common_words, cut_words, gram_hashes, minimisers, owned_windows, repeated_passages, without_passages


def words(rng, n):
    return ["".join(rng.choice("abcdefghijklmnopqrstuvwé") for _ in range(rng.randint(1, 9))) for _ in range(n)]


def windows_before(rows, size):
    """Words of each row that lie in a window of that size which occurs at an earlier place."""
    seen, found = set(), {}
    for key, text in rows:
        split = (text or "").split()
        found[key] = set()
        for i in range(len(split) - size + 1):
            window = tuple(split[i : i + size])
            if window in seen:
                found[key].update(range(i, i + size))
            seen.add(window)
    return found


def covered(df):
    found = {}
    for r in repeated_passages(df).collect():
        span = set(range(r.start, r.start + r.length))
        assert not span & found.get(r.doc_id, set())
        found.setdefault(r.doc_id, set()).update(span)
    return found


@pytest.mark.parametrize("ranges", [1, 9])
def test_texts_put_together_from_a_few_pieces(spark, monkeypatch, ranges):
    """Every piece occurs in many texts beside others, so most suffixes hide some, and many have several matches."""
    monkeypatch.setattr(suffixes, "SUFFIXES_PER_RANGE", 2000 // ranges)
    rng = random.Random(9)
    pieces = [words(rng, rng.choice([12, 20, 30, 45, 60])) for _ in range(14)]
    rows = [(i, " ".join(w for _ in range(rng.randint(2, 7)) for w in rng.choice(pieces))) for i in range(150)]
    want = {key: span for key, span in windows_before(rows, 50).items() if span}
    assert covered(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == want


def test_a_text_of_some_megabytes(spark):
    rng = random.Random(10)
    long = words(rng, 300_000)
    rows = [(1, " ".join(long)), (2, " ".join(long[1000:1100])), (3, "x" * 3_000_000)]
    got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r.doc_id, r.start, r.length, r.source_ids) for r in got] == [(2, 0, 100, [1])]


@pytest.mark.parametrize("window", [1, 2, 5, 40])
def test_minimisers_equal_their_definition(window):
    rng = np.random.default_rng(window)
    counts = np.array([0, 1, 3, 60, 200, 0, 41], np.int64)
    hashes = rng.integers(0, 50, counts.sum()).astype(np.uint64)
    got, at = minimisers(hashes, counts, window), 0
    for n in counts.tolist():
        own = hashes[at : at + n]
        want = np.zeros(n, bool)
        for i in range(max(1, n - window + 1)):
            part = own[i : i + window]
            want[i : i + window] |= part == part.min(initial=99)
        assert got[at : at + n].tolist() == want.tolist()
        at += n


def test_hashes_do_not_depend_on_the_place():
    raw = np.frombuffer(b"one two three one two three", np.uint8)
    a, b, c = gram_hashes(raw, np.array([0, 14, 4]), np.array([13, 27, 17]))
    assert a == b != c
    assert common_words(b"ab c ", b"ab d ") == 1 and common_words(b"ab ", b"abc ") == 0 and common_words(b"a b ", b"a b ") == 2


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_passages_equal_all_windows(spark, setting, monkeypatch, ranges):
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    setting("spark.sql.shuffle.partitions", "5")
    monkeypatch.setattr(suffixes, "SUFFIXES_PER_RANGE", 2000 // ranges)
    rng = random.Random(6)
    passages = [words(rng, n) for n in (50, 51, 70, 49, 300)]
    rows, planted, seen = [], {}, set()
    for i in range(100):
        before, which = words(rng, rng.randint(5, 60)), rng.randrange(len(passages))
        rows.append((i, " ".join([*before, *passages[which], *words(rng, rng.randint(0, 50))])))
        if which in seen and len(passages[which]) >= 50:
            planted[i] = set(range(len(before), len(before) + len(passages[which])))
        seen.add(which)
    rows += [(200 + i, rows[i % 3][1]) for i in range(30)] + [(300, None), (301, ""), (302, "short"), (303, "la " * 200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = windows_before(rows, 50)
    got = covered(df)
    # A word more at an end may be shared with another earlier text than the one compared.
    assert all(span <= want[key] for key, span in got.items())
    assert all(span <= got[key] for key, span in planted.items())
    assert all(got[key] == want[key] for key in range(200, 230)) and got[303] == want[303]


def test_sources_and_cut_texts(spark):
    rng = random.Random(2)
    shared, own = words(rng, 70), [words(rng, 30) for _ in range(4)]
    texts = [" ".join([*own[0], *shared]), "\n".join([*own[1], *shared, *own[2]]), None, " ".join(shared)]
    rows = [(1, texts[0], 5), (2, texts[1], 6), (3, texts[2], 7), (None, texts[3], 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int")
    got = sorted((r.doc_id or 0, r.start, r.length, r.source_ids) for r in repeated_passages(df).collect())
    assert got == [(0, 0, 70, [1]), (2, 30, 70, [1])]
    left = without_passages(df)
    assert left.columns == df.columns
    assert {r.doc_id: r.text for r in left.collect()} == {1: texts[0], 2: "\n".join([*own[1], *own[2]]), 3: None, None: ""}
    assert without_passages(df.limit(0)).count() == 0 and repeated_passages(df.limit(0)).count() == 0
    assert cut_words(" a b  c ", [{"start": 2, "length": 1}, {"start": 0, "length": 1}]) == " b  "


def test_repeated_rows(spark):
    text = " ".join(words(random.Random(1), 90))
    got = repeated_passages(spark.createDataFrame([(1, text)] * 3, "doc_id long, text string")).collect()
    assert [(r.doc_id, r.start, r.length, r.source_ids) for r in got] == [(1, 0, 90, [1])] * 2


@pytest.mark.parametrize("ranges", [1, 7])
def test_passages_whose_tail_or_head_occurs_earlier(spark, monkeypatch, setting, ranges):
    """Documents that hold a part of a passage come before the first one that holds all of it."""
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    monkeypatch.setattr(suffixes, "SUFFIXES_PER_RANGE", 2000 // ranges)
    rng, rows = random.Random(8), []
    footer = words(rng, 45)
    for i in range(60):
        passage = words(rng, rng.randint(50, 80))
        if i % 3 == 0:
            passage = [*passage[:10], *footer]
        part = rng.randint(8, 49)
        parts = [passage[-part:], passage[:part]][: 1 + i % 2]
        for held in (*parts, passage, passage, passage):
            rows.append((len(rows), " ".join([*words(rng, rng.randint(5, 60)), *held, *words(rng, rng.randint(0, 50))])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = {key: span for key, span in windows_before(rows, 50).items() if span}
    assert len(want) >= 120 and covered(df) == want


@pytest.mark.parametrize("ranges", [1, 9])
def test_texts_put_together_from_a_few_pieces(spark, monkeypatch, ranges):
    """Every piece occurs in many texts beside others, so most suffixes hide some, and many have several matches."""
    monkeypatch.setattr(suffixes, "SUFFIXES_PER_RANGE", 2000 // ranges)
    rng = random.Random(9)
    pieces = [words(rng, rng.choice([12, 20, 30, 45, 60])) for _ in range(14)]
    rows = [(i, " ".join(w for _ in range(rng.randint(2, 7)) for w in rng.choice(pieces))) for i in range(150)]
    want = {key: span for key, span in windows_before(rows, 50).items() if span}
    assert covered(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == want


def test_a_text_of_some_megabytes(spark):
    rng = random.Random(10)
    long = words(rng, 300_000)
    rows = [(1, " ".join(long)), (2, " ".join(long[1000:1100])), (3, "x" * 3_000_000)]
    got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r.doc_id, r.start, r.length, r.source_ids) for r in got] == [(2, 0, 100, [1])]


@pytest.mark.parametrize("window", [1, 2, 5, 40])
def test_each_window_has_one_gram(window):
    rng = np.random.default_rng(window)
    counts = np.array([0, 1, 3, 60, 200, 0, 41], np.int64)
    hashes = rng.integers(0, 50, counts.sum()).astype(np.uint64)
    near, far = owned_windows(hashes, counts, window)
    got = {(p - k, p) for p in range(len(hashes)) for k in range(near[p], far[p] + 1)}
    begins = [b for first, n in zip(np.cumsum(counts) - counts, counts, strict=True) for b in range(first, first + n - window + 1)]
    assert got == {(b, b + int(np.argmin(hashes[b : b + window]))) for b in begins}


def test_a_plan_that_would_miss_matches_is_refused():
    with pytest.raises(ValueError):
        Sparse(gram=8, window=60, least=50)


def test_query_against_all_windows(spark, sf_dir):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    want = {key: span for key, span in windows_before(rows, 50).items() if span}
    got = {}
    for r in op3_suffix_dedup(spark, sf_dir).collect():
        got.setdefault(r.doc_id, set()).update(range(r.start, r.start + r.length))
    assert all(span <= want[key] for key, span in got.items())
    assert sum(map(len, got.values())) >= 0.995 * sum(map(len, want.values())) > 0
    assert suffixes.Sparse().reach >= 50
