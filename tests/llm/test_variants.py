"""Words and their variants against plain loops, and the bound against every edit."""

import collections
import random
import re
import zlib

import pytest

from fareloom.llm import variants
from fareloom.llm.queries import op12_spelling_variants
from fareloom.llm.tables import Scratch
from fareloom.llm.variants import Grams, grouped_variants, marked, near_words


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute_words(docs, least_points, least_rows):
    counts = collections.Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_points and n >= least_rows}


def edits(word, letters):
    for i in range(len(word) + 1):
        for c in letters:
            yield word[:i] + c + word[i:]
            if i < len(word) and word[i] != c:
                yield word[:i] + c + word[i + 1 :]
        if i < len(word):
            yield word[:i] + word[i + 1 :]


def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def brute(counts):
    near = {w: [v for v in counts if is_near(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda v: (-counts[v], v))
            if counts[best] >= 2 * counts[w]:
                form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {w: (form.get(w), root(w), n, len(near[w]), counts[form[w]] if w in form else None) for w, n in counts.items()}


def found(df, **more):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in grouped_variants(df, **more).collect()}


def dense_words(rng, n, letters="abc", least=2, most=9):
    return sorted({"".join(rng.choice(letters) for _ in range(rng.randint(least, most))) for _ in range(n)})


def test_near_words_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(variants, "FREQUENT_SHARE", 40)
    monkeypatch.setattr(variants, "LISTED_SHARE", 300)
    rng = random.Random(1)
    words = dense_words(rng, 400) + ["élan", "elan", "élàn", "x" * 3000, "x" * 2999 + "y", "interne", "internet", "internets"]
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    got = [(r.a, r.b) for r in near_words(df, Scratch(spark, "test")).collect()]
    assert len(got) == len({frozenset(pair) for pair in got})
    want = {frozenset((a, b)) for a in words for b in words if a < b and is_near(a, b)}
    assert {frozenset(pair) for pair in got} == want and len(want) > 300


@pytest.mark.parametrize("letters", ["ab", "abcd"])
def test_no_edit_costs_more_grams_than_the_bound(letters):
    rng = random.Random(2)
    words = dense_words(rng, 120, letters)
    counts = collections.Counter(m[i : i + q] for m in map(marked, words) for q in (2, 3) for i in range(len(m) - q + 1))
    for share in (5, 40, 1000):
        grams = Grams({g for g, n in counts.items() if n > sum(counts.values()) / share})
        for word in words:
            own, places, bound = grams.decompose(word)
            assert bound < len(own)
            for other in edits(word, letters + "z"):
                theirs = set(zip(*grams.decompose(other)[:2], strict=True))
                shift = len(other) - len(word)
                kept = sum((g, p) in theirs or (g, p + shift) in theirs for g, p in zip(own, places, strict=True))
                assert kept >= len(own) - bound


def test_grams_cover_a_word_in_order():
    grams = Grams({"ab", "abc", "\x02\x02", "\x02\x02\x02"})
    own, places, _ = grams.decompose("abcd")
    assert own[0] == "\x02\x02\x02a" and "abcd" in own and "bc" not in own and places == sorted(places)


def test_words_forms_and_roots(spark):
    rng = random.Random(3)
    pool = dense_words(rng, 60, "abcde", 5, 9)
    pool += [w + "s" for w in pool[:20]] + [w[:-1] for w in pool[10:30] if len(w) > 5] + ["Été" + w for w in pool[:5]]
    weights = [2 ** rng.randint(0, 9) for _ in pool]
    docs = [(i, " ".join(w.title() if rng.random() < 0.3 else w for w in rng.choices(pool, weights, k=rng.randint(0, 400)))) for i in range(120)]
    docs += [(None, " ".join(pool)), (None, None), (7, None), (7, ""), (3, docs[3][1]), (3, docs[3][1]), (900, "1234 $$ \n"), (901, "q" * 50_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    counts = brute_words(docs, 5, 3)
    want = brute(counts)
    assert found(df) == want
    assert any(f for f, *_ in want.values()) and any(f and r != f for f, r, *_ in want.values())
    clashing = df.selectExpr("doc_id", "text", "1 AS word", "'x' AS n", "2 AS id", "3 AS run")
    assert found(clashing) == want
    assert found(df, least_points=2, least_rows=1) == brute(brute_words(docs, 2, 1))
    assert found(df.limit(0)) == {}


def test_ties_go_to_the_first_in_code_point_order(spark):
    docs = [(1, "banana " * 4 + "banane " * 4 + "bananz bananz " + "zebras " * 3 + "zebräs " * 6)]
    got = found(spark.createDataFrame(docs, "doc_id long, text string"), least_rows=1)
    assert got == brute(brute_words(docs, 5, 1))


def test_query_against_plain_loops(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    counts = brute_words(docs, 5, 3)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in op12_spelling_variants(spark, sf_dir).collect()}
    assert got == brute(counts) and len(got) > 500
