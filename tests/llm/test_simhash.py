"""Fingerprints from their definition, components from all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from fareloom.llm import simhash
from fareloom.llm.components import components
from fareloom.llm.queries import op6_simhash
from fareloom.llm.tables import PLACE, Scratch


def brute_print(text, shingle=3):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_roots(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def distance(a, b):
    return ((a ^ b) & (1 << 64) - 1).bit_count()


def test_fingerprints_equal_their_definition():
    rng = random.Random(1)
    words = ["a", "B", "É", "ccc", "the", "of\x1cx", "zz"]
    texts = [rng.choice([" ", "\n"]).join(rng.choice(words) for _ in range(rng.randint(0, 900))) for _ in range(60)]
    texts += [None, "", " \t", "one", "one two", "one Two three", "x " * 40000]
    for shingle in (1, 2, 3, 5):
        assert simhash.fingerprints(texts, shingle).tolist() == [brute_print(t, shingle) for t in texts]
    assert simhash.fingerprints([None]).tolist() == [0]


@pytest.mark.parametrize("paired", [2, 32])
@pytest.mark.parametrize("most_bits", [1, 2, 3])
def test_links_join_what_all_pairs_join(spark, monkeypatch, setting, paired, most_bits):
    monkeypatch.setattr(simhash, "PAIRED", paired)
    setting("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    rng = random.Random(most_bits)
    prints = {rng.getrandbits(64) for _ in range(5)} | {0}
    for centre in list(prints):
        for _ in range(40):
            prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
        for _ in range(30):
            prints.add(centre ^ rng.getrandbits(6) << 55)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.links_within(spark.createDataFrame([(p,) for p in signed], "print long"), most_bits)
    roots = {r.node: r.root for r in components(links, Scratch(spark, "test")).collect()}
    want = brute_roots(signed, lambda a, b: distance(a, b) <= most_bits)
    ours, theirs = {}, {}
    for p in signed:
        ours.setdefault(roots.get(p, p), set()).add(p)
        theirs.setdefault(want[p], set()).add(p)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_chains_stars_and_rings(spark):
    rng = random.Random(7)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(50)] + [(300 + i, 300 + (i + 1) % 9) for i in range(9)]
    links += [(500 + a, 500 + b) for a, b in zip(rng.sample(range(40), 40), rng.sample(range(40), 40), strict=True)] + [(7, 7)]
    nodes = sorted({n for link in links for n in link})
    linked = {*links, *((b, a) for a, b in links)}
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), Scratch(spark, "test")).collect()}
    want = brute_roots(nodes, lambda a, b: (a, b) in linked)
    assert len({(got.get(n, n), want[n]) for n in nodes}) == len({got.get(n, n) for n in nodes}) == len(set(want.values()))


def test_nulls_ties_and_other_columns(spark):
    rows = [(3, None, "x"), (3, "", "y"), (None, " ", "z"), (5, "one two three four", "z"), (9, "ONE two three four", "z"), (None, "alone", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, print string")
    got = simhash.near_duplicates(df).drop(*PLACE).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0), (0, 3), (3, 3), (3, 3), (5, 5), (9, 5)]
    left = simhash.without_near_duplicates(df)
    assert left.columns == df.columns and sorted(r.doc_id or 0 for r in left.collect()) == [0, 3, 5]
    assert simhash.without_near_duplicates(df.limit(0)).count() == 0


def test_query_against_all_pairs(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: r for r in op6_simhash(spark, sf_dir).collect()}
    prints = {key: brute_print(text) for key, text in docs.items()}
    assert {key: r.fingerprint for key, r in got.items()} == {key: f"{p:016x}" for key, p in prints.items()}
    want = brute_roots(sorted(docs), lambda a, b: distance(prints[a], prints[b]) <= 2)
    assert {key: r.component_id for key, r in got.items()} == want
    assert np.unique(list(want.values())).size < len(docs)
