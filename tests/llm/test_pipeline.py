"""Every stage, and all of them, against plain loops over a small corpus."""

import random
import re

import public_tokenizers
import pytest
import test_chunks
import test_repetition
import test_simhash
from test_exact import lowered
from test_packing import checked
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from fareloom.llm.packing import Tiers
from fareloom.llm.queries import END_ID

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(11)
    texts = [test_chunks.words(rng, rng.randint(3, 120)) for _ in range(60)]
    passage = test_chunks.words(rng, 70)
    texts += [f"{test_chunks.words(rng, 40)} {passage} {test_chunks.words(rng, 40)}" for _ in range(6)]
    texts += [texts[7].upper(), texts[7], texts[7].replace(" ", "  "), texts[8] + " x", "same words again " * 30, None, "", "few words"]
    near = test_chunks.words(rng, 400)
    texts += [near + f" end{i}" for i in range(5)]
    return [(i, text, "en", f"src{i % 3}", len(text or "")) for i, text in enumerate(texts)]


def brute(rows):
    """The documents that each stage leaves, as (id, text)."""
    stages = []
    docs = [(key, text) for key, text, *_ in rows if test_repetition.brute(text)["kept"]]
    stages.append(docs)
    last = {lowered(text): key for key, text in docs}
    docs = [(key, text) for key, text in docs if last[lowered(text)] == key]
    stages.append(docs)
    prints = {key: test_simhash.brute_print(text) for key, text in docs}
    root = test_simhash.brute_roots(sorted(prints), lambda a, b: test_simhash.distance(prints[a], prints[b]) <= 2)
    docs = [(key, text) for key, text in docs if root[key] == key]
    stages.append(docs)
    cuts = {}
    for key, start, length, _ in test_chunks.brute(docs):
        cuts.setdefault(key, []).append((start, length))
    left = []
    for key, text in docs:
        raw = text.encode()
        for start, length in sorted(cuts.get(key, []), reverse=True):
            raw = raw[:start] + raw[start + length :]
        left.append((key, raw.decode()))
    stages.append(left)
    return stages


def test_stages_equal_loops(spark, tmp_path):
    rows = corpus()
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(path)
    docs = spark.read.parquet(path)
    sizes = []
    for i, want in enumerate(brute(rows)):
        docs = corpus_pipeline.STAGES[i][1](spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs.write.parquet(str(tmp_path / f"stage{i}"))
        docs = spark.read.parquet(str(tmp_path / f"stage{i}"))
        assert sorted((r.doc_id, r.text) for r in docs.collect()) == want
        assert all(r.n_chars == len(r.text) and r.source == f"src{r.doc_id % 3}" for r in docs.collect())
        sizes.append((len(want), sum(len(text) for _, text in want)))
    assert sizes[0][0] > sizes[1][0] > sizes[2][0] == sizes[3][0] and sizes[2][1] > sizes[3][1]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {key: [*library.encode(text, add_special_tokens=False).ids, END_ID] for key, text in brute(rows)[-1]}
    checked(corpus_pipeline.STAGES[4][1](spark, docs, str(tmp_path)).collect(), ids, Tiers())
    checked(corpus_pipeline.run(spark, str(tmp_path)).collect(), ids, Tiers())


@pytest.mark.parametrize("kind", ["empty", "nulls", "repeated", "extra"])
def test_stages_take_any_rows(spark, tmp_path, kind):
    rows = {
        "empty": [],
        "nulls": [(None, None, None, None, None)] * 3 + [(None, test_chunks.words(random.Random(1), 90), None, None, None)] * 2,
        "repeated": [(1, test_chunks.words(random.Random(2), 90), "a", "b", 4)] * 5 + [(1, test_chunks.words(random.Random(3), 90), "a", "b", 4)],
        "extra": [(i, test_chunks.words(random.Random(i), 60), "a", "b", 4) for i in range(4)],
    }[kind]
    df = spark.createDataFrame(rows, SCHEMA)
    if kind == "extra":
        df = df.selectExpr("*", "doc_id AS ids", "text AS _text", "lang AS print", "1 AS start", "2 AS kept", "'x' AS quality", "doc_id AS length")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == df.columns
    assert len(docs.collect()) == {"empty": 0, "nulls": 1, "repeated": 2, "extra": 4}[kind]
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sum(p.start == 0 for p in pieces) == {"empty": 0, "nulls": 1, "repeated": 2, "extra": 4}[kind]


def test_registered():
    assert queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in oracle_sql()
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries() if re.match(r"op\d+_", name))
    assert numbers == list(range(1, 14))
