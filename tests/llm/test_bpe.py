"""Encoding against the library that the vocabulary is made for, and round trips."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fareloom.llm import bpe
from fareloom.llm.queries import VOCABULARY, op1_bpe_round_trip

PIECES = [
    "a", "'", "s", "t", "re", "'s", "'ll", " ", "  ", "\n", "\t", "1", "23", "é", "ß", "中", "<|endoftext|>", "<|end",
    "\x1c", "\x85", "\xa0", "　", "!", "...", "\U0001f600", "_", "the", "aaaa", "Ⅷ", "²", "́", "ǅ", "\x00",
    "'ve", "'S", "\r\n", "internationalisation", "thoulyhe",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_random_texts_encode_as_in_the_library(library):
    rng = random.Random(5)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    texts += ["", "   ", "a" * 5000, "ab" * 3000, "\x00" * 40, " " * 300 + "x"]
    codec = bpe.codec(VOCABULARY)
    ids = list(codec.encode(texts))
    assert ids == [packed(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert codec.decode(ids) == texts


def test_a_full_word_table_starts_again(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 3)
    monkeypatch.setattr(bpe, "CHARS_AT_ONCE", 10)
    codec = bpe.Codec(bpe.Vocabulary(VOCABULARY))
    texts = [f"word{i} and more of it, again and again" for i in range(50)]
    assert list(codec.encode(texts)) == [packed(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_bytes_that_are_no_text_are_replaced(library):
    ids = library.encode("é", add_special_tokens=False).ids[:1] + [200, 199]
    assert bpe.codec(VOCABULARY).decode([packed(ids), None, b""]) == [library.decode(ids), "", ""]


def test_nulls_ties_and_clashing_columns(spark):
    rows = [(1, None, "x"), (2, "", "x"), (2, "", "x"), (None, "it's", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.unpack(bpe.decode(bpe.encode(df, VOCABULARY), VOCABULARY)).collect()
    assert sorted((r.doc_id or 0, r.decoded, len(r.id_list)) for r in got) == [(0, "it's", 2), (1, "", 0), (2, "", 0), (2, "", 0)]
    assert bpe.encode(df.limit(0), VOCABULARY).count() == 0


def test_query_over_the_whole_table(spark, library, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = {r.doc_id: r for r in op1_bpe_round_trip(spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for doc in docs:
        ids = library.encode(doc.text or "", add_special_tokens=False).ids
        row = got[doc.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(packed(ids)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
