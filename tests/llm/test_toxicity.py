"""The network's gradients and windows, what it learns, and its accuracy on held-out labels."""

import math
import random
import zlib

import numpy as np
import pytest

from fareloom.llm import toxicity
from fareloom.llm.queries import op9_toxicity
from fareloom.llm.toxicity import Shape, Training, backward, char_grams, fit, first_params, forward, gates_of, train, window_starts, with_score

TINY = Shape(window=8, word_size=3, char_size=2, states=3, attention=4, gram_buckets=64)


def auc(scores, labels):
    order = np.argsort(np.argsort(scores, kind="stable"), kind="stable") + 1
    ones = labels == 1
    return (order[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())


@pytest.mark.parametrize("lengths", [None, np.array([1, 4, 5])])
def test_gradients_equal_differences(lengths):
    rng = np.random.default_rng(1)
    params = {k: v.astype(np.float64) * 3 for k, v in first_params(TINY, 5, rng).items()}
    inputs, tokens = rng.normal(size=(6, 5)), rng.integers(0, 6, (3, 5))
    weights = np.array([1.0, -2.0, 0.5])

    def loss():
        return float(forward(params, gates_of(params, inputs), tokens, lengths) @ weights)

    trace = {}
    forward(params, gates_of(params, inputs), tokens, lengths, trace)
    grads, d_inputs = backward(params, inputs, tokens, lengths, trace, weights)
    for values, grad in [*((params[name], grads[name]) for name in grads), (inputs, d_inputs)]:
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in values.shape)
            kept = values[at]
            values[at] = kept + 1e-3
            up = loss()
            values[at] = kept - 1e-3
            down = loss()
            values[at] = kept
            assert grad[at] == pytest.approx((up - down) / 2e-3, rel=0.02, abs=2e-3)


def plain_logit(params, inputs, tokens):
    """The network in plain loops over the words of one window."""
    sig = lambda x: 1 / (1 + math.exp(-x))
    h = len(params["f_u"])

    def states(way, words):
        state, found = [0.0] * h, []
        for word in words:
            given = [sum(inputs[word][i] * params[f"{way}_w"][i][j] for i in range(len(inputs[word]))) + params[f"{way}_b"][j] for j in range(3 * h)]
            own = [sum(state[i] * params[f"{way}_u"][i][j] for i in range(h)) for j in range(3 * h)]
            z = [sig(given[j] + own[j]) for j in range(h)]
            r = [sig(given[h + j] + own[h + j]) for j in range(h)]
            new = [math.tanh(given[2 * h + j] + r[j] * own[2 * h + j]) for j in range(h)]
            state = [(1 - z[j]) * new[j] + z[j] * state[j] for j in range(h)]
            found.append(state)
        return found

    both = [f + b for f, b in zip(states("f", tokens), states("b", tokens[::-1])[::-1], strict=True)]
    scores = []
    for state in both:
        hidden = [math.tanh(sum(state[i] * params["att"][i][j] for i in range(2 * h)) + params["att_b"][j]) for j in range(len(params["att_v"]))]
        scores.append(sum(a * b for a, b in zip(hidden, params["att_v"], strict=True)))
    weights = [math.exp(s - max(scores)) for s in scores]
    pooled = [sum(w * state[i] for w, state in zip(weights, both, strict=True)) / sum(weights) for i in range(2 * h)]
    return sum(a * b for a, b in zip(pooled, params["out"], strict=True)) + params["out_b"][0]


def test_logits_equal_plain_loops():
    rng = np.random.default_rng(5)
    params = {k: v.astype(np.float64) * 2 for k, v in first_params(TINY, 5, rng).items()}
    params["att_b"], params["out_b"] = rng.normal(size=4), rng.normal(size=1)
    inputs, tokens = rng.normal(size=(9, 5)), rng.integers(0, 9, (12, 8))
    lengths = rng.integers(1, 9, 12)
    for given in (None, lengths):
        got = forward(params, gates_of(params, inputs), tokens, given)
        want = [plain_logit(params, inputs.tolist(), row[:n].tolist()) for row, n in zip(tokens, given if given is not None else [8] * 12, strict=True)]
        assert np.allclose(got, want, atol=1e-9)


def test_scores_equal_plain_loops_over_all_windows():
    rng = np.random.default_rng(6)
    vocabulary = {b"aa": 1, b"bb": 2}
    model = toxicity.Model(TINY, first_params(TINY, 2, rng), vocabulary, (1.7, -0.3))
    words = ["aa", "bb", "cc", "dädä", "e"]
    texts = [" ".join(rng.choice(words, n)) for n in (1, 5, 8, 9, 12, 16, 40)] + ["", None]

    def plain(text):
        own = (text or "").lower().encode().split()
        inputs = []
        for word in [*own, b""]:
            buckets, _ = char_grams([word], TINY)
            rows = model.params["grams"][buckets]
            inputs.append([*model.params["words"][vocabulary.get(word, 0)], *(rows.mean(axis=0) if len(rows) else np.zeros(2))])
        windows = [list(range(a, min(a + 8, len(own)))) for a in window_starts(len(own), 8)] or [[0]]
        top = max(plain_logit(model.params, inputs, window) for window in windows)
        return 1 / (1 + math.exp(-(1.7 * top - 0.3)))

    assert np.allclose(model.scores(texts), [plain(text) for text in texts], atol=1e-5)


def test_windows_cover_every_word_and_overlap():
    for n in range(0, 400):
        starts = window_starts(n, 64)
        assert {i for s in starts for i in range(s, min(n, s + 64))} == set(range(n))
        assert all(b - a <= 32 for a, b in zip(starts, starts[1:], strict=False))


def test_grams_of_words():
    buckets, counts = char_grams([b"ab", b"", b"abcd"], Shape())
    assert counts.tolist() == [2, 0, 4 + 2] and len(buckets) == 8


def sample(rng, n, length=30):
    pool = [f"word{i}" for i in range(200)]
    rows = []
    for i in range(n):
        words = [rng.choice(pool) for _ in range(rng.randint(1, length))]
        label = i % 2
        if label:
            words.insert(rng.randrange(len(words) + 1), rng.choice(["nasty", "grim", f"foul{rng.randint(0, 999)}"]))
        rows.append((i, label, " ".join(words)))
    return rows


def test_words_and_letters_are_learned():
    rows = sample(random.Random(1), 600)
    model = train([(i, label, text.encode().split()) for i, label, text in rows], 0.5, training=Training(epochs=25, batch=48))
    new = sample(random.Random(2), 200, 400)
    scores = model.scores([text for _, _, text in new])
    assert auc(scores, np.array([label for _, label, _ in new])) > 0.97
    one_by_one = np.concatenate([model.scores([text]) for _, _, text in new[:20]])
    assert np.allclose(one_by_one, scores[:20], atol=1e-5)
    assert np.allclose(model.scores([None, ""]), model.scores(["  \n"]))


def test_bounds_nulls_and_single_classes(spark):
    rows = [(i, f"good text {i}" if i % 2 else f"grim text {i}") for i in range(60)] + [(None, "x"), (70, None), (70, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(60)] + [(None, 1), (70, None), (3, 0)], "doc_id long, toxic int")
    model = fit(docs, labels, training=Training(docs_per_class=5, epochs=2))
    got = with_score(docs.withColumn("score", docs.doc_id), model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got) and got[0].asDict().keys() == {"doc_id", "text", "score"}
    for only, want in ((labels.where("toxic = 0"), 0.0), (labels.where("toxic = 1"), 1.0), (labels.limit(0), 0.0)):
        assert {r.score for r in with_score(docs, fit(docs, only)).collect()} == {want}
    assert with_score(docs.limit(0), model).count() == 0


def test_every_window_of_a_sampled_text_is_read(spark, monkeypatch):
    sizes = {i: 40 * i for i in range(1, 30)}
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(n))) for i, n in sizes.items()], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in sizes], "doc_id long, toxic int")
    given = []
    monkeypatch.setattr(toxicity, "train", lambda windows, *_: given.extend(windows))
    fit(docs, labels)
    kept = [i for i in sizes if zlib.crc32(str(i).encode()) % 5]
    want = sorted((i, i % 2, [f"w{j}".encode() for j in range(at, min(at + 64, sizes[i]))]) for i in kept for at in window_starts(sizes[i], 64))
    assert sorted(given) == want


def test_windows_of_a_toxic_text_count_by_their_logits():
    logits, texts, labels = np.array([5.0, -5, -5, 3, -3]), np.array([1, 1, 1, 2, 2]), np.array([1, 1, 1, 0, 0])
    shares = toxicity._shares(logits, texts, labels)
    assert shares[0] > 2.9 and shares[1:3].max() < 0.01 and shares[:3].sum() == pytest.approx(3) and shares[3:].tolist() == [1, 1]


def test_labels_held_out_play_no_part(spark):
    rows = [(i, "grim one" if i % 3 else "kind one") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {i for i in range(80) if zlib.crc32(str(i).encode()) % 5 == 0}
    first = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(80)], "doc_id long, toxic int")
    other = spark.createDataFrame([(i, int(i % 3 > 0) ^ int(i in out)) for i in range(80)], "doc_id long, toxic int")
    a, b = (fit(docs, labels, training=Training(epochs=1)).scores(["grim one", "kind"]) for labels in (first, other))
    assert a.tolist() == b.tolist()


def test_accuracy_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in op9_toxicity(spark, sf_dir).collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    kept = [(got[r.doc_id], r.toxic) for r in labels if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(row.held_out and row.predicted == (row.score >= 0.5) for row, _ in kept)
    y = np.array([label for _, label in kept])
    assert auc(np.array([row.score for row, _ in kept]), y) > 0.93
    assert np.mean([row.predicted == label for row, label in kept]) > 0.95
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    clean = [(row.score, label) for row, label in kept if not label]
    assert sum(score >= 0.5 for score, _ in clean) < 0.03 * len(clean)


def test_the_scale_separates_what_can_be_separated():
    rng = np.random.default_rng(8)
    for gap in (0.01, 1, 30, 1000):
        x = np.concatenate([rng.normal(0, gap / 20, 300), rng.normal(gap, gap / 20, 60)])
        y = (np.arange(360) >= 300).astype(float)
        slope, shift = toxicity._scale(x, np.arange(360), y, 0.1)
        assert slope > 0 and (((slope * x + shift) > 0) == (y == 1)).all()
    noise = rng.normal(size=400)
    slope, shift = toxicity._scale(noise, np.arange(400), (np.arange(400) % 2).astype(float), 0.1)
    assert (slope * noise + shift).mean() < 0


def test_repeated_ids_give_one_text_each(spark, monkeypatch):
    docs = spark.createDataFrame([(i % 7, f"text {i % 7} {j} " + "w " * 90) for j in range(40) for i in range(7)] + [(1, "x" * 3_000_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(7)], "doc_id long, toxic int")
    given = []
    monkeypatch.setattr(toxicity, "train", lambda windows, *_: given.extend(windows))
    fit(docs, labels)
    kept = {i for i in range(7) if zlib.crc32(str(i).encode()) % 5}
    assert {key for key, _, _ in given} == kept
    assert all(len({tuple(words[:3]) for key, _, words in given if key == i and words[0] == b"text"}) <= 1 for i in kept)


def test_a_text_of_some_megabytes_is_scored_whole():
    model = train([(i, i % 2, [b"grim" if i % 2 else b"kind", b"word"]) for i in range(64)], 0.5, training=Training(epochs=8, batch=8))
    long = "kind word " * 150_000
    a, b = model.scores([long, long[: len(long) // 2] + "grim grim grim " + long])
    assert b > a
