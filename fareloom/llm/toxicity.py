"""Toxicity of texts by a bidirectional gated recurrent network with attention pooling.

A word's input is its own vector, if training has met it often enough, beside the mean of the
vectors of its character sequences, so that words never met before are read by their letters.
The network runs over windows of words, forwards and backwards; attention weighs the states, and the
weighted mean gives the window's logit. Windows overlap by half and cover the whole text; the text's
score comes from its highest window, on a scale fitted to the labelled texts.

Training is plain numpy on the driver, on a bounded sample of the labelled texts (``Training``
says how many of each class; the driver holds them, one text for each id). It reads every window of them, but for a share of
texts that is kept for the scale, whose fit reads every window of those. All windows of a clean
text are clean; a toxic text is known to be toxic somewhere, so its windows count by how they
score among each other. Scoring takes every window of every text, on the executors.

Defined results: a NULL text counts as empty; a text without words gets the score of a window
without words. Labels that are NULL don't count, of several for one id the largest does. If the
labels hold one class only or none, every score is the share of 1 among them (0 for none). Of several
texts of one id the last in code-point order is learned from; each gets a score. A text may be as long as memory allows.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.llm.frames import append_column

Params = dict[str, np.ndarray]


@dataclass(frozen=True)
class Shape:
    """Words in a window (half of it new), sizes of the vectors and of the network's states."""

    window: int = 64
    word_size: int = 16
    char_size: int = 16
    states: int = 16
    attention: int = 16
    gram_buckets: int = 1 << 14
    gram_bytes: tuple[int, ...] = (3, 5)


@dataclass(frozen=True)
class Training:
    """The bounds of the sample, and how it is gone through."""

    docs_per_class: int = 1000
    #: One text in so many is not learned from, but sets the scale of the scores.
    scale_share: int = 8
    least_count: int = 3
    most_words: int = 20_000
    epochs: int = 6
    batch: int = 128
    rate: float = 6e-3
    decay: float = 1e-5
    seed: int = 17


# Words and windows


def split_words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().split()


def window_starts(n: int, window: int) -> list[int]:
    """Windows that overlap by half and cover n words; the last one ends with them."""
    if n <= window:
        return [0] if n else []
    starts = list(range(0, n - window, window // 2))
    return [*starts, n - window]


def char_grams(words: list[bytes], shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte sequences of each word (with its ends marked), and how many each has."""
    marked = [b"\x02" + word + b"\x03" for word in words]
    raw = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
    lengths = np.array([len(word) for word in marked], np.int64)
    begins = np.cumsum(lengths) - lengths
    counts = np.zeros(len(words), np.int64)
    owners, buckets = [], []
    for size in shape.gram_bytes:
        own = np.maximum(lengths - size + 1, 0)
        at = np.repeat(begins - (np.cumsum(own) - own), own) + np.arange(own.sum())
        value = np.zeros(len(at), np.uint64)
        for i in range(size):
            value = value << np.uint64(8) | raw[at + i]
        value = (value ^ np.uint64(size) << np.uint64(56)) * np.uint64(0x9E3779B97F4A7C15)
        buckets.append((value >> np.uint64(40)).astype(np.int64) % shape.gram_buckets)
        owners.append(np.repeat(np.arange(len(words)), own))
        counts += own
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(buckets)[order], counts


def _segment_sums(rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive rows, so many for each segment."""
    out = np.zeros((len(counts), rows.shape[1]), rows.dtype)
    some = counts > 0
    if some.any():
        out[some] = np.add.reduceat(rows, (np.cumsum(counts) - counts)[some], axis=0)
    return out


# The network


def first_params(shape: Shape, n_words: int, rng: np.random.Generator) -> Params:
    size, h = shape.word_size + shape.char_size, shape.states

    def normal(*dims: int, scale: float) -> np.ndarray:
        return rng.normal(0, scale, dims).astype(np.float32)

    params = {
        "words": normal(n_words + 1, shape.word_size, scale=0.1),
        "grams": normal(shape.gram_buckets, shape.char_size, scale=0.3),
        "att": normal(2 * h, shape.attention, scale=(2 * h) ** -0.5),
        "att_b": np.zeros(shape.attention, np.float32),
        "att_v": normal(shape.attention, scale=shape.attention**-0.5),
        "out": normal(2 * h, scale=(2 * h) ** -0.5),
        "out_b": np.zeros(1, np.float32),
    }
    params["words"][0] = 0  # words that training has not met
    for way in "fb":
        params |= {
            f"{way}_w": normal(size, 3 * h, scale=size**-0.5),
            f"{way}_b": np.zeros(3 * h, np.float32),
            f"{way}_u": normal(h, 3 * h, scale=h**-0.5),
        }
    return params


def sigmoid(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):  # far out it is 0 or 1
        return 1 / (1 + np.exp(-x))


def _run(gates: np.ndarray, tokens: np.ndarray, u: np.ndarray, lengths: np.ndarray | None, keep: list | None) -> np.ndarray:
    """States (windows, words, both directions' states). ``gates`` has a row per distinct word for each direction.

    Both directions take their steps together, one from the first word on, the other from the last.
    """
    n, steps = tokens.shape
    h = u.shape[1]
    state = np.zeros((2, n, h), gates.dtype)
    out = np.empty((n, steps, 2 * h), gates.dtype)
    given, own = np.empty((2, n, 3 * h), gates.dtype), np.empty((2, n, 3 * h), gates.dtype)
    columns = np.ascontiguousarray(tokens.T)
    for k in range(steps):
        places = (k, steps - 1 - k)
        for way, t in enumerate(places):
            # Words number the rows of ``gates``, so nothing has to be clipped.
            np.take(gates[way], columns[t], axis=0, out=given[way], mode="clip")
        np.matmul(state, u, out=own)
        zr = given[:, :, : 2 * h] + own[:, :, : 2 * h]
        # The logistic function by tanh, in place.
        zr *= 0.5
        np.tanh(zr, out=zr)
        zr += 1
        zr *= 0.5
        z, r = zr[:, :, :h], zr[:, :, h:]
        new = r * own[:, :, 2 * h :]
        new += given[:, :, 2 * h :]
        np.tanh(new, out=new)
        after = state - new
        after *= z
        after += new
        if lengths is not None:
            after = np.where(np.stack([t < lengths for t in places])[:, :, None], after, state)
        if keep is not None:
            keep.append((k, state, z, r, new, own[:, :, 2 * h :].copy()))
        state = after
        out[:, places[0], :h] = state[0]
        out[:, places[1], h:] = state[1]
    return out


def gates_of(params: Params, inputs: np.ndarray) -> np.ndarray:
    """What each distinct word gives to the gates of either direction."""
    return np.stack([inputs @ params[f"{way}_w"] + params[f"{way}_b"] for way in "fb"])


def _both(params: Params) -> np.ndarray:
    return np.stack([params["f_u"], params["b_u"]])


def forward(params: Params, gates: np.ndarray, tokens: np.ndarray, lengths: np.ndarray | None, trace: dict | None = None) -> np.ndarray:
    """The logit of each window. ``gates`` has a row per distinct word, ``tokens`` the rows of each window."""
    kept: list | None = [] if trace is not None else None
    states = _run(gates, tokens, _both(params), lengths, kept)
    hidden = states @ params["att"]
    hidden += params["att_b"]
    np.tanh(hidden, out=hidden)
    score = hidden @ params["att_v"]
    if lengths is not None:
        score = np.where(np.arange(tokens.shape[1]) < lengths[:, None], score, -1e9)
    weight = np.exp(score - score.max(axis=1, keepdims=True))
    weight /= weight.sum(axis=1, keepdims=True)
    pooled = (weight[:, None, :] @ states)[:, 0]
    if trace is not None:
        trace.update(kept=kept, states=states, hidden=hidden, weight=weight, pooled=pooled)
    return pooled @ params["out"] + params["out_b"][0]


def backward(params: Params, inputs: np.ndarray, tokens: np.ndarray, lengths: np.ndarray | None, trace: dict, d_logit: np.ndarray) -> tuple[Params, np.ndarray]:
    """Gradients of the parameters but the vectors, and of ``inputs``."""
    states, hidden, weight, pooled = (trace[name] for name in ("states", "hidden", "weight", "pooled"))
    u = _both(params)
    h, (n, steps) = u.shape[1], tokens.shape
    grads: Params = {"out": pooled.T @ d_logit, "out_b": np.array([d_logit.sum()], np.float32)}
    d_pooled = d_logit[:, None] * params["out"]
    d_states = weight[:, :, None] * d_pooled[:, None, :]
    d_weight = (states @ d_pooled[:, :, None])[:, :, 0]
    d_score = weight * (d_weight - (weight * d_weight).sum(axis=1, keepdims=True))
    d_hidden = d_score[:, :, None] * params["att_v"] * (1 - hidden**2)
    grads["att_v"] = d_score.ravel() @ hidden.reshape(n * steps, -1)
    flat_hidden = d_hidden.reshape(n * steps, -1)
    grads["att"] = states.reshape(n * steps, -1).T @ flat_hidden
    grads["att_b"] = flat_hidden.sum(axis=0)
    d_states += d_hidden @ params["att"].T
    d_state, d_u = np.zeros((2, n, h), states.dtype), np.zeros_like(u)
    d_gates = np.zeros((n, steps, 6 * h), states.dtype)
    turned = u.transpose(0, 2, 1)
    for k, state, z, r, new, own in reversed(trace["kept"]):
        places = (k, steps - 1 - k)
        d_after = d_state + np.stack([d_states[:, places[0], :h], d_states[:, places[1], h:]])
        passed = None
        if lengths is not None:
            inside = np.stack([t < lengths for t in places])[:, :, None]
            passed = np.where(inside, 0, d_after)
            d_after = np.where(inside, d_after, 0)
        d_new = d_after * (1 - z) * (1 - new * new)
        d_zr = np.concatenate([d_after * (state - new), d_new * own], axis=2)
        zr = np.concatenate([z, r], axis=2)
        d_zr *= zr * (1 - zr)
        d_own = np.concatenate([d_zr, d_new * r], axis=2)
        for way, t in enumerate(places):
            d_gates[:, t, 3 * h * way : 3 * h * way + 2 * h] = d_zr[way]
            d_gates[:, t, 3 * h * way + 2 * h : 3 * h * (way + 1)] = d_new[way]
        d_u += state.transpose(0, 2, 1) @ d_own
        d_state = d_after * z + d_own @ turned
        if passed is not None:
            d_state += passed
    order = np.argsort(tokens, axis=None, kind="stable")
    per_word = _segment_sums(d_gates.reshape(n * steps, 6 * h)[order], np.bincount(tokens.ravel(), minlength=len(inputs)))
    d_inputs = np.zeros_like(inputs)
    for i, way in enumerate("fb"):
        own = per_word[:, 3 * h * i : 3 * h * (i + 1)]
        grads |= {f"{way}_u": d_u[i], f"{way}_w": inputs.T @ own, f"{way}_b": own.sum(axis=0)}
        d_inputs += own @ params[f"{way}_w"].T
    return grads, d_inputs


@dataclass
class Model:
    """A trained network: parameters, the words that have vectors, the scale of the scores."""

    shape: Shape
    params: Params
    vocabulary: dict[bytes, int]
    scale: tuple[float, float] = (1.0, 0.0)
    #: Set if there was nothing to learn from: the score of every text.
    constant: float | None = None

    def inputs(self, words: list[bytes]) -> np.ndarray:
        """The input vector of each word."""
        known = np.array([self.vocabulary.get(word, 0) for word in words], np.int64)
        buckets, counts = char_grams(words, self.shape)
        chars = _segment_sums(self.params["grams"][buckets], counts) / np.maximum(counts, 1)[:, None]
        return np.concatenate([self.params["words"][known], chars], axis=1).astype(np.float32)

    def logits(self, texts: list[list[bytes]], most: int = 2048) -> np.ndarray:
        """The highest window logit of each text."""
        window = self.shape.window
        ids: dict[bytes, int] = {}
        tokens = [np.array([ids.setdefault(word, len(ids)) for word in words], np.int32) for words in texts]
        found = np.full(len(texts), -np.inf, np.float32)
        gates = gates_of(self.params, self.inputs([*ids, b""]))
        owner, spans, lengths = [], [], []
        for i, own in enumerate(tokens):
            starts = window_starts(len(own), window) or [0]
            if len(own) >= window:
                spans.append(own[np.array(starts)[:, None] + np.arange(window)])
            else:
                spans.append(np.concatenate([own, np.full(window - len(own), len(ids), np.int32)])[None])
            owner += [i] * len(starts)
            lengths += [min(window, max(1, len(own)))] * len(starts)
        if not spans:
            return found
        rows, owner_of, length_of = np.concatenate(spans), np.array(owner), np.array(lengths)
        for whole in (True, False):
            at = np.flatnonzero((length_of == window) == whole)
            for first in range(0, len(at), most):
                part = at[first : first + most]
                logit = forward(self.params, gates, rows[part], None if whole else length_of[part])
                np.maximum.at(found, owner_of[part], logit)
        return found

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Scores from 0 to 1."""
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        slope, shift = self.scale
        return sigmoid(slope * self.logits([split_words(text) for text in texts]).astype(np.float64) + shift)


# Training


@dataclass
class _Adam:
    rate: float
    step: int = 0
    first: Params = field(default_factory=dict)
    second: Params = field(default_factory=dict)

    def update(self, params: Params, grads: Params) -> None:
        self.step += 1
        norm = float(np.sqrt(sum(float((g**2).sum()) for g in grads.values())))
        shrink = min(1.0, 5.0 / (norm + 1e-9))
        for name, grad in grads.items():
            grad = grad * np.float32(shrink)
            m = self.first.setdefault(name, np.zeros_like(params[name]))
            v = self.second.setdefault(name, np.zeros_like(params[name]))
            m += 0.1 * (grad - m)
            v += 0.01 * (grad**2 - v)
            params[name] -= self.rate * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.99**self.step)) + 1e-6)


def _scatter(rows: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Rows added up by index."""
    order = np.argsort(at, kind="stable")
    return _segment_sums(rows[order], np.bincount(at, minlength=size))


class _Sample:
    """The windows of a sample, with what does not change while a model learns from them."""

    def __init__(self, windows: list[tuple[int, int, list[bytes]]], vocabulary: dict[bytes, int], shape: Shape):
        ids: dict[bytes, int] = {b"": 0}
        self.tokens = np.zeros((len(windows), shape.window), np.int64)
        self.lengths = np.ones(len(windows), np.int64)
        for row, (_, _, words) in enumerate(windows):
            self.tokens[row, : len(words)] = [ids.setdefault(word, len(ids)) for word in words]
            self.lengths[row] = max(1, len(words))
        words = list(ids)
        self.known = np.array([vocabulary.get(word, 0) for word in words], np.int64)
        self.buckets, self.n_grams = char_grams(words, shape)
        self.begins = np.cumsum(self.n_grams) - self.n_grams
        self.full = self.lengths == shape.window

    def batches(self, some: np.ndarray, size: int, rng: np.random.Generator | None = None) -> list[np.ndarray]:
        """Windows of those numbers, full ones apart from shorter ones; shuffled if a generator is given."""
        groups = [some[self.full[some]], some[~self.full[some]]]
        if rng is not None:
            groups = [rng.permutation(group) for group in groups]
        found = [group[at : at + size] for group in groups for at in range(0, len(group), size)]
        return [found[i] for i in rng.permutation(len(found))] if rng is not None else found

    def part(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None, np.ndarray, np.ndarray]:
        """Distinct words of some windows, their rows in each window, lengths (None: full), and the words' sequences."""
        words, rows = np.unique(self.tokens[at], return_inverse=True)
        counts = self.n_grams[words]
        places = np.repeat(self.begins[words] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        lengths = None if self.full[at].all() else self.lengths[at]
        return words, rows.reshape(len(at), -1), lengths, self.buckets[places], counts


def _char_means(params: Params, buckets: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    per = 1 / np.maximum(counts, 1).astype(np.float32)[:, None]
    return _segment_sums(params["grams"][buckets], counts) * per, per


def _window_logits(params: Params, sample: _Sample, some: np.ndarray, most: int = 2048) -> np.ndarray:
    """The logit of some windows, worked out for so many at a time."""
    found = np.full(len(sample.tokens), np.nan)
    for at in sample.batches(some, most):
        words, rows, lengths, buckets, counts = sample.part(at)
        inputs = np.concatenate([params["words"][sample.known[words]], _char_means(params, buckets, counts)[0]], axis=1)
        found[at] = forward(params, gates_of(params, inputs), rows, lengths)
    return found


def _aside(texts: np.ndarray, labels: np.ndarray, share: int) -> np.ndarray:
    """Which windows belong to one text in ``share`` of each class; none if a class has too few texts for that."""
    found = np.zeros(len(texts), bool)
    for label in (0, 1):
        own = np.unique(texts[labels == label])
        if len(own) < 8 * share:
            return np.zeros(len(texts), bool)
        found |= (labels == label) & np.isin(texts, own[::share])
    return found


def _shares(logits: np.ndarray, texts: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """What each window counts: 1 in a clean text, in a toxic one more the higher its logit, 1 on average."""
    _, at, n = np.unique(texts, return_inverse=True, return_counts=True)
    highest = np.full(len(n), -np.inf)
    np.maximum.at(highest, at, logits)
    raised = np.exp(logits - highest[at])
    return np.where(labels == 1, raised * (n / np.bincount(at, raised))[at], 1).astype(np.float32)


def train(windows: list[tuple[int, int, list[bytes]]], prior: float, shape: Shape = Shape(), training: Training = Training()) -> Model:
    """Fits a model to all windows of some texts, as (text, label, words). ``prior`` is the share of label 1 among all texts."""
    counts = Counter(word for _, _, words in windows for word in set(words))
    often = sorted((word for word, n in counts.items() if n >= training.least_count), key=lambda w: (-counts[w], w))
    vocabulary = {word: i for i, word in enumerate(often[: training.most_words], 1)}
    rng = np.random.default_rng(training.seed)
    model = Model(shape, first_params(shape, len(vocabulary), rng), vocabulary)
    params = model.params
    labels = np.array([label for _, label, _ in windows], np.float32)
    if len(set(labels.tolist())) < 2:
        model.constant = float(prior)
        return model
    optimizer = _Adam(training.rate)
    texts = np.array([text for text, _, _ in windows], np.int64)
    sample = _Sample(windows, vocabulary, shape)
    # Some texts of each class are kept for the scale: those that were learned from look surer than new ones.
    aside = _aside(texts, labels, training.scale_share)
    learned = np.flatnonzero(~aside)
    share, seen = np.ones(len(windows), np.float32), np.zeros(len(windows))
    for epoch in range(training.epochs):
        optimizer.rate = training.rate * (1 - epoch / training.epochs)
        if epoch:
            # By the logits that the last epoch has met on its way.
            share[learned] = _shares(seen[learned], texts[learned], labels[learned])
        for part in sample.batches(learned, training.batch, rng):
            words, tokens, lengths, buckets, counts = sample.part(part)
            known = sample.known[words]
            # Some known words are read by their letters alone, so that the letters are learned too.
            known[rng.random(len(known)) < 0.3] = 0
            chars, per = _char_means(params, buckets, counts)
            inputs = np.concatenate([params["words"][known], chars], axis=1)
            trace: dict = {}
            logit = forward(params, gates_of(params, inputs), tokens, lengths, trace)
            seen[part] = logit
            d_logit = (share[part] * (sigmoid(logit) - labels[part]) / len(part)).astype(np.float32)
            grads, d_inputs = backward(params, inputs, tokens, lengths, trace, d_logit)
            grads["words"] = _scatter(d_inputs[:, : shape.word_size], known, len(vocabulary) + 1)
            grads["words"][0] = 0
            spread = np.repeat(d_inputs[:, shape.word_size :] * per, counts, axis=0)
            grads["grams"] = _scatter(spread, buckets, shape.gram_buckets)
            for name in grads:
                grads[name] = grads[name] + training.decay * params[name]
            optimizer.update(params, grads)
    at = np.flatnonzero(aside if aside.any() else ~aside)
    model.scale = _scale(_window_logits(params, sample, at)[at], texts[at], labels[at], prior)
    return model


def _scale(logits: np.ndarray, texts: np.ndarray, labels: np.ndarray, prior: float) -> tuple[float, float]:
    """Logistic regression of the label on a text's highest logit, classes weighted as among all texts."""
    best: dict[int, tuple[float, int]] = {}
    for text, label, logit in zip(texts.tolist(), labels.tolist(), logits.tolist(), strict=True):
        best[text] = max(best.get(text, (-np.inf, label)), (logit, label))
    x, y = (np.array(column, np.float64) for column in zip(*best.values(), strict=True))
    weight = np.where(y == 1, prior / max(y.mean(), 1e-9), (1 - prior) / max(1 - y.mean(), 1e-9))
    # In units in which the classes' means are at -1 and 1, so that one pull suits all models.
    means = [x[y == label].mean() for label in (0, 1)]
    middle, unit = sum(means) / 2, max((means[1] - means[0]) / 2, 1e-3)
    x = (x - middle) / unit
    at = np.array([1.0, 0.0])

    def loss(at: np.ndarray) -> float:
        return float((weight * np.logaddexp(0, np.where(y == 1, -1, 1) * (at[0] * x + at[1]))).sum() + 0.05 * at[0] ** 2)

    for _ in range(100):  # Newton's method; a step that does not help is halved
        p = sigmoid(at[0] * x + at[1])
        error, curve = weight * (p - y), weight * p * (1 - p)
        gradient = np.array([(error * x).sum() + 0.1 * at[0], error.sum()])
        hessian = np.array([[(curve * x * x).sum() + 0.1, (curve * x).sum()], [(curve * x).sum(), curve.sum() + 1e-9]])
        change = np.linalg.solve(hessian, gradient)
        while np.abs(change).max() > 1e-9 and loss(at - change) > loss(at):
            change /= 2
        at = at - change
        if np.abs(change).max() <= 1e-9:
            break
    slope = max(at[0], 1e-3) / unit
    return float(slope), float(at[1] - slope * middle)


def held_out(key: str = "doc_id") -> Column:
    """Whether a row's label is kept out of training: a fifth of the ids. A NULL id counts as 0."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", shape: Shape = Shape(), training: Training = Training()) -> Model:
    """A model fitted to a bounded sample of the texts whose label may be learned from."""
    usable = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(key))
    known = usable.groupBy(F.col(key).cast("long").alias("_id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    shares = {row["label"]: row["n"] for row in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = shares.get(1, 0) / max(1, sum(shares.values()))
    # At most docs_per_class ids of each class: a bound that does not depend on the data.
    by_hash = [F.xxhash64("_id", F.lit(training.seed)), F.col("_id")]
    picked = [known.where(F.col("label") == y).orderBy(*by_hash).limit(training.docs_per_class) for y in (0, 1)]
    sample = F.broadcast(picked[0].unionAll(picked[1]))
    texts = docs.select(F.col(key).cast("long").alias("_id"), F.col(text).cast("string").alias("_text")).join(sample, "_id")
    # One text for each picked id, so the sample has at most twice docs_per_class rows, however often an id is repeated.
    rows = texts.groupBy("_id", "label").agg(F.max("_text").alias("text")).collect()
    windows = []
    for row in sorted(rows):
        words = split_words(row.text)
        windows += [(row["_id"], row.label, words[at : at + shape.window]) for at in window_starts(len(words), shape.window)]
    return train(windows, prior, shape, training)


def with_score(df: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``df`` with the score of a text column."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # its size is set by Shape and Training

    def run(texts: pa.Array) -> pa.Array:
        found, held, size = [], [], 0
        for one in texts.to_pylist():
            held.append(one)
            size += len(one or "")
            if size >= 1 << 19:
                found.append(shared.value.scores(held))
                held, size = [], 0
        found.append(shared.value.scores(held))
        return pa.array(np.concatenate(found))

    return append_column(df, text, name, T.DoubleType(), run)
