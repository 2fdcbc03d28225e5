"""Byte-level BPE: encoding by batched merge rounds, decoding by gathering token bytes.

The merge rounds work on the symbols of many words at once, held in one flat array: every
round finds each word's lowest-ranked adjacent pair (ranks come from a binary search over
the sorted pair keys), merges all its places from left to right and closes the gaps. Words
that have no pair left leave the array. Words met before come from a bounded cache.

Token ids travel as one binary per text, unsigned 32-bit little-endian, so that lengths,
slices and checksums of them are built-in Spark expressions.

Defined results: a NULL or empty text has no ids (an empty binary), NULL or empty ids decode
to the empty text. Special tokens of the vocabulary are recognised in the text, as the
vocabulary says. Rows are neither dropped nor merged, other columns pass through untouched.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.llm.frames import append_column

ID_BYTES = 4
# Memory bounds of a worker, not of the data: what does not fit is worked out again.
CACHED_WORDS = 400_000
CHARS_AT_ONCE = 1 << 18
# Longer words are worked out each time.
WORD_BYTES = 16

_NO_RANK = np.int32(np.iinfo(np.int32).max)
_LETTER, _NUMBER, _SPACE, _OTHER = 1, 2, 3, 0
# The endings that are words of their own after an apostrophe.
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def byte_alphabet() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary file.

    Bytes that print stand for themselves, the others for the letters from U+0100 on.
    """
    printing = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = sorted(set(range(256)) - set(printing))
    letters = {byte: chr(byte) for byte in printing} | {byte: chr(256 + i) for i, byte in enumerate(others)}
    return [letters[byte] for byte in range(256)]


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Letter, number, white space or other, for every code point."""
    table = np.zeros(0x110000, np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))[0]
        table[code] = _LETTER if kind == "L" else _NUMBER if kind == "N" else _OTHER
    for found in regex.finditer(r"\p{White_Space}", "".join(map(chr, range(0x3100)))):
        table[found.start()] = _SPACE
    return table


def word_starts(codes: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where words start in the code points of several texts put together.

    A word is a run of letters, of numbers or of other signs, with one blank before it if
    there is one; or white space; or an apostrophe with one of the endings. White space
    before a word leaves its last character to it.
    """
    kind = _classes()[codes]
    space = kind == _SPACE
    first = np.zeros(len(codes) + 1, bool)
    first[text_starts] = True
    before = np.empty_like(kind)
    before[0], before[1:] = 255, kind[:-1]
    blank_before = np.zeros(len(codes), bool)
    blank_before[1:] = codes[:-1] == 0x20
    last_space = np.zeros(len(codes), bool)
    last_space[:-1] = space[:-1] & ~space[1:]
    last_space &= ~first[1:]
    start = np.where(space, (before != _SPACE) | last_space, (kind != before) & ~blank_before)
    start[text_starts] = True
    marks = np.flatnonzero((codes == ord("'")) & start)
    if len(marks):
        padded = np.concatenate([codes, np.zeros(3, codes.dtype)])
        edge = np.concatenate([first, np.ones(3, bool)])
        for ending in _ENDINGS:
            found = np.ones(len(marks), bool)
            for i, letter in enumerate(ending, 1):
                found &= (padded[marks + i] == ord(letter)) & ~edge[marks + i]
            at = marks[found]
            start[at + 1] = False
            after = at + 1 + len(ending)
            start[after[after < len(codes)]] = True
    return np.flatnonzero(start)


class Vocabulary:
    """A byte-level BPE vocabulary: symbols of the bytes, merges by pair key, bytes of the tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model = told["model"]
        byte_of = {letter: byte for byte, letter in enumerate(byte_alphabet())}
        names: dict[str, int] = model["vocab"]
        self.special = {token["content"]: token["id"] for token in told.get("added_tokens", [])}
        size = max([*names.values(), *self.special.values()]) + 1
        spelled = [b""] * size
        for name, token in names.items():
            spelled[token] = bytes(byte_of[letter] for letter in name)
        for name, token in self.special.items():
            spelled[token] = name.encode()
        self.token_bytes = np.frombuffer(b"".join(spelled), np.uint8)
        self.token_lengths = np.array([len(x) for x in spelled], np.int64)
        self.token_offsets = np.concatenate([[0], np.cumsum(self.token_lengths)[:-1]])
        self.byte_ids = np.array([names[letter] for letter in byte_alphabet()], np.int32)
        merges = [merge if isinstance(merge, list) else merge.split(" ") for merge in model["merges"]]
        left = np.array([names[a] for a, _ in merges], np.int64)
        right = np.array([names[b] for _, b in merges], np.int64)
        made = np.array([names[a + b] for a, b in merges], np.int64)
        # A round merges all places of a word's best pair: right as long as what a merge
        # makes is used by later merges only.
        born = np.full(size, -1, np.int64)
        born[made[::-1]] = np.arange(len(merges))[::-1]
        if (np.maximum(born[left], born[right]) >= np.arange(len(merges))).any():
            raise ValueError("a merge uses a symbol that a later merge makes")
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_ranks = keys[order], order.astype(np.int32)
        self.made = made.astype(np.int32)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, the largest number for none."""
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], _NO_RANK)

    def encode_words(self, words: Sequence[bytes]) -> list[bytes]:
        """The ids of each word as packed binary. Words must not be empty."""
        done: list[bytes] = [b""] * len(words)
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.byte_ids[raw]
        lengths = np.array([len(word) for word in words])
        word_of = np.arange(len(words))  # of each segment of the array
        starts = np.cumsum(lengths) - lengths
        rank = np.full(len(symbols), _NO_RANK)
        rank[:-1] = self.ranks(symbols[:-1], symbols[1:])
        rank[starts + lengths - 1] = _NO_RANK
        while len(symbols):
            best = np.minimum.reduceat(rank, starts)
            over = best == _NO_RANK
            if over.any():
                ended = np.repeat(over, lengths)
                ids, at = symbols[ended].astype("<u4").tobytes(), 0
                for word, size in zip(word_of[over].tolist(), (lengths[over] * ID_BYTES).tolist(), strict=True):
                    done[word] = ids[at : at + size]
                    at += size
                symbols, rank = symbols[~ended], rank[~ended]
                lengths, word_of, best = lengths[~over], word_of[~over], best[~over]
                starts = np.cumsum(lengths) - lengths
                if not len(symbols):
                    break
            chosen = rank == np.repeat(best, lengths)
            # In a run of one symbol the places overlap: every second one counts, from the left.
            follows = chosen[1:] & chosen[:-1]
            if follows.any():
                place = np.arange(len(symbols))
                run = np.maximum.accumulate(np.where(np.concatenate([[True], ~follows]), place, 0))
                chosen &= (place - run) % 2 == 0
            at = np.flatnonzero(chosen)
            symbols[at] = self.made[rank[at]]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            symbols, rank = symbols[stay], rank[stay]
            lengths = np.add.reduceat(stay, starts, dtype=np.int64)
            starts = np.cumsum(lengths) - lengths
            at -= np.arange(len(at))  # each merge before has closed one gap
            last = np.zeros(len(symbols) + 1, bool)
            last[starts + lengths - 1] = True
            rank[at] = _NO_RANK
            stale = np.concatenate([at, at[at > 0] - 1])
            stale = stale[~last[stale]]
            rank[stale] = self.ranks(symbols[stale], symbols[stale + 1])
        return done

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens put together."""
        lengths = self.token_lengths[ids]
        total = int(lengths.sum())
        ends = np.cumsum(lengths)
        at = np.repeat(self.token_offsets[ids] - (ends - lengths), lengths) + np.arange(total)
        return self.token_bytes[at].tobytes()


class WordTable:
    """Ids of the words met so far: an open hash table over words of up to 16 bytes.

    A word's key is its bytes in two numbers, filled up with zeros, so different words of
    one table have different keys (no word in it holds a zero byte).
    """

    _LOW = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
    _FREE = -1

    def __init__(self, slots_log2: int = 20):
        self.shift = np.uint64(64 - slots_log2)
        self.slots = 1 << slots_log2
        self.clear()

    def clear(self) -> None:
        self.place = np.full(self.slots, self._FREE, np.int32)
        self.low, self.high = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.starts, self.sizes, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")

    def __len__(self) -> int:
        return len(self.low)

    @classmethod
    def keys(cls, raw: bytes, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both numbers of each word of up to 16 bytes."""
        padded = raw + bytes(WORD_BYTES)
        eights = np.ndarray((len(raw) + 9,), "<u8", padded, 0, (1,))
        low = eights[starts] & cls._LOW[np.minimum(lengths, 8)]
        return low, eights[np.minimum(starts + 8, len(raw))] & cls._LOW[np.clip(lengths - 8, 0, 8)]

    def _slot(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        mixed = (low ^ (high * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
        return ((mixed ^ mixed >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The entry of each key, or -1."""
        slot = self._slot(low, high)
        entry = self.place[slot]
        if not len(self):
            return entry
        searched = np.flatnonzero((entry >= 0) & ((self.low[entry] != low) | (self.high[entry] != high)))
        while len(searched):
            slot[searched] = (slot[searched] + 1) % self.slots
            entry[searched] = found = self.place[slot[searched]]
            other = (found >= 0) & ((self.low[found] != low[searched]) | (self.high[found] != high[searched]))
            searched = searched[other]
        return entry

    def add(self, low: np.ndarray, high: np.ndarray, ids: Sequence[bytes]) -> None:
        """Enter keys that are not there yet, each once, with their packed ids."""
        entry = np.arange(len(self), len(self) + len(low), dtype=np.int32)
        sizes = np.array([len(x) // ID_BYTES for x in ids], np.int64)
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(ids), "<u4")])
        self.low, self.high = np.concatenate([self.low, low]), np.concatenate([self.high, high])
        slot = self._slot(low, high)
        while len(entry):
            free = self.place[slot] == self._FREE
            self.place[slot[free]] = entry[free]
            lost = self.place[slot] != entry
            entry, slot = entry[lost], (slot[lost] + 1) % self.slots


class Codec:
    """Texts to packed ids and back, with a bounded table of words."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.table = WordTable()
        self.marks = regex.compile("(" + "|".join(map(regex.escape, vocabulary.special)) + ")")

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Packed ids of each text, a bounded number of characters at a time."""
        held: list[str] = []
        chars = 0
        for text in texts:
            held.append(text or "")
            chars += len(held[-1])
            if chars >= CHARS_AT_ONCE:
                yield from self._encode(held)
                held, chars = [], 0
        yield from self._encode(held)

    def _encode(self, texts: list[str]) -> list[bytes]:
        special = self.vocabulary.special
        if not any(mark in text for text in texts for mark in special):
            return self._encode_plain(texts)
        parts = [self.marks.split(text) for text in texts]
        plain = iter(self._encode_plain([part for text in parts for part in text if part not in special]))
        return [
            b"".join(special[part].to_bytes(ID_BYTES, "little") if part in special else next(plain) for part in text)
            for text in parts
        ]

    def _encode_plain(self, texts: list[str]) -> list[bytes]:
        whole = "".join(texts)
        if not whole:
            return [b""] * len(texts)
        codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(text) for text in texts])
        text_starts = np.unique(np.concatenate([[0], ends[ends < len(codes)]]))
        starts = word_starts(codes, text_starts)
        raw = whole.encode()
        if len(raw) == len(codes):
            cuts = starts
        else:
            width = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
            cuts = (np.cumsum(width) - width)[starts]
        sizes, ids = self._words(raw, cuts, np.diff(np.append(cuts, len(raw))))
        token_ends = np.concatenate([[0], np.cumsum(sizes)])
        until = (token_ends[np.searchsorted(starts, ends)] * ID_BYTES).tolist()
        packed = ids.tobytes()
        return [packed[a:b] for a, b in zip([0, *until], until, strict=False)]

    def _words(self, raw: bytes, cuts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and the ids of all words in order."""
        short = lengths <= WORD_BYTES
        if b"\0" in raw:
            short &= np.add.reduceat(np.frombuffer(raw, np.uint8) == 0, cuts) == 0
        words = self.table
        if len(words) > CACHED_WORDS:
            words.clear()
        low, high = words.keys(raw, cuts[short], lengths[short])
        entry = words.find(low, high)
        new = np.flatnonzero(entry < 0)
        if len(new):
            order = new[np.lexsort((high[new], low[new]))]
            first = np.concatenate([[True], (np.diff(low[order]) != 0) | (np.diff(high[order]) != 0)])
            once = order[first]
            spans = zip(cuts[short][once].tolist(), lengths[short][once].tolist(), strict=True)
            made = self.vocabulary.encode_words([raw[a : a + n] for a, n in spans])
            known = len(words)
            words.add(low[once], high[once], made)
            entry[order] = known + np.cumsum(first) - 1
        starts, sizes, pool = np.zeros(len(cuts), np.int64), np.zeros(len(cuts), np.int64), words.ids
        starts[short], sizes[short] = words.starts[entry], words.sizes[entry]
        if not short.all():
            spans = zip(cuts[~short].tolist(), lengths[~short].tolist(), strict=True)
            made = self.vocabulary.encode_words([raw[a : a + n] for a, n in spans])
            long = np.array([len(x) // ID_BYTES for x in made], np.int64)
            starts[~short], sizes[~short] = len(pool) + np.cumsum(long) - long, long
            pool = np.concatenate([pool, np.frombuffer(b"".join(made), "<u4")])
        ends = np.cumsum(sizes)
        return sizes, pool[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1])]

    def decode(self, packed: Sequence[bytes | None]) -> list[str]:
        """The text of each packed binary; bytes that are no UTF-8 become U+FFFD."""
        return [
            self.vocabulary.decode(np.frombuffer(ids, "<u4").astype(np.int64)).decode("utf-8", "replace") if ids else ""
            for ids in packed
        ]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker process and vocabulary file."""
    return Codec(Vocabulary(path))


def encode(df: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the packed token ids of a text column as a further binary column."""

    def run(texts: pa.Array) -> pa.Array:
        return pa.array(list(codec(vocabulary).encode(texts.to_pylist())), pa.binary())

    return append_column(df, text, ids, T.BinaryType(), run)


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of a packed id column as a further string column."""

    def run(packed: pa.Array) -> pa.Array:
        return pa.array(codec(vocabulary).decode(packed.to_pylist()), pa.string())

    return append_column(df, ids, text, T.StringType(), run)


def n_tokens(ids: str | Column = "ids") -> Column:
    """How many ids a packed binary holds."""
    packed = F.col(ids) if isinstance(ids, str) else ids
    return (F.octet_length(packed) / ID_BYTES).cast("long")


def unpack(df: DataFrame, ids: str = "ids", out: str = "id_list") -> DataFrame:
    """``df`` with packed ids as an array of longs."""

    def run(packed: pa.Array) -> pa.Array:
        return pa.array([np.frombuffer(x or b"", "<u4").astype(np.int64) for x in packed.to_pylist()], pa.list_(pa.int64()))

    return append_column(df, ids, out, T.ArrayType(T.LongType()), run)
