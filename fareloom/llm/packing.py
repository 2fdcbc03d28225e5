"""Hierarchical packing of token ids into sequences of several lengths.

Every document is cut into full windows of the largest context and a rest. A rest goes to the
smallest context size (tier) that holds it. Then the tiers are packed from the largest down:
a window starts with one rest of its tier, and its gap is filled with the longest rests of
shorter tiers that fit; what is left of the gap takes a slice of a shorter rest (or of the next
of the same tier), whose remainder goes to the tier it now belongs to. So every sequence is
full. Rests that are too few to fill any window are put together at the end and cut into powers
of two. Padding is therefore none: a sequence is as long as the largest context or a power of
two.

Each task packs the rows of its own partition, a bounded number of tokens at a time, and hands
on what could not be filled to its next round; nothing is shuffled. Sequence ids hold the task's
number and a running number. Step groups of about ``group_tokens`` tokens each are balanced within a
round: sequences go, longest first, to the group that has the fewest tokens so far.

Defined results: NULL ids count as none; a document always ends in the end token, so each has at
least one piece. Rows are independent, so repeated rows and ids are packed as often as they
come; other columns play no part.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right, insort
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.llm.bpe import ID_BYTES
from fareloom.llm.frames import batch_of, slices

_POSITION_BITS = 33

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("sequence_tokens", T.LongType()),
        T.StructField("step_group", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Tiers:
    """Context sizes, powers of two in ascending order; tokens in a step group and in a task's round."""

    sizes: tuple[int, ...] = (128, 256, 512, 1024, 2048)
    group_tokens: int = 1 << 17
    round_tokens: int = 1 << 20

    def __post_init__(self):
        if not self.sizes or any(size < 1 or size & size - 1 for size in self.sizes) or list(self.sizes) != sorted(set(self.sizes)):
            raise ValueError("context sizes are powers of two in ascending order")

    def tier(self, length: int) -> int:
        """The place of the smallest context that holds so many tokens."""
        return next(i for i, size in enumerate(self.sizes) if length <= size)


@dataclass(order=True, frozen=True, slots=True)
class Piece:
    """Part of a document; the order is by length, then by the order of arrival."""

    length: int
    doc: int
    start: int

    def cut(self, length: int) -> tuple[Piece, Piece]:
        return Piece(length, self.doc, self.start), Piece(self.length - length, self.doc, self.start + length)


class _Packer:
    """Rests by tier, each tier in ascending order of length."""

    def __init__(self, tiers: Tiers):
        self.tiers = tiers
        self.rests: list[list[Piece]] = [[] for _ in tiers.sizes]
        self.done: list[list[Piece]] = []

    def add(self, doc: int, tokens: int) -> None:
        largest = self.tiers.sizes[-1]
        full = tokens // largest * largest
        self.done += [[Piece(largest, doc, start)] for start in range(0, full, largest)]
        if full < tokens:
            self._put(Piece(tokens - full, doc, full))

    def _put(self, piece: Piece) -> None:
        insort(self.rests[self.tiers.tier(piece.length)], piece)

    def _longest_within(self, gap: int, below: int) -> Piece | None:
        """Takes the longest rest of at most ``gap`` tokens from the tiers under ``below``."""
        for rests in reversed(self.rests[:below]):
            at = bisect_right(rests, gap, key=lambda piece: piece.length)
            if at:
                return rests.pop(at - 1)
        return None

    def _any_longer(self, gap: int, upto: int) -> Piece | None:
        """Takes the shortest rest that is longer than the gap, from the tiers up to ``upto``."""
        for rests in self.rests[: upto + 1]:
            at = bisect_right(rests, gap, key=lambda piece: piece.length)
            if at < len(rests):
                return rests.pop(at)
        return None

    def pack(self) -> None:
        """Full sequences as far as the rests go, from the largest tier down."""
        for tier in reversed(range(len(self.tiers.sizes))):
            size = self.tiers.sizes[tier]
            while self.rests[tier]:
                sequence = [self.rests[tier].pop()]
                gap = size - sequence[0].length
                while gap:
                    piece = self._longest_within(gap, tier)
                    if piece is None:
                        longer = self._any_longer(gap, tier)
                        if longer is None:
                            break
                        piece, rest = longer.cut(gap)
                        self._put(rest)
                    sequence.append(piece)
                    gap -= piece.length
                if gap:  # what is left is too little; it stays for the next round
                    for piece in sequence:
                        self._put(piece)
                    break
                self.done.append(sequence)

    def finish(self) -> None:
        """The rests that are left, put together and cut into powers of two."""
        left = [piece for rests in self.rests for piece in reversed(rests)]
        self.rests = [[] for _ in self.tiers.sizes]
        tokens = sum(piece.length for piece in left)
        while tokens:
            size = min(self.tiers.sizes[-1], 1 << tokens.bit_length() - 1)
            sequence, gap = [], size
            while gap:
                piece = left.pop(0)
                if piece.length > gap:
                    piece, rest = piece.cut(gap)
                    left.insert(0, rest)
                sequence.append(piece)
                gap -= piece.length
            self.done.append(sequence)
            tokens -= size


def balanced_groups(lengths: list[int], group_tokens: int) -> list[int]:
    """A group for each sequence, so that the groups' tokens differ by one sequence at most."""
    groups = max(1, round(sum(lengths) / group_tokens))
    loads = [(0, group) for group in range(groups)]
    found = [0] * len(lengths)
    for at in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        load, group = loads[0]
        heapq.heapreplace(loads, (load + lengths[at], group))
        found[at] = group
    return found


def _packing(tiers: Tiers, end_id: int):
    end = end_id.to_bytes(ID_BYTES, "little")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << _POSITION_BITS
        sequences = groups = arrived = 0
        packer = _Packer(tiers)
        docs: dict[int, tuple[int | None, bytes]] = {}
        tokens = 0

        def flush(last: bool) -> pa.RecordBatch:
            nonlocal sequences, groups, docs, tokens, packer
            packer.pack()
            if last:
                packer.finish()
            out: dict[str, list] = {name: [] for name in PIECES.names}
            lengths = [sum(p.length for p in sequence) for sequence in packer.done]
            group_of = balanced_groups(lengths, tiers.group_tokens)
            for sequence, length, group in zip(packer.done, lengths, group_of, strict=True):
                offset = 0
                for piece in sequence:
                    key, ids = docs[piece.doc]
                    out["doc_id"].append(key)
                    out["start"].append(piece.start)
                    out["length"].append(piece.length)
                    out["ids"].append(ids[piece.start * ID_BYTES : (piece.start + piece.length) * ID_BYTES])
                    out["doc_tokens"].append(len(ids) // ID_BYTES)
                    out["sequence_id"].append(base + sequences)
                    out["offset"].append(offset)
                    out["sequence_tokens"].append(length)
                    out["step_group"].append(base + groups + group)
                    offset += piece.length
                sequences += 1
            groups += max(group_of, default=-1) + 1
            waiting = {piece.doc for rests in packer.rests for piece in rests}
            docs = {doc: held for doc, held in docs.items() if doc in waiting}
            packer.done, tokens = [], 0
            return batch_of(out, PIECES)

        for part in (part for batch in batches for part in slices(batch, "_ids")):
            for key, ids in zip(part.column("_id").to_pylist(), part.column("_ids").to_pylist(), strict=True):
                docs[arrived] = (key, (ids or b"") + end)
                packer.add(arrived, len(docs[arrived][1]) // ID_BYTES)
                tokens += len(docs[arrived][1]) // ID_BYTES
                arrived += 1
                if tokens >= tiers.round_tokens:
                    yield flush(False)
        yield flush(True)

    return run


def pack(df: DataFrame, end_id: int, key: str = "doc_id", ids: str = "ids", tiers: Tiers = Tiers()) -> DataFrame:
    """Pieces of the packed ids of ``df``, each with its sequence and its offset there.

    ``ids`` holds packed ids as ``bpe.encode`` makes them; the pieces carry theirs likewise.
    """
    rows = df.select(F.col(key).cast("long").alias("_id"), F.col(ids).alias("_ids"))
    return rows.mapInArrow(_packing(tiers, end_id), PIECES)
