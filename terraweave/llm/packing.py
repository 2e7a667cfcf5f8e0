"""Packing documents into windows of equal length by minimum bin slack.

Texts are encoded and packed where they are read: nothing is shuffled, and a task
holds one pool of tails at a time. A document's whole windows are sequences of their
own; what is left of it, its tail, waits in the pool. A window takes the longest tail
and, by a bitset of the sums that the other lengths can reach, with their counts, the
multiset that comes closest to filling it; back-tracking through the bitsets tells how
many of each length, and the pattern is used as often as the counts allow. Tails that
leave slack wait for the next pool; the last ones are cut to fill their windows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .pieces import PieceTable, binaries, byte_slices, gathered, ids_of_texts, map_in_arrow, ragged
from .tables import spread
from .token_files import ENCODED_BYTES, MOST_PIECES, library

WINDOW = 1024
#: Ids of tails that are packed together.
POOL_IDS = 1 << 20

SCHEMA = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def fill(target: int, counts: dict[int, int]) -> tuple[int, dict[int, int]]:
    """(sum, how many of each length): the sum of given lengths closest below or at `target`.

    Bit s of a bitset tells whether a sum s can be reached. A length with a count is
    added in portions of 1, 2, 4, ... so each bitset differs from the one before by one
    portion taken or not; walking back tells which were.
    """
    reach, mask = 1, (1 << target + 1) - 1
    steps: list[tuple[int, int, int]] = []
    for length in sorted((n for n in counts if n <= target), reverse=True):
        left = min(counts[length], target // length)
        portion = 1
        while left > 0 and not reach >> target & 1:
            portion = min(portion, left)
            steps.append((length, portion, reach))
            reach |= reach << length * portion & mask
            left -= portion
            portion *= 2
        if reach >> target & 1:
            break
    best = at = reach.bit_length() - 1
    need: dict[int, int] = Counter()
    for length, portion, before in reversed(steps):
        if not before >> at & 1:
            need[length] += portion
            at -= length * portion
    return best, need


class Piece(NamedTuple):
    """Ids of document `row` from its id number `start` on."""

    row: object
    start: int
    doc_tokens: int
    ids: np.ndarray

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return self._replace(ids=self.ids[:n]), self._replace(start=self.start + n, ids=self.ids[n:])


@dataclass
class Pool:
    """Tails by length, and the sequences made of them."""

    window: int
    tails: dict[int, list[Piece]] = field(default_factory=dict)
    held: int = 0

    def add(self, piece: Piece) -> None:
        self.tails.setdefault(len(piece.ids), []).append(piece)
        self.held += len(piece.ids)

    def take(self, length: int) -> Piece:
        own = self.tails[length]
        piece = own.pop()
        if not own:
            del self.tails[length]
        self.held -= length
        return piece

    def exact(self) -> Iterator[list[Piece]]:
        """Windows that tails fill without slack; the longest tails that cannot are put aside,
        and are in the pool again at the end."""
        aside: list[Piece] = []
        while self.tails:
            longest = max(self.tails)
            counts = {n: len(own) for n, own in self.tails.items()}
            counts[longest] -= 1
            total, need = fill(self.window - longest, counts)
            need[longest] = need.get(longest, 0) + 1
            if total < self.window - longest:
                aside.extend(self.take(longest) for _ in range(len(self.tails[longest])))
                continue
            for _ in range(min((counts[n] + (n == longest)) // k for n, k in need.items() if k)):
                yield [self.take(n) for n, k in need.items() for _ in range(k)]
        for piece in aside:
            self.add(piece)

    def cut(self, keep: int) -> Iterator[list[Piece]]:
        """Windows of the closest sums, each filled by the head of another tail, until at most
        `keep` ids, or less than a window, are left."""
        while self.held > keep and self.held >= self.window:
            longest = max(self.tails)
            first = self.take(longest)
            total, need = fill(self.window - longest, {n: len(own) for n, own in self.tails.items()})
            made = [first, *(self.take(n) for n, k in need.items() for _ in range(k))]
            gap = self.window - longest - total
            while gap:
                # a length within the gap would have come closer, so the rest are longer
                head = self.take(max(self.tails))
                if len(head.ids) > gap:
                    head, rest = head.cut(gap)
                    self.add(rest)
                made.append(head)
                gap -= len(head.ids)
            yield made

    def end(self) -> Iterator[list[Piece]]:
        """Less than a window, as sequences of lengths that are powers of two: none is padded."""
        left = [self.take(n) for n in sorted(self.tails, reverse=True) for _ in range(len(self.tails[n]))]
        total = sum(len(p.ids) for p in left)
        for bit in range(total.bit_length() - 1, -1, -1):
            room, made = total & 1 << bit, []
            while room:
                head = left.pop(0)
                if len(head.ids) > room:
                    head, rest = head.cut(room)
                    left.insert(0, rest)
                made.append(head)
                room -= len(head.ids)
            if made:
                yield made


def _batch(keys: pa.Array, columns: list[np.ndarray], ids: np.ndarray) -> pa.RecordBatch:
    start, length, doc_tokens, sequence, offset = (np.asarray(c, np.int64) for c in columns)
    arrays = [keys, pa.array(start), pa.array(length), binaries(ids, length, "<u4"), *map(pa.array, (doc_tokens, sequence, offset))]
    return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])


def pack_documents(
    df: DataFrame,
    tokenizer_path: str,
    *,
    end_id: int | None,
    window: int = WINDOW,
    pool_ids: int = POOL_IDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): each piece of each row of `df`.

    `ids` are little-endian unsigned 32-bit integers, the ids `start` to `start + length`
    of the row's `doc_tokens` (its `end_id` included), and lie in their sequence from
    `offset` on. Sequences have `window` ids, but for the last ones of a task, whose
    lengths are powers of two. A null text is empty: it has its `end_id` only, and no
    piece without one. Null and repeated ids are rows like others. A text of any length is
    encoded whole; empty tables give no piece; other columns are not read.
    """
    id_type = df.schema[id_col].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = library(tokenizer_path)
        table = PieceTable(own.encode_pieces, MOST_PIECES)
        tail_id = np.asarray([] if end_id is None else [end_id], np.uint32)
        pool = Pool(window)
        number = TaskContext.get().partitionId() << 32
        key_type: pa.DataType | None = None

        def laid(sequences: Iterator[list[Piece]]) -> Iterator[pa.RecordBatch]:
            nonlocal number
            held: list[tuple[Piece, int, int]] = []
            for made in sequences:
                at = 0
                for piece in made:
                    held.append((piece, number, at))
                    at += len(piece.ids)
                number += 1
                if len(held) >= 10_000:
                    yield rows(held)
                    held = []
            if held:
                yield rows(held)

        def rows(held: list[tuple[Piece, int, int]]) -> pa.RecordBatch:
            columns = np.array([(p.start, len(p.ids), p.doc_tokens, s, o) for p, s, o in held], np.int64).T
            return _batch(pa.array([p.row for p, _, _ in held], key_type), list(columns), np.concatenate([p.ids for p, _, _ in held]))

        for batch in gathered(batches, ENCODED_BYTES):
            key_type = batch.column(0).type
            for at, n in byte_slices(batch.column(1), ENCODED_BYTES):
                ids, counts = ids_of_texts(table, own, batch.column(1).slice(at, n).to_pylist(), ENCODED_BYTES)
                keys = batch.column(0).slice(at, n)
                if len(tail_id):
                    ids = np.insert(ids, np.cumsum(counts), tail_id[0])
                    counts = counts + 1
                begin, whole = np.cumsum(counts) - counts, counts // window
                if whole.any():
                    k = ragged(np.zeros(n, np.int64), whole)  # the window's number in its document
                    doc = np.repeat(np.arange(n), whole)
                    flat = ids[ragged(begin[doc] + k * window, np.full(len(doc), window))]
                    columns = [k * window, np.full(len(doc), window), counts[doc], number + np.arange(len(doc)), np.zeros(len(doc))]
                    number += len(doc)
                    yield _batch(keys.take(pa.array(doc)), columns, flat)
                names = keys.to_pylist()
                for d in np.flatnonzero(counts % window).tolist():
                    start = int(whole[d]) * window
                    own_ids = ids[begin[d] + start : begin[d] + counts[d]].copy()
                    pool.add(Piece(names[d], start, int(counts[d]), own_ids))
                    if pool.held >= pool_ids:
                        yield from laid(pool.exact())
                        yield from laid(pool.cut(pool_ids // 2))
        yield from laid(pool.exact())
        yield from laid(pool.cut(0))
        yield from laid(pool.end())

    texts = spread(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    return map_in_arrow(texts, pack, f"doc_id {id_type}, {SCHEMA}")


def sequences(pieces: DataFrame, *, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """(sequence_id, n_tokens, ids): the sequences of `pack_documents`, as training reads them.

    A sequence is padded to `window` with `pad_id`, but for one whose length is a power
    of two. A group has at most `window` pieces.
    """
    one: Column = F.unhex(F.lit(pad_id.to_bytes(4, "little").hex()))
    lengths = F.sum("length")
    told = pieces.groupBy("sequence_id").agg(
        lengths.alias("n_tokens"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts")
    )
    parts = F.aggregate("parts", F.lit(b""), lambda acc, p: F.concat(acc, p["ids"]))
    padding = F.when(F.bit_count("n_tokens") == 1, 0).otherwise(window - F.col("n_tokens")).cast("int")
    filler = F.aggregate(F.array_repeat(one, padding), F.lit(b""), lambda acc, p: F.concat(acc, p))
    return told.select("sequence_id", "n_tokens", F.concat(parts, filler).alias("ids"))
