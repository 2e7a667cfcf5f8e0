"""Texts as runs of pieces: each distinct piece is encoded once, texts are gathered.

A tokenizer encodes a text piece by piece. Whole batches of texts are cut first,
their pieces numbered by Arrow's dictionary encoding, only pieces that are new to the
worker's table go to the encoder, and the ids of all texts are one numpy gather.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from itertools import repeat
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Bytes of texts that are cut at a time; a longer text is cut in parts of about that.
BATCH_BYTES = 2 << 20
#: Longer texts are encoded in parts of about this many characters.
PART_CHARS = 1 << 20
#: Pieces of a batch that are numbered at a time.
MOST_HELD = 1 << 19
#: Pieces that a table keeps at most, beside those of the batch at hand.
MOST_PIECES = 200_000


def byte_slices(column: pa.Array, most: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """(start, length) of runs of a string column whose bytes come to `most` at most;
    a longer value is a run of its own. Nulls count as empty."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    before = np.concatenate([[0], np.cumsum(sizes)])
    at = 0
    while at < len(sizes):
        to = int(np.searchsorted(before, before[at] + most, side="right")) - 1
        to = min(max(to, at + 1), len(sizes))
        yield at, to - at
        at = to


def gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Batches joined until they come to `most` bytes: the more texts are seen at once, the
    fewer of their pieces are looked up."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= most:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions starts[k], starts[k] + 1, ... (counts[k] of them) for all k."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    place = np.repeat(starts - ends + counts, counts)
    place += np.arange(total)
    return place


class PieceTable:
    """Ids of the pieces met so far, as rows of one flat array.

    `encode` takes distinct pieces and returns their ids, all in one array, and how
    many each has. A table that grows beyond `most` pieces begins anew.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int = MOST_PIECES):
        self.encode, self.most = encode, most
        self.clear()

    def clear(self) -> None:
        self.row: dict[str, int] = {}
        self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def rows(self, distinct: list[str]) -> np.ndarray:
        """The row of each piece; new ones are encoded together."""
        out = np.fromiter(map(self.row.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(out < 0)
        if len(self.row) + len(new) > self.most:
            self.clear()
            new = np.arange(len(distinct))
        if len(new):
            pieces = [distinct[k] for k in new.tolist()]
            ids, counts = self.encode(pieces)
            first = len(self.row)
            out[new] = np.arange(first, first + len(new))
            self.row.update(zip(pieces, range(first, first + len(new)), strict=True))
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(counts) - counts])
            self.count = np.concatenate([self.count, counts])
            self.flat = np.concatenate([self.flat, ids])
        return out

    def ids(self, pieces: list[str] | pa.Array, without: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a run of pieces, and how many each piece has; none for `without`."""
        if not len(pieces):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        coded = (pa.array(pieces, pa.string()) if isinstance(pieces, list) else pieces).dictionary_encode()
        rows = self.rows(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)]
        counts = self.count[rows]
        if without is not None:
            counts[without] = 0
        return self.flat[ragged(self.start[rows], counts)], counts


#: Kinds of bytes: the mark between texts, white space, the blank, letters, digits, others.
_END, _WHITE, _BLANK, _LETTER, _DIGIT, _OTHER = range(6)


def _kinds() -> np.ndarray:
    """The kind of each byte of texts whose characters beyond ASCII are letters."""
    out = np.full(256, _OTHER, np.uint8)
    for byte in range(256):
        if byte >= 0x80 or chr(byte).isalpha():
            out[byte] = _LETTER
        elif chr(byte).isdigit():
            out[byte] = _DIGIT
    out[[0, 0x20]] = _END, _BLANK
    out[list(b"\t\n\r")] = _WHITE
    return out


_KIND = _kinds()


def piece_starts(raw: np.ndarray, *, blank_leads: bool, digits_alone: bool) -> np.ndarray:
    """Where the pieces begin of texts that each end with a zero byte, which is a piece
    of its own; characters beyond ASCII must be letters.

    Pieces are runs of letters, of digits, of white space and of other characters; a
    quote that begins a piece takes an English ending (s, t, m, d, re, ve, ll) with it.
    With `blank_leads` the last white character before something else is apart from
    the run, and if it is a blank, begins the piece that follows.
    """
    kind = _KIND[raw]
    group = np.where(kind == _BLANK, _WHITE, kind)
    start = np.ones(len(raw), bool)
    start[1:] = (group[1:] != group[:-1]) | (kind[1:] == _END)
    if digits_alone:
        start |= kind == _DIGIT
    if blank_leads:
        followed = kind[1:] >= _LETTER
        start[:-1] |= (group[:-1] == _WHITE) & followed
        start[1:] &= ~((kind[:-1] == _BLANK) & followed)
    quote = np.flatnonzero((raw == 0x27) & start)
    one = raw[quote + 1]
    two = raw[np.minimum(quote + 2, len(raw) - 1)]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = ((two == 0x65) & ((one == 0x72) | (one == 0x76))) | ((one == 0x6C) & (two == 0x6C))
    start[quote[short | long] + 1] = False
    start[quote[short] + 2] = True
    start[quote[long] + 3] = True
    return np.flatnonzero(start)


def _ids_of_plain(table: PieceTable, raw: bytes, **style: bool) -> tuple[np.ndarray, np.ndarray]:
    """The ids of texts that each end with a zero byte, and how many each text has."""
    own = np.frombuffer(raw, np.uint8)
    starts = piece_starts(own, **style)
    edges = np.append(starts, len(own)).astype(np.int32)
    pieces = pa.StringArray.from_buffers(len(starts), pa.py_buffer(edges), pa.py_buffer(raw))
    mark = own[starts] == 0
    ids, counts = table.ids(pieces, without=mark)
    ends = np.cumsum(counts)[mark]
    return ids, np.diff(ends, prepend=0)


def _ids_of_cut(
    table: PieceTable, cut: Callable[[str], Iterator[list[str]]], texts: list[str]
) -> tuple[np.ndarray, np.ndarray]:
    flat: list[np.ndarray] = []
    totals = np.zeros(len(texts), np.int64)
    held: list[str] = []
    owners: list[tuple[int, int]] = []

    def flush() -> None:
        ids, counts = table.ids(held)
        ends = np.concatenate([[0], np.cumsum(counts)])
        at = 0
        for text, n in owners:
            totals[text] += ends[at + n] - ends[at]
            at += n
        flat.append(ids)
        held.clear()
        owners.clear()

    for k, text in enumerate(texts):
        for part in cut(text):
            held.extend(part)
            owners.append((k, len(part)))
            if len(held) >= MOST_HELD:
                flush()
    if held:
        flush()
    return np.concatenate(flat) if flat else np.zeros(0, np.uint32), totals


class Splits(Protocol):
    """How a tokenizer's texts fall into pieces.

    `plain` tells whether a text consists of characters that `piece_starts` splits by
    the `style`; `lower` whether it is lower-cased before; `cut` gives the pieces of any
    text; `parts` cuts a long one where no piece goes across. White space that a tokenizer drops has no ids.
    """

    style: dict[str, bool]
    lower: bool

    def plain(self, text: str) -> bool: ...

    def parts(self, text: str, most: int) -> Iterator[str]: ...

    def cut(self, text: str) -> Iterator[list[str]]: ...


def _ids_of_batch(table: PieceTable, splits: Splits, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    simple = np.fromiter(map(splits.plain, texts), bool, len(texts))
    counts = np.zeros(len(texts), np.int64)
    flat: list[np.ndarray] = []
    if simple.any():
        joined = "\0".join([t for t, yes in zip(texts, simple, strict=True) if yes]) + "\0"
        ids, counts[simple] = _ids_of_plain(table, (joined.lower() if splits.lower else joined).encode(), **splits.style)
        flat.append(ids)
    if not simple.all():
        own = [t for t, yes in zip(texts, simple, strict=True) if not yes]
        ids, counts[~simple] = _ids_of_cut(table, splits.cut, own)
        flat.append(ids)
    if len(flat) < 2:
        return flat[0] if flat else np.zeros(0, np.uint32), counts
    order = np.concatenate([np.flatnonzero(simple), np.flatnonzero(~simple)])
    starts = np.zeros(len(texts), np.int64)
    starts[order] = np.cumsum(counts[order]) - counts[order]
    return np.concatenate(flat)[ragged(starts, counts)], counts


def ids_of_texts(
    table: PieceTable, splits: Splits, texts: list[str | None], most: int = BATCH_BYTES
) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts in one array, and how many each text has; a null has none.

    About `most` characters are cut at a time.
    """
    totals = np.zeros(len(texts), np.int64)
    flat: list[np.ndarray] = []
    held: list[str] = []
    owners: list[int] = []
    size = 0
    for k, text in enumerate(texts):
        for part in () if not text else (text,) if len(text) <= PART_CHARS else splits.parts(text, PART_CHARS):
            held.append(part)
            owners.append(k)
            size += len(part)
            if size >= most:
                ids, counts = _ids_of_batch(table, splits, held)
                np.add.at(totals, owners, counts)
                flat.append(ids)
                held, owners, size = [], [], 0
    if held:
        ids, counts = _ids_of_batch(table, splits, held)
        np.add.at(totals, owners, counts)
        flat.append(ids)
    return np.concatenate(flat) if flat else np.zeros(0, np.uint32), totals


def binaries(ids: np.ndarray, counts: np.ndarray, dtype: str) -> pa.Array:
    """Ids of texts as a binary column of fixed-width numbers."""
    data = np.ascontiguousarray(ids, dtype)
    ends = np.concatenate([[0], np.cumsum(counts)]) * data.itemsize
    return pa.Array.from_buffers(
        pa.large_binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)]
    ).cast(pa.binary())


def release() -> None:
    """Give what a finished task held back to the system.

    Spark keeps Python workers for the stages that follow; without this a worker keeps
    the pages of freed tables, and later stages pay for them.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


#: The setting of bytes in an Arrow batch, Spark's default, and what it becomes.
BATCH_SETTING, BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def map_in_arrow(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """`df.mapInArrow`, in batches of about BATCH_BYTES, releasing memory when a task ends.

    Executor and worker both hold a batch, some of it several times, outside the heap.
    Where the session has Spark's default for a batch's bytes it is lowered; a setting
    of one's own stays.
    """
    spark = df.sparkSession
    if spark.conf.get(BATCH_SETTING, BATCH_DEFAULT) == BATCH_DEFAULT:
        spark.conf.set(BATCH_SETTING, f"{BATCH_BYTES}b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for made in work(batches):
                yield made
                # what this batch took is not kept for the next one
                pa.default_memory_pool().release_unused()
        finally:
            release()

    return df.mapInArrow(run, schema)
