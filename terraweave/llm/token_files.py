"""Token-id files of fixed-width packed bits.

A folder holds one Parquet file per shard; a row is a block: whole documents whose
ids, in ascending document order, are packed at the vocabulary's least number of
bits, most significant bit first. The block's row carries the offsets of its
documents, so numpy unpacks a block at once, and a reader finds a document by its
block's first and last id without touching other blocks. Writing goes through
Spark's committer, so a lost executor leaves no half-written shard.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .pieces import PieceTable, binaries, byte_slices, gathered, ids_of_texts, map_in_arrow, ragged
from .textcut import keys_of, spelled
from .textcut import parts as parts_of

BLOCK_IDS = 1 << 16
#: Pieces in one call of the library.
JOINED = 256
#: Bytes of texts that are encoded at a time, and pieces that a task keeps: the library is
#: the cost here, so more of both than elsewhere.
ENCODED_BYTES = 8 << 20
MOST_PIECES = 400_000
#: Fixed value: the character that stands for a blank in byte-level vocabularies.
BLANK = "\u0120"
#: Texts of a shard in bytes, about; beyond MOST_SHARDS shards they are larger. Shard
#: bases are broadcast: a row of 16 bytes for each shard, of which RANGES more come at most.
SHARD_BYTES = 1 << 23
MOST_SHARDS = 100_000
#: Estimates from here on mean that the optimizer does not know.
UNKNOWN_BYTES = 1 << 56
#: Ranges of ids that are looked for at most; further shards cut them into equal widths.
RANGES = 1000

BLOCK_SCHEMA = (
    "shard long, block long, bits int, n_ids long, first_doc long, last_doc long, "
    "doc_ids array<long>, doc_starts array<long>, doc_lengths array<long>, payload binary"
)


def bits_for(vocabulary_size: int) -> int:
    """The least width that holds every id below `vocabulary_size`."""
    if vocabulary_size < 1:
        raise ValueError("a vocabulary has one id at least")
    return max(1, (vocabulary_size - 1).bit_length())


#: Widths of whole bytes: numpy's big-endian integers are the packed form already.
_WHOLE = {8: ">u1", 16: ">u2", 32: ">u4"}


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Ids at `bits` bits each, the last byte filled with zero bits."""
    wide = np.ascontiguousarray(ids, dtype=">u4")
    if len(wide) and int(wide.max()) >> bits:
        raise ValueError(f"an id does not fit {bits} bits")
    if bits in _WHOLE:
        return wide.astype(_WHOLE[bits]).tobytes()
    each = np.unpackbits(wide.view(np.uint8)).reshape(-1, 32)[:, 32 - bits :]
    return np.packbits(each).tobytes()


def unpack_bits(payload: bytes, bits: int, n: int, first: int = 0) -> np.ndarray:
    """`n` ids from position `first`, reading only the bytes that hold them."""
    if bits in _WHOLE:
        return np.frombuffer(payload, _WHOLE[bits], n, first * bits // 8).astype(np.uint32)
    low, high = first * bits, (first + n) * bits
    raw = np.frombuffer(payload, np.uint8, count=-(-high // 8) - low // 8, offset=low // 8)
    each = np.unpackbits(raw)[low % 8 : low % 8 + n * bits].reshape(n, bits)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, 32 - bits :] = each
    return np.packbits(wide, axis=1).view(">u4").reshape(n).astype(np.uint32)


def _ranges(chars: list[int]) -> str:
    """Sorted code points as the inside of a character class."""
    own = np.array(chars)
    first = np.concatenate([[True], np.diff(own) > 1])
    last = np.concatenate([first[1:], [True]])
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in zip(own[first], own[last], strict=True))


@lru_cache(maxsize=1)
def _byte_level() -> tuple[re.Pattern, re.Pattern, re.Pattern]:
    """(texts that are split here, the byte-level splitter over them, a blank and a word).

    Only characters whose major class has been the same since Unicode 3.2 count, so
    the library's tables, of whatever version, name the same one.
    """
    kinds: dict[str, list[int]] = {"L": [], "N": [], "other": []}
    for c in range(0x10000):
        kind = unicodedata.category(chr(c))[0]
        if kind in "LNMPS" and kind == unicodedata.ucd_3_2_0.category(chr(c))[0]:
            kinds[kind if kind in "LN" else "other"].append(c)
    letter, number, other = map(_ranges, kinds.values())
    white = " \\t\\n\\r\\u00a0\\u3000"
    split = f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[{other}]+|[{white}]+(?![{letter}{number}{other}])|[{white}]+"
    return re.compile(f"[{letter}{number}{other}{white}]*"), re.compile(split), re.compile(f" [{letter}]+")


#: Fixed value: characters beyond ASCII that are letters, each from its first byte on.
_SIMPLE = re.compile("[\x20-\x7e\t\n\r\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u01ff\u0400-\u047f]*")


class Library:
    """The tokenizers library over distinct pieces."""

    style = {"blank_leads": True, "digits_alone": False}
    lower = False

    def __init__(self, path: str):
        # a task has one core; the library's own threads would take those of other tasks
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        known = self.tokenizer.get_added_tokens_decoder()
        self.special = {str(t.content): i for i, t in known.items()}
        alone = all(t.special and not t.normalized for t in known.values())
        longest = sorted(self.special, key=len, reverse=True)
        self.any_special = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest and alone else None
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        #: Whether an id's string begins with a blank.
        self.blank_led = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.blank_led[[i for t, i in vocab.items() if t[:1] == BLANK]] = True
        #: Whether texts may be split here by _byte_level; else they are cut at blanks only.
        self.byte_level = (
            repr(self.tokenizer.pre_tokenizer).replace(" ", "")
            == "ByteLevel(add_prefix_space=False,trim_offsets=True,use_regex=True)"
            and self.tokenizer.normalizer is None
            and (alone or not longest)
        )

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces in one array, and how many each has.

        The library cuts texts at special strings before all else, so one between
        two pieces parts them, and its id marks where; many pieces go in one call.
        """
        mark = next(iter(self.special), None) if self.any_special is not None else None
        if mark is None:
            found = self._called(pieces)
            counts = np.fromiter(map(len, found), np.int64, len(found))
            return np.concatenate([*found, np.zeros(0, np.uint32)]), counts
        counts = np.zeros(len(pieces), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        led = _byte_level()[2].fullmatch if self.byte_level else lambda p: None
        kinds = np.fromiter((2 if p in self.special else 1 if led(p) else 0 for p in pieces), np.int8, len(pieces))
        for kind in range(3):
            which = np.flatnonzero(kinds == kind)
            own = [pieces[k] for k in which.tolist()]
            if kind == 2:
                ids, first = np.array([self.special[p] for p in own], np.uint32), np.arange(len(own))
            elif kind == 1:
                # words after a blank part themselves: only their first ids begin with it
                runs = ["".join(own[k : k + JOINED]) for k in range(0, len(own), JOINED)]
                ids = np.concatenate([*self._called(runs), np.zeros(0, np.uint32)])
                first = np.flatnonzero(self.blank_led[ids])
            else:
                runs = [mark.join(own[k : k + JOINED]) + mark for k in range(0, len(own), JOINED)]
                ids = np.concatenate([*self._called(runs), np.zeros(0, np.uint32)])
                ends = np.flatnonzero(ids == self.special[mark])
                ids, first = np.delete(ids, ends), np.concatenate([[0], ends[:-1] + 1])[: len(own)] - np.arange(len(own))
            counts[which] = np.diff(first, append=len(ids))
            parts.append((which, ids))
        begin = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), np.uint32)
        for which, ids in parts:
            out[ragged(begin[which], counts[which])] = ids
        return out, counts

    def _called(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, np.uint32) for e in found]

    def plain(self, text: str) -> bool:
        """Whether the text is split without the library; special strings are not."""
        return (
            self.byte_level
            and _SIMPLE.fullmatch(text) is not None
            and (self.any_special is None or self.any_special.search(text) is None)
        )

    def parts(self, text: str, most: int) -> Iterator[str]:
        """Parts of about `most` characters: no piece goes across a lone blank's left side."""
        return parts_of(text, most) if self.byte_level else iter([text])

    def cut(self, text: str) -> Iterator[list[str]]:
        """The pieces of a text."""
        if self.any_special is None or self.any_special.search(text) is None:
            yield from self._plain(text)
            return
        for part in self.any_special.split(text):
            if part in self.special:
                yield [part]
            elif part:
                yield from self._plain(part)

    def _plain(self, text: str) -> Iterator[list[str]]:
        """Pieces of text without special strings, across which the splitter never joins."""
        if self.byte_level:
            simple, splitter, _ = _byte_level()
            yield splitter.findall(text) if simple.fullmatch(text) else list(map(spelled, keys_of(text)))
        else:
            yield list(map(spelled, keys_of(text)))


@lru_cache(maxsize=2)
def library(path: str) -> Library:
    return Library(path)


def encode_batch(path: str, texts: list[str | None]) -> list[np.ndarray]:
    """Ids of each whole text; the library sees each piece once."""
    own = library(path)
    ids, counts = ids_of_texts(PieceTable(own.encode_pieces), own, texts)
    return np.split(ids, np.cumsum(counts)[:-1]) if len(texts) else []


@dataclass
class Dealing:
    """Which shard a document belongs to: ranges of ids, each cut into equal widths.

    `bounds` are ascending ids between `least` and `most`; a range begins at each. An
    id that is several bounds fills whole ranges: its rows are dealt among them by a
    number of their own, so that no shard holds them all.
    """

    bounds: np.ndarray
    least: int
    most: int
    widths: int

    @property
    def shards(self) -> int:
        return (len(self.bounds) + 1) * self.widths

    def shard(self, ids: np.ndarray, known: np.ndarray, tie: np.ndarray) -> np.ndarray:
        """The shard of each row, `tie` being its number from 0 to below 1; shards are in
        ascending order of (id, tie), rows without an id come first."""
        low, high = (np.searchsorted(self.bounds, ids, side=s) for s in ("left", "right"))
        spread = (high - low) * tie
        part = np.where(high > low, low + 1 + spread.astype(np.int64), low)
        first = np.append(self.least, self.bounds).astype(np.float64)[part]
        last = np.append(self.bounds, self.most + 1).astype(np.float64)[part]
        inside = np.where(part < high, spread % 1, (ids - first) / np.maximum(last - first, 1))
        width = (inside.clip(0, 1 - 1e-9) * self.widths).astype(np.int64)
        return np.where(known, part * self.widths + width, 0)


def dealing(df: DataFrame, shards: int, id_col: str) -> Dealing:
    """Ranges of about equal numbers of rows; only the ids are read."""
    ranges = min(shards, RANGES)
    own = F.col(id_col).cast("long")
    at = [k / ranges for k in range(1, ranges)] or [0.5]
    bounds, least, most = df.agg(F.percentile_approx(own, at, 20 * RANGES), F.min(own), F.max(own)).first()
    bounds = np.array(bounds if bounds and ranges > 1 else [], np.int64)
    return Dealing(bounds, least or 0, most or 0, -(-shards // ranges))


def encoded_documents(
    df: DataFrame, tokenizer_path: str, bits: int, dealt: Dealing, *, text_col: str, id_col: str
) -> DataFrame:
    """(shard, doc_id, tie, ids): every row's ids, each of two bytes, of four beyond 16 bits."""
    dtype = "<u2" if bits <= 16 else "<u4"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = library(tokenizer_path)
        table = PieceTable(own.encode_pieces, MOST_PIECES)
        for batch in gathered(batches, ENCODED_BYTES):
            for at, n in byte_slices(batch.column(1), ENCODED_BYTES):
                ids, counts = ids_of_texts(table, own, batch.column(1).slice(at, n).to_pylist(), ENCODED_BYTES)
                docs, packed = batch.column(0).slice(at, n), binaries(ids, counts, dtype)
                tie = np.fromiter((zlib.crc32(x.as_buffer()) for x in packed), np.int64, n)
                numbers = docs.fill_null(0).to_numpy(zero_copy_only=False)
                known = docs.is_valid().to_numpy(zero_copy_only=False)
                shard = dealt.shard(numbers, known, tie / 2**32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard, pa.int32()), docs, pa.array(tie), packed],
                    names=["shard", "doc_id", "tie", "ids"],
                )

    texts = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_in_arrow(texts, encode, "shard int, doc_id long, tie long, ids binary")


def _text_bytes(df: DataFrame, text_col: str) -> int:
    """The optimizer's estimate of the table's size; where it has none, a count."""
    told = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if told < UNKNOWN_BYTES:
        return told
    return df.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0


def write_token_files(
    df: DataFrame,
    out: str,
    tokenizer_path: str,
    *,
    end_id: int | None,
    text_col: str = "text",
    id_col: str = "doc_id",
    block_ids: int = BLOCK_IDS,
    shards: int | None = None,
) -> str:
    """Encode `df` and write its token files to the folder `out`; returns `out`.

    Texts are encoded where they are read; only their ids, two bytes each, are dealt
    by ranges of document ids, so shards are in ascending order and so are the
    documents of each. Without `shards` their number follows from the table's size.
    A null text is empty (only the end id); rows with a null id come first; repeated
    ids stay, in an order of their own ids; an id that is no whole number raises; an
    empty table writes an empty dataset. A text of any length is one run of ids.
    """
    size = library(tokenizer_path).tokenizer.get_vocab_size(with_added_tokens=True)
    bits = bits_for(max(size, (end_id or 0) + 1))
    dtype = "<u2" if bits <= 16 else "<u4"
    if shards is None:
        shards = -(-_text_bytes(df.select(id_col, text_col), text_col) // SHARD_BYTES)
    dealt = dealing(df, max(1, min(MOST_SHARDS, shards)), id_col)
    encoded = encoded_documents(df, tokenizer_path, bits, dealt, text_col=text_col, id_col=id_col)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        state = {"block": 0, "start": 0}

        def block(docs: list[int], ids: list[np.ndarray]) -> pa.RecordBatch:
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            starts = state["start"] + np.cumsum(lengths) - lengths
            flat = np.concatenate(ids)
            known = [d for d in docs if d is not None]
            row = {
                "shard": [shard],
                "block": [state["block"]],
                "bits": [bits],
                "n_ids": [len(flat)],
                "first_doc": [min(known, default=None)],
                "last_doc": [max(known, default=None)],
                "doc_ids": [docs],
                "doc_starts": [starts.tolist()],
                "doc_lengths": [lengths.tolist()],
                "payload": [pack_bits(flat, bits)],
            }
            state["block"] += 1
            state["start"] += len(flat)
            return pa.RecordBatch.from_pydict(row, schema=_block_arrow())

        docs: list[int] = []
        ids: list[np.ndarray] = []
        held = 0
        tail = np.asarray([] if end_id is None else [end_id], dtype)
        for batch in batches:
            for key, own in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                docs.append(key)
                ids.append(np.concatenate([np.frombuffer(own.as_buffer(), dtype), tail]))
                held += len(ids[-1])
                if held >= block_ids:
                    yield block(docs, ids)
                    docs, ids, held = [], [], 0
        if docs:
            yield block(docs, ids)

    in_order = encoded.repartitionById(dealt.shards, "shard").sortWithinPartitions("doc_id", "tie", "ids").select("doc_id", "ids")
    blocks = map_in_arrow(in_order, pack, BLOCK_SCHEMA)
    blocks.write.option("parquet.block.size", 8 << 20).option("compression", "uncompressed").parquet(out)
    return out


def _block_arrow() -> pa.Schema:
    longs = pa.list_(pa.int64())
    return pa.schema(
        [("shard", pa.int64()), ("block", pa.int64()), ("bits", pa.int32()), ("n_ids", pa.int64())]
        + [("first_doc", pa.int64()), ("last_doc", pa.int64())]
        + [("doc_ids", longs), ("doc_starts", longs), ("doc_lengths", longs), ("payload", pa.binary())]
    )


def shard_bases(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, base): ids of all shards before it. One row per shard, no more."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(folder)
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))


def read_token_files(spark: SparkSession, folder: str, doc_ids: list[int] | None = None) -> DataFrame:
    """(doc_id, start, ids): every document, or those of `doc_ids`, from the files.

    `ids` holds little-endian unsigned 32-bit integers. With `doc_ids` only blocks
    whose range of documents covers one of them are read.
    """
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(folder)
    if doc_ids is not None:
        inside = F.lit(False)
        for d in doc_ids:
            inside |= (F.col("first_doc") <= d) & (F.col("last_doc") >= d)
        blocks = blocks.filter(inside)
    wanted = None if doc_ids is None else set(doc_ids)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, n_ids = (batch.column(k).to_pylist() for k in (1, 2))
            for row in range(batch.num_rows):
                docs, starts, lengths = (batch.column(k)[row].values for k in (3, 4, 5))
                payload = batch.column(6)[row].as_buffer()
                counts, local = lengths.to_numpy(), starts.to_numpy()
                if wanted is None:
                    ids = unpack_bits(payload, bits[row], n_ids[row])
                else:
                    keep = np.flatnonzero([d in wanted for d in docs.to_pylist()])
                    first = local[0] if len(local) else 0
                    at = local[keep] - first
                    docs, counts, local = docs.take(pa.array(keep)), counts[keep], local[keep]
                    runs = [unpack_bits(payload, bits[row], int(n), int(a)) for a, n in zip(at, counts, strict=True)]
                    ids = np.concatenate(runs) if runs else np.zeros(0, np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(counts), batch.column(0)[row].as_py()), pa.int64()),
                        docs,
                        pa.array(local, pa.int64()),
                        binaries(ids, counts, "<u4"),
                    ],
                    names=["shard", "doc_id", "local", "ids"],
                )

    packed = blocks.select("shard", "bits", "n_ids", "doc_ids", "doc_starts", "doc_lengths", "payload")
    found = map_in_arrow(packed, unpack, "shard long, doc_id long, local long, ids binary")
    bases = shard_bases(spark, folder)  # at most MOST_SHARDS rows of 16 bytes
    return found.join(F.broadcast(bases), "shard").select(
        "doc_id", (F.col("local") + F.col("base")).alias("start"), "ids"
    )


def crc32_of(df: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of documents read from token files."""
    return df.select(
        "doc_id",
        "start",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def crc32_of_ids(ids: np.ndarray) -> int:
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())
