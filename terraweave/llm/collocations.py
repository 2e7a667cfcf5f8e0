"""Collocations: frequent phrases whose words meet more often than chance, by position bitmaps.

The corpus is cut into shards of some million words. A shard knows which phrase begins at
which position, that is, one bitmap of positions for each phrase; a longer phrase's
bitmap is that of its beginning AND that of its rest shifted by one, and its popcount is
how often the shard has it. Breaks between pieces are positions of no word, so nothing
reaches across them. Bitmaps are compressed: few positions are a sorted array, many are
packed bits.

Counts are sums of popcounts over all shards. Words, pairs and triples are counted over
the whole corpus before a shard goes deeper, each level only where both shorter phrases
are frequent; from frequent triples on, a shard goes depth-first. What is counted travels
as packed keys, dealt to buckets by a hash of the key, and each shard gets back, for its
keys in their order, a bitmap of those that are frequent, with their numbers. There are as
many buckets as the corpus has millions of words, so a bucket's keys fit a task; nothing
that grows with the corpus is broadcast or collected.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .pieces import byte_slices, map_in_arrow, release
from .shingles import mixed
from .tables import remove_table, spread, stored
from .wordcut import LOWER, cut_words

LEAST_COUNT = 100
MOST_WORDS = 5
TOP = 2000
#: A candidate goes if a longer one has this share of its count, in a hundred, or more.
COVERED = 100
#: Words of a shard, and keys of a bucket at most.
SHARD_WORDS = 1 << 20
BUCKET_KEYS = 1 << 22
#: Words of the phrases that are counted in the whole corpus before shards go depth-first.
LEVELS = 3
#: A bitmap is packed if one position of so many is set, or more.
SPARSE = 32
NO_LANGUAGE = "und"

#: The marks between pieces and the blanks between words.
_BREAK = np.isin(LOWER, np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8))
_INSIDE = ~(_BREAK | np.isin(LOWER, np.frombuffer(b" \t", np.uint8)))


def pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0 up, byte by byte of their places, so that they compress well."""
    width = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    planes = np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + planes.tobytes()


def unpack(raw: pa.Scalar | bytes) -> np.ndarray:
    held = np.frombuffer(raw if isinstance(raw, bytes) else raw.as_buffer(), np.uint8)
    planes = held[1:].reshape(int(held[0]), -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : len(planes)] = planes.T
    return out.view("<i8").reshape(-1)


def strings(lengths: np.ndarray, raw: pa.Buffer) -> pa.Array:
    edges = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(edges), raw)


class Shard:
    """Words of texts as codes in their order, -1 between pieces; a word's key is its language,
    a blank and the word."""

    def __init__(self) -> None:
        self.code: dict[str, int] = {}
        self.spoken: dict[str, int] = {}
        self.runs: list[np.ndarray] = []
        self.words = 0

    def add(self, langs: pa.Array, texts: pa.Array) -> None:
        words, counts, starts, raw = cut_words(texts, _INSIDE)
        if not len(words):
            return
        coded, spoken = words.dictionary_encode(), langs.dictionary_encode()
        distinct, names = coded.dictionary.to_pylist(), spoken.dictionary.to_pylist()
        lang = np.repeat(spoken.indices.to_numpy(zero_copy_only=False).astype(np.int64), counts)
        for k, n in enumerate(np.bincount(lang, minlength=len(names)).tolist()):
            self.spoken[names[k]] = self.spoken.get(names[k], 0) + n
        key = lang * len(distinct) + coded.indices.to_numpy(zero_copy_only=False)
        keys, place = np.unique(key, return_inverse=True)
        code = self.code
        own = [code.setdefault(f"{names[k // len(distinct)]} {distinct[k % len(distinct)]}", len(code)) for k in keys.tolist()]
        piece = np.cumsum(_BREAK[raw])[starts]
        at = np.arange(len(starts)) + np.cumsum(np.diff(piece, prepend=-1) > 0)
        run = np.full(int(at[-1]) + 1, -1, np.int32)
        run[at] = np.array(own, np.int32)[place]
        self.runs.append(run)
        self.words += len(starts)

    def row(self, number: int) -> pa.RecordBatch:
        codes = np.concatenate([*self.runs, np.full(1, -1, np.int32)])
        keys = [k.encode() for k in self.code]
        columns = {
            "shard": pa.array([number]),
            "langs": pa.array([list(self.spoken)], pa.list_(pa.string())),
            "lang_words": pa.array([list(self.spoken.values())], pa.list_(pa.int64())),
            "lengths": pa.array([pack(np.fromiter(map(len, keys), np.int64, len(keys)))]),
            "keys": pa.array([b"".join(keys)], pa.binary()),
            "counts": pa.array([pack(np.bincount(codes[codes >= 0], minlength=len(keys)))]),
            "codes": pa.array([pack(codes.astype(np.int64) + 1)]),
        }
        return pa.RecordBatch.from_pydict(columns)


def shards_of(df: DataFrame, *, lang_col: str, text_col: str, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The words of each shard, how often it has each, and their order; words of each language."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, Shard()
        for batch in batches:
            for at, n in byte_slices(batch.column(1)):
                held.add(batch.column(0).slice(at, n), batch.column(1).slice(at, n))
                if held.words >= shard_words:
                    yield held.row(number)
                    number, held = number + 1, Shard()
        if held.words:
            yield held.row(number)

    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANGUAGE))
    texts = spread(df.select(lang.alias("lang"), F.col(text_col).cast("string").alias("text")))
    schema = "shard long, langs array<string>, lang_words array<long>, lengths binary, keys binary, counts binary, codes binary"
    return map_in_arrow(texts, cut, schema)


class Keys:
    """A shard's keys in the order in which they are dealt: by bucket, then as given."""

    def __init__(self, bucket: np.ndarray, buckets: int):
        self.order = np.argsort(bucket, kind="stable")
        self.edges = np.searchsorted(bucket[self.order], np.arange(buckets + 1))

    def parts(self) -> Iterator[tuple[int, np.ndarray]]:
        for k in np.flatnonzero(np.diff(self.edges)).tolist():
            yield k, self.order[self.edges[k] : self.edges[k + 1]]

    def answered(self, buckets: pa.Array, masks: pa.Array, numbers: pa.Array) -> np.ndarray:
        """The number of each key, in the order given; -1 if it is not frequent."""
        out = np.full(len(self.order), -1, np.int64)
        for k, mask, ids in zip(buckets.to_pylist(), masks, numbers, strict=True):
            own = self.order[self.edges[k] : self.edges[k + 1]]
            frequent = np.unpackbits(np.frombuffer(mask.as_buffer(), np.uint8), count=len(own)).astype(bool)
            out[own[frequent]] = unpack(ids)
        return out


def _word_keys(lengths: pa.Scalar, raw: pa.Scalar, buckets: int) -> tuple[pa.Array, Keys]:
    words = strings(unpack(lengths), raw.as_buffer())
    bucket = np.fromiter((zlib.crc32(w.encode()) % buckets for w in words.to_pylist()), np.int64, len(words))
    return words, Keys(bucket, buckets)


class Pairs:
    """Neighbours of a sequence of numbered phrases: each is a phrase that is one word longer."""

    def __init__(self, seq: np.ndarray, ids: np.ndarray, buckets: int):
        self.both = np.flatnonzero((seq[:-1] >= 0) & (seq[1:] >= 0))
        key = seq[self.both] * max(1, len(ids)) + seq[self.both + 1]
        # ids ascend, so the keys do by both ids
        keys, self.place, self.n = np.unique(key, return_inverse=True, return_counts=True)
        self.first, self.second = (ids[k] for k in np.divmod(keys, max(1, len(ids))))
        mixing = mixed(self.first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + self.second.astype(np.uint64))
        self.keys = Keys((mixing % np.uint64(buckets)).astype(np.int64), buckets)


def _compact(seq: np.ndarray) -> np.ndarray:
    """Without what has no neighbour and is in no longer phrase; runs of breaks are one."""
    there = np.concatenate([[False], seq >= 0, [False]])
    joined = there[1:-1] & (there[:-2] | there[2:])
    seq = np.where(joined, seq, -1)
    return np.append(seq[joined | np.concatenate([[True], joined[:-1]])], -1)


_SEQUENCE = "shard long, ids binary, seq binary"


def _sequence(shard: pa.Array, number: np.ndarray, seq: np.ndarray) -> pa.RecordBatch:
    """One shard's row: its phrases' numbers, ascending, and which is where (0: none)."""
    ids, place = np.unique(number, return_inverse=True) if len(number) else (number, number)
    new = np.where(seq >= 0, place[seq] if len(place) else -1, -1)
    new = _compact(new)
    columns = [shard, pa.array([pack(np.diff(ids, prepend=0))]), pa.array([pack(new + 1)])]
    return pa.RecordBatch.from_arrays(columns, names=["shard", "ids", "seq"])


def _read(ids: pa.Scalar, seq: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(unpack(ids)), unpack(seq) - 1


def _with_answers(df: DataFrame, counted: DataFrame) -> DataFrame:
    told = counted.filter("shard is not null").groupBy("shard").agg(F.collect_list(F.struct("bucket", "mask", "ids")).alias("told"))
    return df.join(told.select("shard", F.col("told.bucket").alias("buckets"), F.col("told.mask").alias("masks"), F.col("told.ids").alias("numbers")), "shard")


def _words_sent(shards: DataFrame, buckets: int) -> DataFrame:
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                words, keys = _word_keys(batch.column(1)[row], batch.column(2)[row], buckets)
                counts = unpack(batch.column(3)[row])
                for bucket, own in keys.parts():
                    held = [w.encode() for w in words.take(pa.array(own)).to_pylist()]
                    lengths = pack(np.fromiter(map(len, held), np.int64, len(held)))
                    yield _sent(batch.column(0).slice(row, 1), bucket, lengths, b"".join(held), pack(counts[own]))

    return map_in_arrow(shards.select("shard", "lengths", "keys", "counts"), send, _SENT)


_SENT = "shard long, bucket int, first binary, second binary, n binary"


def _sent(shard: pa.Array, bucket: int, first: bytes, second: bytes, n: bytes) -> pa.RecordBatch:
    columns = [shard, pa.array([bucket], pa.int32()), *(pa.array([x], pa.binary()) for x in (first, second, n))]
    return pa.RecordBatch.from_arrays(columns, names=["shard", "bucket", "first", "second", "n"])


def _pairs_sent(sequences: DataFrame, buckets: int) -> DataFrame:
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, seq = _read(batch.column(1)[row], batch.column(2)[row])
                pairs = Pairs(seq, ids, buckets)
                for bucket, own in pairs.keys.parts():
                    first, second = np.diff(pairs.first[own], prepend=0), pairs.second[own]
                    yield _sent(batch.column(0).slice(row, 1), bucket, pack(first), pack(second), pack(pairs.n[own]))

    return map_in_arrow(sequences, send, _SENT)


#: Answers to shards (shard, bucket, mask, ids), and frequent keys (id, word or first and second, n).
_COUNTED = "shard long, bucket int, mask binary, ids binary, id long, word string, first long, second long, n long"


def _counted(sent: DataFrame, buckets: int, least: int, of_words: bool) -> DataFrame:
    """The keys of each bucket, summed over shards. A frequent key's number is its rank times
    the number of buckets, plus its bucket."""

    def count(table: pa.Table) -> pa.Table:
        try:
            return told(table.combine_chunks())
        finally:
            release()

    def told(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        n = [unpack(x) for x in table.column("n")]
        sizes = [len(x) for x in n]
        if of_words:
            every = pa.concat_arrays([strings(unpack(a), b.as_buffer()) for a, b in zip(table.column("first"), table.column("second"), strict=True)])
            coded = every.dictionary_encode()
            place, words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
            distinct = len(words)
        else:
            first = np.concatenate([np.cumsum(unpack(x)) for x in table.column("first")])
            second = np.concatenate([unpack(x) for x in table.column("second")])
            order = np.lexsort((second, first))
            new = np.concatenate([[True], (np.diff(first[order]) != 0) | (np.diff(second[order]) != 0)])
            place = np.empty(len(order), np.int64)
            place[order] = np.cumsum(new) - 1
            firsts, seconds = first[order[new]], second[order[new]]
            distinct = len(firsts)
        total = np.zeros(distinct, np.int64)
        np.add.at(total, place, np.concatenate(n))
        frequent = total >= least
        number = np.where(frequent, (np.cumsum(frequent) - 1) * buckets + bucket, -1)
        masks, ids = [], []
        for part in np.split(number[place], np.cumsum(sizes)[:-1]):
            masks.append(np.packbits(part >= 0).tobytes())
            ids.append(pack(part[part >= 0]))
        there = np.flatnonzero(frequent)
        size, own = len(sizes), len(there)
        none = lambda k, kind: pa.nulls(k, kind)
        answers = [
            table.column("shard").combine_chunks(), pa.array([bucket] * size, pa.int32()), pa.array(masks, pa.binary()), pa.array(ids, pa.binary()),
            none(size, pa.int64()), none(size, pa.string()), *(none(size, pa.int64()) for _ in range(3)),
        ]
        keys = [words.take(pa.array(there)), *(none(own, pa.int64()) for _ in "ab")] if of_words else [none(own, pa.string()), pa.array(firsts[there]), pa.array(seconds[there])]
        found = [
            none(own, pa.int64()), pa.array([bucket] * own, pa.int32()), none(own, pa.binary()), none(own, pa.binary()),
            pa.array(number[there]), *keys, pa.array(total[there]),
        ]
        names = ["shard", "bucket", "mask", "ids", "id", "word", "first", "second", "n"]
        return pa.concat_tables([pa.Table.from_arrays(answers, names=names), pa.Table.from_arrays(found, names=names)])

    return sent.groupBy("bucket").applyInArrow(count, _COUNTED)


def _numbered_words(shards: DataFrame, counted: DataFrame, buckets: int) -> DataFrame:
    """(shard, ids, seq): the numbers of frequent words in the order of the texts."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                _, keys = _word_keys(batch.column(1)[row], batch.column(2)[row], buckets)
                found = keys.answered(*(batch.column(k)[row].values for k in (4, 5, 6)))
                yield _renumbered(batch.column(0).slice(row, 1), found, unpack(batch.column(3)[row]) - 1)

    return map_in_arrow(_with_answers(shards.select("shard", "lengths", "keys", "codes"), counted), number, _SEQUENCE)


def _renumbered(shard: pa.Array, found: np.ndarray, seq: np.ndarray) -> pa.RecordBatch:
    """A sequence of codes as one of those codes that have a number in `found`."""
    frequent = found >= 0
    code = np.append(np.where(frequent, np.cumsum(frequent) - 1, -1), -1)
    return _sequence(shard, found[frequent], code[seq])


def _lengthened(sequences: DataFrame, counted: DataFrame, buckets: int) -> DataFrame:
    """(shard, ids, seq) of the frequent phrases that are a word longer than those of `sequences`."""

    def lengthen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, seq = _read(batch.column(1)[row], batch.column(2)[row])
                pairs = Pairs(seq, ids, buckets)
                found = pairs.keys.answered(*(batch.column(k)[row].values for k in (3, 4, 5)))
                longer = np.full(len(seq), -1, np.int64)
                longer[pairs.both] = pairs.place
                yield _renumbered(batch.column(0).slice(row, 1), found, longer)

    return map_in_arrow(_with_answers(sequences, counted), lengthen, _SEQUENCE)


class Bitmap:
    """A set of positions below `span`: a sorted array, or packed bits if it is dense."""

    __slots__ = ("span", "at", "bits", "count")

    def __init__(self, span: int, at: np.ndarray | None = None, bits: np.ndarray | None = None):
        self.span, self.at, self.bits = span, at, bits
        self.count = len(at) if at is not None else int(np.bitwise_count(bits).sum())

    @classmethod
    def of(cls, span: int, at: np.ndarray) -> Bitmap:
        if len(at) * SPARSE < span:
            return cls(span, at=at)
        flags = np.zeros(-(-span // 64) * 64, np.uint8)
        flags[at] = 1
        return cls(span, bits=np.packbits(flags, bitorder="little").view(np.uint64))

    def positions(self) -> np.ndarray:
        if self.at is not None:
            return self.at
        return np.flatnonzero(np.unpackbits(self.bits.view(np.uint8), bitorder="little"))

    def has(self, at: np.ndarray) -> np.ndarray:
        if self.bits is not None:
            return (self.bits[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
        place = np.minimum(np.searchsorted(self.at, at), max(len(self.at) - 1, 0))
        return self.at[place] == at if len(self.at) else np.zeros(len(at), bool)

    def shifted(self) -> Bitmap:
        """Every position one further; the last one is a break, so none falls out."""
        if self.at is not None:
            return Bitmap(self.span, at=self.at + 1)
        carry = np.concatenate([np.zeros(1, np.uint64), self.bits[:-1] >> np.uint64(63)])
        return Bitmap(self.span, bits=self.bits << np.uint64(1) | carry)

    def __and__(self, other: Bitmap) -> Bitmap:
        if self.bits is not None and other.bits is not None:
            both = Bitmap(self.span, bits=self.bits & other.bits)
            return both if both.count * SPARSE >= self.span else Bitmap(self.span, at=both.positions())
        few, many = (self, other) if self.bits is None else (other, self)
        return Bitmap(self.span, at=few.at[many.has(few.at)])


class Phrases:
    """Longer phrases of a shard, depth-first, as chains of frequent ones that each begin a word
    after the one before. `seq` tells which of `n` phrases begins where, -1: none."""

    def __init__(self, seq: np.ndarray, n: int):
        self.seq, self.span = seq, len(seq)
        there = seq >= 0
        #: Positions from which a chain goes on.
        self.linked = Bitmap.of(self.span, np.flatnonzero(there[:-1] & there[1:]))
        self.order = np.argsort(seq, kind="stable")
        self.edges = np.searchsorted(seq[self.order], np.arange(n + 1))
        pairs = np.unique(seq[:-1][there[:-1] & there[1:]] * max(1, n) + seq[1:][there[:-1] & there[1:]])
        self.after, self.after_edges = pairs % max(1, n), np.searchsorted(pairs, np.arange(n + 1) * max(1, n))
        self.maps: dict[int, Bitmap] = {}

    def of(self, code: int) -> Bitmap:
        if code not in self.maps:
            self.maps[code] = Bitmap.of(self.span, self.order[self.edges[code] : self.edges[code + 1]])
        return self.maps[code]

    def extended(self, last: int, held: Bitmap) -> Iterator[tuple[int, Bitmap]]:
        """Each phrase that follows, with the positions where it does.

        `held` are the positions of the chain's last phrase. A dense bitmap is shifted and met
        with that of every phrase that ever follows; a sparse one with all at once, by
        grouping the phrases at its shifted positions.
        """
        held = held & self.linked
        if not held.count:
            return
        moved = held.shifted()
        if moved.bits is not None:
            for code in self.after[self.after_edges[last] : self.after_edges[last + 1]].tolist():
                met = moved & self.of(code)
                if met.count:
                    yield code, met
            return
        found = self.seq[moved.at]
        order = np.argsort(found, kind="stable")
        found, at = found[order], moved.at[order]
        cuts = np.flatnonzero(np.diff(found)) + 1
        for code, own in zip(found[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts), strict=True):
            yield code, Bitmap(self.span, at=own)

    def longer(self, chain: tuple[int, ...], held: Bitmap, most: int) -> Iterator[tuple[tuple[int, ...], int]]:
        """(codes, count) of the chains of up to `most` phrases that begin with `chain`."""
        for code, met in self.extended(chain[-1], held):
            more = (*chain, code)
            yield more, met.count
            if len(more) < most:
                yield from self.longer(more, met, most)

    def all(self, most: int) -> Iterator[tuple[tuple[int, ...], int]]:
        for code in np.flatnonzero(np.diff(self.after_edges)).tolist():
            yield from self.longer((code,), self.of(code), most)


def _chains(sequences: DataFrame, most: int, buckets: int, least: int) -> DataFrame:
    """(ids, n): chains of two to `most` phrases that are frequent. Those of a shard travel by
    length and bucket, packed column by column."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, seq = _read(batch.column(1)[row], batch.column(2)[row])
                codes: list[list[int]] = [[] for _ in range(most + 1)]
                counts: list[list[int]] = [[] for _ in range(most + 1)]
                for chain, n in Phrases(seq, len(ids)).all(most):
                    codes[len(chain)].extend(chain)
                    counts[len(chain)].append(n)
                for length in range(2, most + 1):
                    chains, n = ids[np.array(codes[length], np.int64)].reshape(-1, length), np.array(counts[length], np.int64)
                    hashes = np.zeros(len(n), np.uint64)
                    for k in range(length):
                        hashes = mixed(hashes * np.uint64(0x9E3779B97F4A7C15) + chains[:, k].astype(np.uint64))
                    for bucket, own in Keys((hashes % np.uint64(buckets)).astype(np.int64), buckets).parts():
                        held = pa.array([[pack(chains[own, k]) for k in range(length)]], pa.list_(pa.binary()))
                        columns = [pa.array([bucket], pa.int32()), held, pa.array([pack(n[own])])]
                        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "chains", "n"])

    def count(table: pa.Table) -> pa.Table:
        try:
            return told(table.combine_chunks())
        finally:
            release()

    def told(table: pa.Table) -> pa.Table:
        by_length: dict[int, list[tuple[list[np.ndarray], np.ndarray]]] = {}
        for held, n in zip(table.column("chains"), table.column("n"), strict=True):
            by_length.setdefault(len(held.values), []).append(([unpack(x) for x in held.values], unpack(n)))
        found: list[pa.Table] = []
        for length, parts in by_length.items():
            columns = [np.concatenate([p[0][k] for p in parts]) for k in range(length)]
            order = np.lexsort(columns[::-1])
            columns = [c[order] for c in columns]
            new = np.concatenate([[True], np.logical_or.reduce([np.diff(c) != 0 for c in columns])])
            total = np.add.reduceat(np.concatenate([p[1] for p in parts])[order], np.flatnonzero(new))
            flat = np.stack([c[new][total >= least] for c in columns], axis=1)
            ends = np.arange(len(flat) + 1, dtype=np.int32) * length
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.reshape(-1)))
            found.append(pa.table({"ids": lists, "n": pa.array(total[total >= least])}))
        return pa.concat_tables(found)

    sent = map_in_arrow(sequences, extend, "bucket int, chains array<binary>, n binary")
    return sent.groupBy("bucket").applyInArrow(count, "ids array<long>, n long")


def _spelled(chains: DataFrame, known: DataFrame) -> DataFrame:
    """(ids, n): the words of chains of phrases, of which `known` has (id, ids): all of the
    first one's, then the last of each further one."""
    linked = chains.select("ids", "n", F.posexplode("ids").alias("at", "id")).join(known.select("id", F.col("ids").alias("words")), "id")
    own = F.when(F.col("at") == 0, F.col("words")).otherwise(F.array(F.element_at("words", -1)))
    told = linked.groupBy("ids", "n").agg(F.sort_array(F.collect_list(F.struct("at", own.alias("words")))).alias("parts"))
    return told.select(F.flatten("parts.words").alias("ids"), "n")


def collocations(
    df: DataFrame,
    *,
    lang_col: str = "lang",
    text_col: str = "text",
    least_count: int = LEAST_COUNT,
    most_words: int = MOST_WORDS,
    covered: int = COVERED,
    top: int = TOP,
    shard_words: int = SHARD_WORDS,
    bucket_keys: int = BUCKET_KEYS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `top` phrases of each language.

    A phrase of two to `most_words` words that occurs `a` >= `least_count` times is cut
    where floor(1000 a n / (l r)) is least, l and r being the counts of its parts and n
    all words of the language. Phrases that a longer one covers are left out. A null
    language is `und`; null and empty texts and pieces without words count nothing; equal
    rows count each; a table without frequent words gives an empty result; other columns
    are not read. The result is a stored table; all others are removed.
    """
    shards = stored(shards_of(df, lang_col=lang_col, text_col=text_col, shard_words=shard_words), "shards")
    spoken = shards.select(F.explode(F.arrays_zip("langs", "lang_words")).alias("of"))
    sizes = stored(spoken.groupBy(F.col("of.langs").alias("lang")).agg(F.sum("of.lang_words").alias("n")), "language-words")
    # no level has more keys than there are words
    buckets = -(-(sizes.agg(F.sum("n")).first()[0] or 1) // bucket_keys)
    counted = stored(_counted(_words_sent(shards, buckets), buckets, least_count, of_words=True), "words-counted")
    split = F.length("word") - F.locate(" ", F.reverse("word")) + 1
    words = counted.filter("id is not null").select(
        "id", F.array("id").alias("ids"), "n",
        F.substring("word", F.lit(1), split - 1).alias("lang"), F.substring("word", split + 1, F.length("word")).alias("word"),
    )
    known, done, phrases = words, [counted], words.select("ids", "n")
    before, sequences = shards, _numbered_words(shards, counted, buckets)
    for _ in range(1, min(LEVELS, most_words)):
        sequences = stored(sequences, "sequences")
        remove_table(before)
        before = sequences
        counted = stored(_counted(_pairs_sent(sequences, buckets), buckets, least_count, of_words=False), "phrases-counted")
        done.append(counted)
        frequent = counted.filter("id is not null").select("id", F.array("first", "second").alias("pair"), "n")
        known = stored(_named(frequent, known), "phrases")
        done.append(known)
        phrases = phrases.unionByName(known.select("ids", "n"))
        sequences = _lengthened(sequences, counted, buckets)
    if most_words > LEVELS:
        chains = _chains(sequences, most_words - LEVELS + 1, buckets, least_count)
        phrases = phrases.unionByName(_spelled(chains, known))
    phrases = stored(phrases, "all-phrases")
    out = stored(_ranked(phrases, words, sizes, covered=covered, top=top), "collocations")
    for old in (*done, before, sizes, phrases):
        remove_table(old)
    return out


def _named(frequent: DataFrame, known: DataFrame) -> DataFrame:
    """(id, ids, n): the words of pairs of phrases that `known` has."""
    first, second = (known.select(F.col("id").alias(f"id{k}"), F.col("ids").alias(f"ids{k}")) for k in "12")
    pairs = frequent.select("id", "n", F.col("pair")[0].alias("id1"), F.col("pair")[1].alias("id2"))
    joined = pairs.join(first, "id1").join(second, "id2")
    return joined.select("id", F.concat("ids1", F.array(F.element_at("ids2", -1))).alias("ids"), "n")


def _ranked(phrases: DataFrame, words: DataFrame, sizes: DataFrame, *, covered: int, top: int) -> DataFrame:
    size = F.size("ids")
    # what is one word longer is enough: anything longer still is no more frequent than that
    longer = phrases.filter(size > 2).select(
        F.explode(F.array(F.slice("ids", F.lit(1), size - 1), F.slice("ids", F.lit(2), size - 1))).alias("ids"), F.col("n").alias("over")
    )
    over = longer.groupBy("ids").agg(F.max("over").alias("over"))
    candidates = phrases.filter(size > 1).join(over, "ids", "left")
    kept = candidates.filter(100 * F.coalesce("over", F.lit(0)) < covered * F.col("n")).select("ids", F.col("n").alias("a"))
    spelled = (
        kept.select("ids", "a", F.posexplode("ids").alias("at", "id"))
        .join(words.select("id", "lang", "word"), "id")
        .groupBy("ids", "a", "lang")
        .agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("parts"))
        .select("ids", "a", "lang", F.array_join("parts.word", " ").alias("phrase"))
        .join(sizes, "lang")
    )
    k = F.col("k")
    cuts = spelled.select("*", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("*", F.slice("ids", F.lit(1), k).alias("first"), F.slice("ids", k + 1, size - k).alias("rest"))
    heads, rests = (phrases.select(F.col("ids").alias(c), F.col("n").alias(n)) for c, n in (("first", "l"), ("rest", "r")))

    def exact(name: str) -> Column:
        return F.col(name).cast("decimal(18,0)")

    whole = F.lit(1000).cast("decimal(4,0)") * exact("a") * exact("n")
    score = F.call_function("div", whole, exact("l") * exact("r"))
    scored = cuts.join(heads, "first").join(rests, "rest").select("lang", "phrase", "a", "n", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
    least = scored.groupBy("lang", "phrase", "a", "n").agg(F.min("cut").alias("cut"))
    best = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = least.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long"), "phrase", "a", "cut.l", "cut.r", "n", F.col("cut.score").alias("score"))


#: DuckDB SQL for collocations(documents) with the parameters above: all runs of words, counted.
COLLOCATIONS_SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, '{NO_LANGUAGE}') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), cut AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces
), runs AS (
  SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
  FROM cut, range(1, {MOST_WORDS + 1}) t(k)
), f AS (SELECT lang, phrase, k, count(*) AS a FROM runs GROUP BY lang, phrase, k),
sizes AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND a >= {LEAST_COUNT}),
longer AS (
  SELECT lang, array_to_string(ws[1:k - 1], ' ') AS phrase, a FROM c
  UNION ALL SELECT lang, array_to_string(ws[2:k], ' ') AS phrase, a FROM c
), kept AS (
  SELECT c.* FROM c WHERE NOT EXISTS (
    SELECT 1 FROM longer o WHERE o.lang = c.lang AND o.phrase = c.phrase AND 100 * o.a >= {COVERED} * c.a)
), cuts AS (
  SELECT lang, phrase, a, j, array_to_string(ws[1:j], ' ') AS head, array_to_string(ws[j + 1:k], ' ') AS rest
  FROM kept, range(1, {MOST_WORDS}) t(j) WHERE j < k
), scored AS (
  SELECT u.lang, u.phrase, u.a, h.a AS l, e.a AS r, n, j,
    CAST(1000::HUGEINT * u.a * n // (h.a::HUGEINT * e.a) AS BIGINT) AS score
  FROM cuts u JOIN f h ON h.lang = u.lang AND h.phrase = u.head JOIN f e ON e.lang = u.lang AND e.phrase = u.rest
    JOIN sizes s ON s.lang = u.lang
), least AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least
) WHERE rank <= {TOP}
"""
