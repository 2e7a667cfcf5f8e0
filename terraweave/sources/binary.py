"""Binary dumps as data sources: blocks of protocol buffers, and delta-coded streams.

A partition is a run of blocks, or of sections from a reset on, so a file is read in
parallel and a lost task reads its run again; a compressed delta stream is one run. Files are opened through
Arrow's file systems, by path or URI.
"""

from __future__ import annotations

import bz2
import zlib
from collections import deque
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

TAGS = "array<struct<k: string, v: string>>"
META = "changeset bigint, seconds bigint, user string, uid bigint, version bigint, visible boolean"
SCHEMAS = {
    "node": f"id bigint, lon double, lat double, tags {TAGS}, {META}",
    "way": f"id bigint, nds array<bigint>, tags {TAGS}, {META}",
    "relation": f"id bigint, members array<struct<type: string, ref: bigint, role: string>>, tags {TAGS}, {META}",
}
KINDS = ("node", "way", "relation")
#: Bytes of blocks in one partition.
PART_BYTES = 16 << 20


def _open(path: str):
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return system.open_input_file(inner)


# -- protocol buffers ------------------------------------------------------------


def varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        at += 1
        value |= (b & 0x7F) << shift
        if b < 0x80:
            return value, at
        shift += 7


def signed(n: int) -> int:
    """Zig-zag: the lowest bit is the sign."""
    return (n >> 1) ^ -(n & 1)


def _int64(n: int) -> int:
    return n - (1 << 64) if n >> 63 else n


def message(data: bytes) -> dict[int, list]:
    """The fields of a message: numbers, and bytes of what has a length."""
    out: dict[int, list] = {}
    at = 0
    while at < len(data):
        tag, at = varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(data, at)
        elif kind == 2:
            size, at = varint(data, at)
            value = data[at : at + size]
            at += size
        else:
            size = 8 if kind == 1 else 4
            value = data[at : at + size]
            at += size
        out.setdefault(tag >> 3, []).append(value)
    return out


def packed(fields: dict[int, list], number: int, *, zigzag: bool = False, delta: bool = False) -> list[int]:
    """A packed list, with its differences summed up if it is one of differences."""
    out: list[int] = []
    last = 0
    for data in fields.get(number, ()):
        if isinstance(data, int):
            data, values = b"", [data]
        else:
            values, at = [], 0
            while at < len(data):
                n, at = varint(data, at)
                values.append(n)
        for n in values:
            n = signed(n) if zigzag else _int64(n)
            last = last + n if delta else n
            out.append(last)
    return out


def _blob(data: bytes) -> bytes:
    fields = message(data)
    if 1 in fields:
        return fields[1][0]
    if 3 in fields:
        return zlib.decompress(fields[3][0])
    raise ValueError("a block's compression is not supported")


class Block:
    """One block of entities."""

    def __init__(self, data: bytes):
        self.f = message(data)
        table = message(self.f[1][0]) if 1 in self.f else {}
        self.strings = [s.decode("utf-8", "replace") for s in table.get(1, [])]
        one = lambda number, default: _int64(self.f[number][0]) if number in self.f else default
        self.granularity, self.date_granularity = one(17, 100), one(18, 1000)
        self.lat_offset, self.lon_offset = one(19, 0), one(20, 0)

    def _degrees(self, value: int, offset: int) -> float:
        # coordinates have seven decimals
        return round((offset + self.granularity * value) / 100) / 1e7

    def _tags(self, f: dict[int, list]) -> list[tuple[str, str]]:
        return [(self.strings[k], self.strings[v]) for k, v in zip(packed(f, 2), packed(f, 3), strict=True)]

    def _info(self, f: dict[int, list]) -> tuple:
        i = message(f[4][0]) if 4 in f else {}
        get = lambda number, default=0: _int64(i[number][0]) if number in i else default
        user = self.strings[get(5)] if 5 in i else ""
        return get(3), get(2) * self.date_granularity // 1000, user, get(4), max(0, get(1)), bool(get(6, 1))

    def rows(self, kind: str) -> Iterator[tuple]:
        for group in map(message, self.f.get(2, ())):
            if kind == "node":
                for f in map(message, group.get(1, ())):
                    lat, lon = signed(f[8][0]), signed(f[9][0])
                    place = self._degrees(lon, self.lon_offset), self._degrees(lat, self.lat_offset)
                    yield (signed(f[1][0]), *place, self._tags(f), *self._info(f))
                for f in map(message, group.get(2, ())):
                    yield from self._dense(f)
            elif kind == "way":
                for f in map(message, group.get(3, ())):
                    yield (_int64(f[1][0]), packed(f, 8, zigzag=True, delta=True), self._tags(f), *self._info(f))
            else:
                for f in map(message, group.get(4, ())):
                    parts = zip(packed(f, 10), packed(f, 9, zigzag=True, delta=True), packed(f, 8), strict=True)
                    members = [(KINDS[t], ref, self.strings[role]) for t, ref, role in parts]
                    yield (_int64(f[1][0]), members, self._tags(f), *self._info(f))

    def _dense(self, f: dict[int, list]) -> Iterator[tuple]:
        ids, lats, lons = (packed(f, n, zigzag=True, delta=True) for n in (1, 8, 9))
        words, at = packed(f, 10), 0
        i = message(f[5][0]) if 5 in f else {}
        versions, seen = packed(i, 1), packed(i, 6)
        times, changes, uids, users = (packed(i, n, zigzag=True, delta=True) for n in (2, 3, 4, 5))
        get = lambda values, n, default=0: values[n] if n < len(values) else default
        for n, number in enumerate(ids):
            tags = []
            while at < len(words) and words[at]:
                tags.append((self.strings[words[at]], self.strings[words[at + 1]]))
                at += 2
            at += 1
            place = self._degrees(lons[n], self.lon_offset), self._degrees(lats[n], self.lat_offset)
            user = self.strings[users[n]] if n < len(users) else ""
            meta = get(changes, n), get(times, n) * self.date_granularity // 1000, user, get(uids, n), max(0, get(versions, n)), bool(get(seen, n, 1))
            yield (number, *place, tags, *meta)


_TEXT_PAIRS = pa.list_(pa.struct([("k", pa.string()), ("v", pa.string())]))
_META_FIELDS = [
    ("tags", _TEXT_PAIRS), ("changeset", pa.int64()), ("seconds", pa.int64()), ("user", pa.string()), ("uid", pa.int64()),
    ("version", pa.int64()), ("visible", pa.bool_()),
]
_MEMBERS = pa.list_(pa.struct([("type", pa.string()), ("ref", pa.int64()), ("role", pa.string())]))
#: The Arrow form of SCHEMAS.
ARROW_SCHEMAS = {
    "node": pa.schema([("id", pa.int64()), ("lon", pa.float64()), ("lat", pa.float64()), *_META_FIELDS]),
    "way": pa.schema([("id", pa.int64()), ("nds", pa.list_(pa.int64())), *_META_FIELDS]),
    "relation": pa.schema([("id", pa.int64()), ("members", _MEMBERS), *_META_FIELDS]),
}
#: Rows that leave a reader together.
BATCH_ROWS = 4096


def in_batches(rows: Iterator[tuple], kind: str) -> Iterator[pa.RecordBatch]:
    """Rows of a kind as Arrow batches, which the engine takes over whole."""
    schema = ARROW_SCHEMAS[kind]
    while held := list(islice(rows, BATCH_ROWS)):
        columns = zip(*held, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


class Run(InputPartition):
    """Bytes from `start` to `end` of a file."""

    def __init__(self, start: int, end: int):
        super().__init__((start, end))
        self.start, self.end = start, end


class PbfReader(DataSourceReader):
    def __init__(self, path: str, kind: str):
        self.path, self.kind = path, kind

    def partitions(self) -> list[Run]:
        """Runs of blocks, from the blocks' sizes alone."""
        runs, first, at = [], 0, 0
        with _open(self.path) as f:
            end = f.size()
            while at < end:
                f.seek(at)
                size = int.from_bytes(f.read(4), "big")
                head = message(f.read(size))
                at += 4 + size + head[3][0]
                if at - first >= PART_BYTES or at >= end:
                    runs.append(Run(first, at))
                    first = at
        return runs or [Run(0, 0)]

    def read(self, partition: Run) -> Iterator[pa.RecordBatch]:
        return in_batches(self._rows(partition), self.kind)

    def _rows(self, partition: Run) -> Iterator[tuple]:
        with _open(self.path) as f:
            at = partition.start
            while at < partition.end:
                f.seek(at)
                size = int.from_bytes(f.read(4), "big")
                head = message(f.read(size))
                body = f.read(head[3][0])
                at += 4 + size + head[3][0]
                if head[1][0] == b"OSMData":
                    yield from Block(_blob(body)).rows(self.kind)


# -- delta-coded streams -----------------------------------------------------------

#: Kinds of sections, the string table's size and longest entry.
SECTIONS = {0x10: "node", 0x11: "way", 0x12: "relation"}
RESET, ALONE = 0xFF, 0xF0
TABLE_SIZE, LONGEST = 15_000, 250


class DeltaStream:
    """Reads sections in order; every number is a difference, strings may be repeats."""

    def __init__(self):
        self.reset()

    def reset(self) -> None:
        self.last: dict[str, int] = {}
        self.table: deque[bytes] = deque(maxlen=TABLE_SIZE)

    def _step(self, name: str, data: bytes, at: int) -> tuple[int, int]:
        n, at = varint(data, at)
        self.last[name] = self.last.get(name, 0) + signed(n)
        return self.last[name], at

    def _string(self, data: bytes, at: int, parts: int) -> tuple[list[bytes], int]:
        """A string pair, or a single string, given here or by its place in the table."""
        if data[at] == 0:
            at += 1
            start = at
            for _ in range(parts):
                at = data.index(b"\0", at) + 1
            raw = data[start:at]
            if len(raw) - parts <= LONGEST:
                self.table.appendleft(raw)
        else:
            n, at = varint(data, at)
            raw = self.table[n - 1]
        return raw.split(b"\0")[:parts], at

    def _meta(self, data: bytes, at: int) -> tuple[tuple, int]:
        version, at = varint(data, at)
        if not version:
            return (0, 0, "", 0, 0, True), at
        seconds, at = self._step("time", data, at)
        if not seconds:
            return (0, 0, "", 0, version, True), at
        change, at = self._step("change", data, at)
        (uid, user), at = self._string(data, at, 2)
        number = varint(uid, 0)[0] if uid else 0
        return (change, seconds, user.decode("utf-8", "replace"), number, version, True), at

    def row(self, kind: str, data: bytes) -> tuple | None:
        """One entity; None of one that is deleted."""
        number, at = self._step(kind, data, 0)
        meta, at = self._meta(data, at)
        if at >= len(data):
            return None
        if kind == "node":
            x, at = self._step("lon", data, at)
            y, at = self._step("lat", data, at)
            own = (x / 1e7, y / 1e7)
        else:
            size, at = varint(data, at)
            end = at + size
            items = []
            while at < end:
                if kind == "way":
                    ref, at = self._step("ref", data, at)
                    items.append(ref)
                    continue
                change, at = varint(data, at)
                (word,), at = self._string(data, at, 1)
                to = KINDS[word[0] - 0x30]
                self.last[f"member {to}"] = self.last.get(f"member {to}", 0) + signed(change)
                items.append((to, self.last[f"member {to}"], word[1:].decode("utf-8", "replace")))
            own = (items,)
        tags = []
        while at < len(data):
            (k, v), at = self._string(data, at, 2)
            tags.append((k.decode("utf-8", "replace"), v.decode("utf-8", "replace")))
        return (number, *own, tags, *meta)


class O5mReader(DataSourceReader):
    def __init__(self, path: str, kind: str):
        self.path, self.kind = path, kind

    def partitions(self) -> list[Run]:
        """Runs that begin at resets, found by stepping over sections by their sizes.

        A compressed file is one run, as its bytes have no places of their own.
        """
        if self.path.endswith(".bz2"):
            return [Run(0, -1)]
        runs, first, at = [], 0, 0
        with _open(self.path) as f:
            end = f.size()
            while at < end:
                f.seek(at)
                head = f.read(11)
                if head[0] == RESET and at - first >= PART_BYTES:
                    runs.append(Run(first, at))
                    first = at
                if head[0] >= ALONE:
                    at += 1
                    continue
                size, used = varint(head, 1)
                at += used + size
        return [*runs, Run(first, end)]

    def _data(self, run: Run) -> bytes:
        with _open(self.path) as f:
            if run.end < 0:
                return bz2.decompress(f.read())
            f.seek(run.start)
            return f.read(run.end - run.start)

    def read(self, partition: Run) -> Iterator[pa.RecordBatch]:
        return in_batches(self._rows(partition), self.kind)

    def _rows(self, partition: Run) -> Iterator[tuple]:
        data, at, stream = self._data(partition), 0, DeltaStream()
        while at < len(data):
            mark = data[at]
            at += 1
            if mark == RESET:
                stream.reset()
            if mark >= ALONE:
                continue
            size, at = varint(data, at)
            body = data[at : at + size]
            at += size
            if mark in SECTIONS:
                # every section moves the differences on, wanted or not
                row = stream.row(SECTIONS[mark], body)
                if row is not None and SECTIONS[mark] == self.kind:
                    yield row


class _Source(DataSource):
    def schema(self) -> str:
        return SCHEMAS[self.options.get("kind", "node")]


class PbfSource(_Source):
    @classmethod
    def name(cls) -> str:
        return "entity_pbf"

    def reader(self, schema) -> PbfReader:
        return PbfReader(self.options["path"], self.options.get("kind", "node"))


class O5mSource(_Source):
    @classmethod
    def name(cls) -> str:
        return "entity_o5m"

    def reader(self, schema) -> O5mReader:
        return O5mReader(self.options["path"], self.options.get("kind", "node"))
