"""MPEG transport streams in media columns.

`mux` writes a payload as a one-program stream: program association and program
map tables, then packetised elementary packets with time stamps and random-access
flags. `demux` reads any single- or multi-program stream back: it parses the
tables, checks continuity counters, reassembles the elementary packets and keeps
their time stamps and the places of random-access points.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .pieces import byte_slices, map_in_arrow

PACKET = 188
SYNC = 0x47
PAT_PID = 0
PMT_PID = 0x1000
DATA_PID = 0x0100
PROGRAM = 1
#: Stream type of private data in packetised elementary packets, and its stream id.
PRIVATE_TYPE = 0x06
PRIVATE_STREAM = 0xBD
#: Bytes of payload in one access unit, ticks of the 90 kHz clock between units.
UNIT_BYTES = 8192
UNIT_TICKS = 3600
UNIT_MULTIPLE = 192


@lru_cache(maxsize=1)
def _crc_table() -> np.ndarray:
    """Of the polynomial 0x04C11DB7, most significant bit first."""
    t = np.arange(256, dtype=np.uint32) << 24
    for _ in range(8):
        t = np.where(t & 0x80000000, (t << 1) ^ 0x04C11DB7, t << 1).astype(np.uint32)
    return t


def section_crc(data: bytes) -> int:
    """The 32-bit check of table sections."""
    crc, t = 0xFFFFFFFF, _crc_table()
    for b in data:
        crc = ((crc << 8) & 0xFFFFFFFF) ^ int(t[(crc >> 24) ^ b])
    return crc


def _section(table_id: int, number: int, body: bytes) -> bytes:
    head = bytes([table_id]) + (0xB000 | (len(body) + 9)).to_bytes(2, "big")
    whole = head + number.to_bytes(2, "big") + b"\xc1\x00\x00" + body
    return whole + section_crc(whole).to_bytes(4, "big")


def _table_packet(pid: int, section: bytes) -> bytes:
    head = bytes([SYNC, 0x40 | pid >> 8, pid & 0xFF, 0x10, 0])
    return (head + section).ljust(PACKET, b"\xff")


@lru_cache(maxsize=1)
def _tables() -> bytes:
    pat = _section(0, 1, PROGRAM.to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big"))
    stream = bytes([PRIVATE_TYPE]) + (0xE000 | DATA_PID).to_bytes(2, "big") + b"\xf0\x00"
    pmt = _section(2, PROGRAM, (0xE000 | DATA_PID).to_bytes(2, "big") + b"\xf0\x00" + stream)
    return _table_packet(PAT_PID, pat) + _table_packet(PMT_PID, pmt)


def _stamp(mark: int, ticks: int) -> bytes:
    t = ticks & ((1 << 33) - 1)
    return bytes([mark << 4 | (t >> 30) << 1 | 1]) + ((t >> 15 & 0x7FFF) << 1 | 1).to_bytes(2, "big") + ((t & 0x7FFF) << 1 | 1).to_bytes(2, "big")


def _clock(ticks: int) -> bytes:
    """Program clock reference: 33 bits of the 90 kHz clock, no extension."""
    return ((ticks & ((1 << 33) - 1)) << 15 | 0x7E00).to_bytes(6, "big")


def mux(payload: bytes, unit_bytes: int = UNIT_BYTES) -> bytes:
    """The payload as a transport stream, one elementary packet per access unit."""
    out, counter = [_tables()], 0
    for k, at in enumerate(range(0, max(1, len(payload)), unit_bytes)):
        ticks = k * UNIT_TICKS
        pes = b"\x80\x80\x05" + _stamp(2, ticks) + payload[at : at + unit_bytes]
        unit = b"\x00\x00\x01" + bytes([PRIVATE_STREAM]) + len(pes).to_bytes(2, "big") + pes
        # the first packet has an adaptation field: random access and clock
        first = b"\x50" + _clock(ticks)
        room = PACKET - 4 - 1 - len(first)
        head, rest = unit[:room], unit[room:]
        field_ = first + b"\xff" * (room - len(head))
        out.append(
            bytes([SYNC, 0x40 | DATA_PID >> 8, DATA_PID & 0xFF, 0x30 | counter, len(field_)]) + field_ + head
        )
        counter = (counter + 1) & 15
        full = len(rest) // (PACKET - 4)
        if full:
            grid = np.empty((full, PACKET), np.uint8)
            grid[:, 0], grid[:, 1], grid[:, 2] = SYNC, DATA_PID >> 8, DATA_PID & 0xFF
            grid[:, 3] = 0x10 | (np.arange(counter, counter + full) & 15)
            grid[:, 4:] = np.frombuffer(rest, np.uint8, full * (PACKET - 4)).reshape(full, -1)
            out.append(grid.tobytes())
            counter = (counter + full) & 15
        left = rest[full * (PACKET - 4) :]
        if left:
            stuff = PACKET - 4 - len(left) - 1
            field_ = b"" if not stuff else b"\x00" + b"\xff" * (stuff - 1)
            out.append(
                bytes([SYNC, DATA_PID >> 8, DATA_PID & 0xFF, 0x30 | counter, len(field_)]) + field_ + left
            )
            counter = (counter + 1) & 15
    return b"".join(out)


@dataclass
class Demuxed:
    """What a stream holds. Faulty parts are counted and left out, never raised."""

    packets: int = 0
    lost_sync_bytes: int = 0
    bad_tables: int = 0
    continuity_errors: int = 0
    duplicate_packets: int = 0
    programs: dict[int, dict[int, int]] = field(default_factory=dict)
    #: Per elementary stream: the payload of each packet, in order.
    units: dict[int, list[bytes]] = field(default_factory=dict)
    #: Per elementary stream: presentation and decoding time stamps, in order.
    stamps: dict[int, list[tuple[int | None, int | None]]] = field(default_factory=dict)
    #: Per elementary stream: (packet number, clock or None) of random-access points.
    access: dict[int, list[tuple[int, int | None]]] = field(default_factory=dict)

    def payload(self) -> bytes:
        """The payloads of all elementary streams, by stream number."""
        return b"".join(b"".join(self.units[p]) for p in sorted(self.units))


def _read_stamp(b: bytes) -> int:
    return (b[0] >> 1 & 7) << 30 | (b[1] << 7 | b[2] >> 1) << 15 | (b[3] << 7 | b[4] >> 1)


def _read_pes(unit: bytes) -> tuple[bytes, int | None, int | None] | None:
    if len(unit) < 9 or unit[:3] != b"\x00\x00\x01":
        return None
    flags, extra = unit[7] >> 6, unit[8]
    pts = _read_stamp(unit[9:14]) if flags & 2 and extra >= 5 and len(unit) >= 14 else None
    dts = _read_stamp(unit[14:19]) if flags == 3 and extra >= 10 and len(unit) >= 19 else None
    declared = unit[4] << 8 | unit[5]
    end = 6 + declared if declared else len(unit)
    return unit[9 + extra : end], pts, dts


def _aligned(data: bytes) -> tuple[np.ndarray, int]:
    """Packets by sync byte, and the bytes skipped to find them."""
    raw = np.frombuffer(data, np.uint8)
    n = len(raw) // PACKET
    grid = raw[: n * PACKET].reshape(n, PACKET)
    if len(raw) == n * PACKET and (grid[:, 0] == SYNC).all():
        return grid, 0
    at, rows, skipped = 0, [], 0
    while at + PACKET <= len(data):
        follows = at + PACKET
        if data[at] == SYNC and (follows >= len(data) or data[follows] == SYNC or follows + PACKET > len(data)):
            rows.append(raw[at:follows])
            at = follows
        else:
            at += 1
            skipped += 1
    skipped += len(data) - at
    return (np.stack(rows) if rows else np.zeros((0, PACKET), np.uint8)), skipped


def _sections(chunks: list[tuple[bool, bytes]]) -> Iterator[bytes]:
    """Whole table sections from the packets of one table stream."""
    held = b""
    for starts, part in chunks:
        if starts:
            skip = part[0] if part else 0
            held = part[1 + skip :]
        elif held:
            held += part
        while len(held) >= 3 and held[0] != 0xFF:
            size = 3 + ((held[1] & 0x0F) << 8 | held[2])
            if len(held) < size:
                break
            yield held[:size]
            held = held[size:]


def demux(data: bytes | None) -> Demuxed:
    """Parse a stream; null and empty input give an empty result."""
    out = Demuxed()
    if not data:
        return out
    grid, out.lost_sync_bytes = _aligned(data)
    out.packets = len(grid)
    if not len(grid):
        return out
    pids = (grid[:, 1].astype(np.int32) & 0x1F) << 8 | grid[:, 2]
    starts = (grid[:, 1] & 0x40) != 0
    kinds = grid[:, 3] >> 4 & 3
    counters = grid[:, 3] & 15
    begin = np.where(kinds & 2, 5 + grid[:, 4].astype(np.int32), 4)

    def chunks(rows: np.ndarray) -> list[tuple[bool, bytes]]:
        return [(bool(starts[r]), grid[r, begin[r] :].tobytes()) for r in rows if kinds[r] & 1]

    def rows_of(pid: int) -> np.ndarray:
        return np.flatnonzero(pids == pid)

    def good(section: bytes, table: int) -> bool:
        if section[0] != table:
            return False
        if len(section) < 12 or section_crc(section) != 0:
            out.bad_tables += 1
            return False
        return True

    for pat in _sections(chunks(rows_of(PAT_PID))):
        if not good(pat, 0):
            continue
        for k in range(8, len(pat) - 4, 4):
            program = pat[k] << 8 | pat[k + 1]
            if not program:
                continue
            streams = out.programs.setdefault(program, {})
            for pmt in _sections(chunks(rows_of((pat[k + 2] & 0x1F) << 8 | pat[k + 3]))):
                if not good(pmt, 2) or (pmt[3] << 8 | pmt[4]) != program:
                    continue
                at = 12 + ((pmt[10] & 0x0F) << 8 | pmt[11])
                while at + 5 <= len(pmt) - 4:
                    streams[(pmt[at + 1] & 0x1F) << 8 | pmt[at + 2]] = pmt[at]
                    at += 5 + ((pmt[at + 3] & 0x0F) << 8 | pmt[at + 4])
    for pid in sorted({p for streams in out.programs.values() for p in streams}):
        _elementary(out, pid, rows_of(pid), grid, starts, kinds, counters, begin)
    return out


def _elementary(out, pid, rows, grid, starts, kinds, counters, begin) -> None:
    carries = (kinds[rows] & 1) != 0
    flags = np.where((kinds[rows] & 2 != 0) & (grid[rows, 4] > 0), grid[rows, 5], 0)
    # a counter moves on by one with each packet that carries payload
    own = rows[carries]
    moved = (counters[own][1:].astype(np.int32) - counters[own][:-1]) & 15
    said = (flags[carries] & 0x80) != 0
    repeat = np.zeros(len(own), bool)
    if len(own) > 1:
        repeat[1:] = (moved == 0) & (grid[own[1:], 4:] == grid[own[:-1], 4:]).all(axis=1)
        out.continuity_errors += int(((moved != 1) & ~repeat[1:] & ~said[1:]).sum())
    out.duplicate_packets += int(repeat.sum())
    own = own[~repeat]
    units: list[list[bytes]] = []
    plain = begin[own] == 4
    for k, r in enumerate(own):
        if starts[r]:
            units.append([])
        if units:
            units[-1].append(grid[r, 4:].tobytes() if plain[k] else grid[r, begin[r] :].tobytes())
    read = [x for x in map(_read_pes, map(b"".join, units)) if x is not None]
    out.units[pid] = [x[0] for x in read]
    out.stamps[pid] = [(x[1], x[2]) for x in read]
    points = []
    for r in rows[(flags & 0x40) != 0]:
        clock = None
        if grid[r, 5] & 0x10:
            clock = int.from_bytes(grid[r, 6:12].tobytes(), "big") >> 15
        points.append((int(r), clock))
    out.access[pid] = points


def describe(found: Demuxed) -> str:
    """A line that tells programs, streams, faults, time stamps and access points."""
    parts = [f"packets={found.packets}"]
    for program, streams in sorted(found.programs.items()):
        kinds = ",".join(f"{p:#06x}:{k:#04x}" for p, k in sorted(streams.items()))
        parts.append(f"program={program}[{kinds}]")
    for pid in sorted(found.units):
        pts = [p for p, _ in found.stamps[pid] if p is not None]
        span = f"{pts[0]}-{pts[-1]}" if pts else "none"
        places = hashlib.sha256(repr(found.access[pid]).encode()).hexdigest()[:16]
        parts.append(f"pid={pid:#06x} units={len(found.units[pid])} pts={span} access={len(found.access[pid])}:{places}")
    parts.append(
        f"continuity={found.continuity_errors} repeated={found.duplicate_packets} "
        f"tables={found.bad_tables} unsynced={found.lost_sync_bytes}"
    )
    return "; ".join(parts)


def padded(text: str | None) -> bytes:
    """UTF-8 with spaces up to a positive multiple of UNIT_MULTIPLE bytes."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw.ljust(max(UNIT_MULTIPLE, -(-len(raw) // UNIT_MULTIPLE) * UNIT_MULTIPLE), b" ")


def store_texts(df: DataFrame, *, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, n_bytes, media): each whole text as a transport stream.

    Null texts are empty, hence one unit of spaces; equal texts give equal streams;
    null ids, repeated rows and empty tables pass through; other columns stay out.
    """
    id_type = df.schema[id_col].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n in byte_slices(batch.column(1)):
                own = batch.column(1).slice(at, n).to_pylist()
                sizes = [len((t or "").encode("utf-8", "surrogatepass")) for t in own]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(own)),
                        pa.array(sizes, pa.int64()),
                        pa.array([mux(padded(t)) for t in own], pa.binary()),
                    ],
                    names=[id_col, "n_bytes", "media"],
                )

    return map_in_arrow(df.select(id_col, text_col), write, f"`{id_col}` {id_type}, n_bytes long, media binary")


_STREAMS = pa.list_(
    pa.struct(
        [("program", pa.int64()), ("pid", pa.int64()), ("stream_type", pa.int64()), ("units", pa.int64())]
        + [("pts", pa.list_(pa.int64())), ("dts", pa.list_(pa.int64()))]
        + [("access_packets", pa.list_(pa.int64())), ("access_clocks", pa.list_(pa.int64()))]
    )
)
PARSED = (
    "payload binary, packets long, continuity_errors long, duplicate_packets long, bad_tables long, "
    "lost_sync_bytes long, streams array<struct<program: long, pid: long, stream_type: long, units: long, "
    "pts: array<long>, dts: array<long>, access_packets: array<long>, access_clocks: array<long>>>, feature string"
)


def parse_streams(df: DataFrame, *, media_col: str = "media", keep: list[str]) -> DataFrame:
    """The columns `keep` of each row with what its stream holds (PARSED).

    A null or empty stream gives no streams and an empty payload; bytes that are no
    packets are counted in lost_sync_bytes; broken tables in bad_tables.
    """
    kept = [df.schema[c] for c in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n in byte_slices(batch.column(len(keep))):
                part = batch.slice(at, n)
                found = [demux(m.as_py()) for m in part.column(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(k) for k in range(len(keep))]
                    + [pa.array([f.payload() for f in found], pa.binary())]
                    + [
                        pa.array([getattr(f, c) for f in found], pa.int64())
                        for c in ("packets", "continuity_errors", "duplicate_packets", "bad_tables", "lost_sync_bytes")
                    ]
                    + [pa.array([_streams(f) for f in found], _STREAMS), pa.array([describe(f) for f in found])],
                    names=[f.name for f in kept]
                    + ["payload", "packets", "continuity_errors", "duplicate_packets", "bad_tables"]
                    + ["lost_sync_bytes", "streams", "feature"],
                )

    return map_in_arrow(df.select(*keep, media_col), read, f"{schema}, {PARSED}" if schema else PARSED)


def _streams(found: Demuxed) -> list[dict]:
    return [
        {
            "program": program,
            "pid": pid,
            "stream_type": kind,
            "units": len(found.units[pid]),
            "pts": [p for p, _ in found.stamps[pid]],
            "dts": [d for _, d in found.stamps[pid]],
            "access_packets": [p for p, _ in found.access[pid]],
            "access_clocks": [c for _, c in found.access[pid]],
        }
        for program, streams in sorted(found.programs.items())
        for pid, kind in sorted(streams.items())
    ]
