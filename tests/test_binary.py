"""Binary dumps, from bytes made here."""

import zlib

from terraweave.sources import binary, formats


def vint(n):
    n &= (1 << 64) - 1
    out = b""
    while n > 0x7F:
        out += bytes([n & 0x7F | 0x80])
        n >>= 7
    return out + bytes([n])


def zig(n):
    return vint(n << 1 ^ n >> 63)


def num(field, n):
    return vint(field << 3) + vint(n)


def raw(field, data):
    return vint(field << 3 | 2) + vint(len(data)) + data


def block(kind, body, packed=True):
    blob = raw(3, zlib.compress(body)) if packed else raw(1, body)
    head = raw(1, kind) + num(3, len(blob))
    return len(head).to_bytes(4, "big") + head + blob


def pbf():
    strings = b"".join(raw(1, s) for s in (b"", b"name", "grün".encode(), b"ann", b"outer", b"type", b"route"))
    info = raw(1, vint(3) + vint(1)) + raw(2, zig(1555936496) + zig(4)) + raw(3, zig(5) + zig(0)) + raw(4, zig(7) + zig(0)) + raw(5, zig(3) + zig(0))
    dense = (
        raw(1, zig(10) + zig(-3)) + raw(5, info) + raw(8, zig(480000000) + zig(5)) + raw(9, zig(75100000) + zig(-5))
        + raw(10, vint(1) + vint(2) + vint(0) + vint(0))
    )
    one = num(1, 40) + raw(2, vint(1)) + raw(3, vint(2)) + num(8, 20) + num(9, 40)
    way = num(1, 21) + raw(2, vint(1)) + raw(3, vint(2)) + raw(4, num(1, 2) + num(2, 99) + num(6, 0)) + raw(8, zig(10) + zig(-3) + zig(3))
    rel = num(1, 5) + raw(2, vint(5)) + raw(3, vint(6)) + raw(8, vint(4) + vint(0)) + raw(9, zig(21) + zig(-11)) + raw(10, vint(1) + vint(0))
    body = raw(1, strings) + raw(2, raw(2, dense) + raw(1, one)) + raw(2, raw(3, way)) + raw(2, raw(4, rel))
    return block(b"OSMHeader", b"") + block(b"OSMData", body) + block(b"OSMData", raw(1, strings) + raw(2, raw(3, way)), packed=False)


def test_pbf(spark, tmp_path):
    path = tmp_path / "a.pbf"
    path.write_bytes(pbf())
    n, w, r = (sorted(tuple(x) for x in formats.read_entities(spark, str(path), k).collect()) for k in ("node", "way", "relation"))
    assert [x[:3] for x in n] == [(7, 7.5099995, 48.0000005), (10, 7.51, 48.0), (20, 2e-6, 1e-6)]
    assert n[1][3] == [("name", "grün")] and n[1][4:] == (5, 1555936496, "ann", 7, 3, True)
    assert n[0][3] == [] and n[0][4:] == (5, 1555936500, "ann", 7, 1, True) and n[2][4:] == (0, 0, "", 0, 0, True)
    assert len(w) == 2 and w[0] == (21, [10, 7, 10], [("name", "grün")], 0, 99, "", 0, 2, False)
    assert r[0][:3] == (5, [("way", 21, "outer"), ("node", 10, "")], [("type", "route")])


def section(kind, body):
    return bytes([kind]) + vint(len(body)) + body


def o5m():
    pair = b"\0name\0gr\xc3\xbcn\0"
    meta = vint(2) + zig(1000) + zig(5) + b"\0" + vint(7) + b"\0ann\0"
    first = section(0x10, zig(10) + meta + zig(75100000) + zig(480000000) + pair)
    # the same user and tag again, by their places in the table
    second = section(0x10, zig(1) + vint(1) + zig(1) + zig(0) + vint(2) + zig(10) + zig(-10) + vint(1))
    refs = zig(10) + zig(1)
    way = section(0x11, zig(3) + vint(0) + vint(len(refs)) + refs + vint(1))
    members = zig(3) + b"\0" + b"1outer\0" + zig(10) + b"\0" + b"0\0"
    rel = section(0x12, zig(9) + vint(0) + vint(len(members)) + members)
    return b"\xff\xe0\x04o5m2" + first + second + way + rel + b"\xff" + section(0x10, zig(10) + vint(0)) + b"\xfe"


def test_o5m(spark, tmp_path):
    path = tmp_path / "a.o5m"
    path.write_bytes(o5m())
    n, w, r = ([tuple(x) for x in formats.read_entities(spark, str(path), k).collect()] for k in ("node", "way", "relation"))
    assert n == [
        (10, 7.51, 48.0, [("name", "grün")], 5, 1000, "ann", 7, 2, True),
        (11, 7.510001, 47.999999, [("name", "grün")], 5, 1001, "ann", 7, 1, True),
    ]
    assert w == [(3, [10, 11], [("name", "grün")], 0, 0, "", 0, 0, True)]
    assert r == [(9, [("way", 3, "outer"), ("node", 10, "")], [], 0, 0, "", 0, 0, True)]


def test_o5m_is_read_in_runs_from_resets(tmp_path, monkeypatch):
    path = tmp_path / "a.o5m"
    path.write_bytes(o5m() * 3)
    whole = {}
    for size in (1 << 20, 1):
        monkeypatch.setattr(binary, "PART_BYTES", size)
        for kind in binary.KINDS:
            reader = binary.O5mReader(str(path), kind)
            runs = reader.partitions()
            assert len(runs) == (1 if size > 1 else 6) and runs[-1].end == path.stat().st_size
            rows = [r for run in runs for batch in reader.read(run) for r in batch.to_pylist()]
            assert whole.setdefault(kind, rows) == rows and len(rows) == (6 if kind == "node" else 3)


def test_empty_binary_files(spark, tmp_path):
    (tmp_path / "e.pbf").write_bytes(block(b"OSMHeader", b""))
    (tmp_path / "e.o5m").write_bytes(b"\xff\xe0\x04o5m2\xfe")
    for name in ("e.pbf", "e.o5m"):
        assert formats.read_entities(spark, str(tmp_path / name), "node").count() == 0
