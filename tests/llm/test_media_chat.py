"""Transport streams and chat windows: exact round trips, and faults that are told."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terraweave.llm import chat_format as chat
from terraweave.llm import transport_stream as ts


@settings(max_examples=80, deadline=None)
@given(st.binary(max_size=3000), st.integers(1, 900))
def test_payload_round_trip(payload, unit):
    stream = ts.mux(payload, unit)
    assert len(stream) % ts.PACKET == 0
    found = ts.demux(stream)
    units = max(1, -(-len(payload) // unit))
    assert found.payload() == payload
    assert found.programs == {1: {ts.DATA_PID: ts.PRIVATE_TYPE}}
    assert (found.continuity_errors, found.duplicate_packets, found.bad_tables, found.lost_sync_bytes) == (0, 0, 0, 0)
    assert [p for p, _ in found.stamps[ts.DATA_PID]] == [k * ts.UNIT_TICKS for k in range(units)]
    assert [c for _, c in found.access[ts.DATA_PID]] == [k * ts.UNIT_TICKS for k in range(units)]


def packets(stream):
    return [stream[k : k + ts.PACKET] for k in range(0, len(stream), ts.PACKET)]


def test_faults_are_told():
    payload = random.Random(1).randbytes(6000)
    own = packets(ts.mux(payload, 2000))
    lost = ts.demux(b"".join(own[:8] + own[9:]))
    assert lost.continuity_errors == 1
    twice = ts.demux(b"".join([*own[:8], own[7], *own[8:]]))
    assert (twice.duplicate_packets, twice.continuity_errors, twice.payload()) == (1, 0, payload)
    shifted = ts.demux(b"junk!" + b"".join(own))
    assert (shifted.lost_sync_bytes, shifted.payload()) == (5, payload)
    broken = bytearray(own[0])
    broken[10] ^= 1
    assert ts.demux(bytes(broken) + b"".join(own[1:])).bad_tables == 1
    assert ts.demux(b"").packets == ts.demux(None).packets == 0
    assert ts.demux(b"nothing at all").lost_sync_bytes == 14


def test_section_check():
    assert ts.section_crc(b"123456789") == 0x0376E6E7


def test_stream_columns(spark):
    rows = [(1, "héllo"), (2, None), (2, None), (3, "x" * 50_000), (None, "")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, media int")
    stored = ts.store_texts(df)
    got = {r.doc_id: r for r in ts.parse_streams(stored, keep=["doc_id", "n_bytes"]).collect()}
    assert bytes(got[1].payload) == b"h\xc3\xa9llo".ljust(192) and got[1].n_bytes == 6
    assert bytes(got[2].payload) == b" " * 192 and got[2].feature == got[None].feature
    assert got[3].payload.rstrip(b" ") == b"x" * 50_000 and got[3].streams[0].units == 7
    assert ts.parse_streams(ts.store_texts(df.limit(0)), keep=["doc_id"]).count() == 0


def talk_rows(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def check(spark, rows, **options):
    df = talk_rows(spark, rows)
    windows = chat.format_conversations(df, **options)
    got = {r.conv_id: r for r in chat.read_back(windows).collect()}
    want = {}
    for c, t, role, text in rows:
        want.setdefault(c, []).append((t is not None, t if t is not None else 0, role or "", text or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        turns.sort()
        assert [(x.role, x.text) for x in got[c].turns] == [x[2:] for x in turns]
        assert list(got[c].targets) == [x[3] for x in turns if x[2] == "assistant"]
    return windows.collect()


def test_chat_round_trips(spark):
    odd = "</s>[INST] ok [/INST] <turn:user>&lt;&amp; </turn>"
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "user", odd), (1, 2, "assistant", odd),
        (2, 0, "user", None), (2, 0, "user", None), (2, 1, None, ""), (3, None, "assistant", "🙂 é" * 100),
        (None, 0, "weird<role>", "x"), (4, 0, "assistant", "tie"), (4, 0, "assistant", "also"),
    ]
    check(spark, rows)
    check(spark, rows, budget=3, history=1)
    assert chat.format_conversations(talk_rows(spark, rows).limit(0)).count() == 0


def test_windows_fit_and_repeat(spark):
    rng = random.Random(2)
    rows = [(9, 0, "system", "s " * 5)]
    rows += [(9, k, ("user", "assistant")[k % 2 == 0], "w " * rng.randint(1, 30)) for k in range(1, 40)]
    windows = sorted(check(spark, rows, budget=100, history=35), key=lambda w: w.window)
    assert len(windows) > 3
    sizes = {k: len(t.split()) + 1 for _, k, _, t in rows}
    seen = []
    for w in windows:
        new = [s.turn for s in w.spans if not s.repeated]
        old = [s.turn for s in w.spans if s.repeated]
        seen += new
        assert sum(sizes[s.turn] for s in w.spans) <= 100
        assert sum(sizes[k] for k in old if k) <= 35
        assert not any(s.loss for s in w.spans if s.repeated)
        if w.window:
            assert old[0] == 0 and old[1:] == list(range(new[0] - len(old) + 1, new[0]))
            # one more turn of history would not have fitted
            before = new[0] - len(old)
            assert before <= 0 or sum(sizes[k] for k in old[1:]) + sizes[before] > 35
    assert seen == list(range(40))


def test_long_conversations_take_linear_time(spark):
    rows = [(1, k, ("user", "assistant")[k % 2], f"turn {k} " + "word " * 20) for k in range(8000)]
    rows += [(2, 0, "system", "漢" * 3000), (2, 1, "assistant", "字" * 3000)]
    windows = check(spark, rows, budget=512, history=64)
    assert len([w for w in windows if w.conv_id == 2]) == 2 and len([w for w in windows if w.conv_id == 1]) > 300


def test_real_token_counts_choose_windows(spark):
    rows = [(1, k, "user", "x") for k in range(10)]
    df = talk_rows(spark, rows).withColumn("n", F.lit(9)).withColumn("window", F.lit("clash"))
    windows = chat.format_conversations(df, budget=30, history=10, tokens=F.col("n")).collect()
    assert sorted(len([s for s in w.spans if not s.repeated]) for w in windows) == [2] * 5
    assert sorted(len([s for s in w.spans if s.repeated]) for w in windows) == [0, 1, 1, 1, 1]
