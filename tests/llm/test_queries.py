"""The registered queries, over whole tables, against libraries and plain Python."""

import hashlib
import re
import struct
import zlib

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from terraweave.llm import chat_format, queries, transport_stream

from .test_dedup_clean import brute_components, brute_leaks


@pytest.fixture(scope="module")
def texts(spark, data):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}


def rows(spark, data, name):
    return {r.doc_id: r for r in queries.QUERIES[name](spark, data).collect()}


def elementary(stream):
    """The data stream's payload, read without the engine: packets, then elementary packets."""
    units = []
    for k in range(0, len(stream), 188):
        packet = stream[k : k + 188]
        assert packet[0] == 0x47
        pid, start = (packet[1] & 0x1F) << 8 | packet[2], packet[1] & 0x40
        if pid != transport_stream.DATA_PID or not packet[3] & 0x10:
            continue
        at = 5 + packet[4] if packet[3] & 0x20 else 4
        if start:
            units.append(b"")
        units[-1] += packet[at:]
    out = b""
    for unit in units:
        assert unit[:3] == b"\0\0\1"
        size, header = int.from_bytes(unit[4:6], "big"), unit[8]
        out += unit[9 + header : 6 + size if size else None]
    return out


def test_op1(spark, data, texts):
    got = rows(spark, data, "op1_transport_streams")
    assert set(got) == set(texts)
    for i, t in texts.items():
        raw = (t or "").encode()
        payload = raw.ljust(max(192, -(-len(raw) // 192) * 192))
        stream = transport_stream.mux(payload)
        assert elementary(stream) == payload
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.media_bytes) == (len(raw), len(payload), len(stream))
        assert (r.payload_sha256, r.media_sha256) == (hashlib.sha256(payload).hexdigest(), hashlib.sha256(stream).hexdigest())
        assert r.tail_crc32 == zlib.crc32(payload[-16:]) and r.continuity_errors == 0


def test_op2(spark, data, texts):
    got = queries.op2_secret_scan(spark, data).collect()
    found = {}
    for r in got:
        assert texts[r.doc_id][r.start : r.start + len(r.candidate)] == r.candidate and 0 <= r.probability <= 1
        assert r.is_secret == (r.probability >= 0.5)
        found.setdefault(r.doc_id, []).append((r.start, r.start + len(r.candidate)))
    for i, t in texts.items():
        # every long run with a digit lies in a candidate
        for m in re.finditer(r"[A-Za-z0-9_+/\-]{12,}", t or ""):
            if re.search("[0-9]", m.group()):
                assert any(a <= m.start() and m.end() <= b for a, b in found.get(i, ())), (i, m.group())
        for m in re.finditer(r"\bAKIA[A-Z0-9]{16}\b", t or ""):
            assert any(r.is_secret for r in got if r.doc_id == i and m.start() <= r.start < m.end())


PLAIN = {
    "email": r"\b[a-z0-9._]+@[a-z0-9-]+(?:\.[a-z0-9-]+)*\.[a-z]{2,}\b",
    "ipv4": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d.])",
    "phone": r"\+\d{1,3} \(\d{3}\) \d{3}-\d{4}",
    "card": r"(?<!\d)\d{16}(?!\d)",
}


def test_op3(spark, data, texts):
    got = rows(spark, data, "op3_pii_surrogates")
    assert set(got) == set(texts)
    seen = {}
    for i, t in texts.items():
        r = got[i]
        if t is None:
            assert r.text is None and not r.entities
            continue
        # what stands between surrogates stands in the text, in order
        at, place = 0, 0
        for e in r.entities:
            kept = r.text[at : e.start]
            place = t.index(kept, place) + len(kept)
            at = e.start + len(e.surrogate)
            assert seen.setdefault((e.kind, e.surrogate.lower()), e.entity) == e.entity
        assert t.endswith(r.text[at:])
        kinds = [e.kind for e in r.entities]
        for kind, pattern in PLAIN.items():
            old = re.findall(pattern, t)
            assert len(old) <= kinds.count(kind), (i, kind, old)
            assert not set(old) & set(re.findall(pattern, r.text))
        if not r.entities:
            assert r.text == t


def test_op4(spark, data, texts):
    items = [tuple(r) for r in spark.read.parquet(f"{data}/benchmark.parquet").select("item_id", "text").collect()]
    got = {tuple(r) for r in queries.op4_spaced_seeds(spark, data).select("doc_id", "item_id", "matched_words").collect()}
    assert got == brute_leaks(list(texts.items()), items)


def test_op6(spark, data, texts):
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got, start = rows(spark, data, "op6_token_files"), 0
    assert set(got) == set(texts)
    for i in sorted(texts):
        ids = [*lib.encode(texts[i] or "", add_special_tokens=False).ids, 2]
        assert (got[i].start, got[i].n_tokens) == (start, len(ids))
        assert got[i].ids_crc32 == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        start += len(ids)


def test_op7(spark, data, texts):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = rows(spark, data, "op7_token_counts")
    assert set(got) == set(texts)
    for i, t in texts.items():
        n = len(model.encode(t or ""))
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 4096)


def test_op8(spark, data, texts):
    got = rows(spark, data, "op8_near_dedup")
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == brute_components(list(texts.items()), 2)
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_op9(spark, data):
    talks = {-1: [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]}
    for r in spark.read.parquet(f"{data}/conversations.parquet").collect():
        talks.setdefault(r.conv_id, []).append((r.turn, r.role or "", r.text or ""))
    got = {r.conv_id: r for r in queries.op9_chat_windows(spark, data).collect()}
    assert set(got) == set(talks)
    for i, turns in talks.items():
        turns.sort()
        told = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        learned = "".join(text for _, role, text in turns if role == "assistant")
        r = got[i]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(told.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
        assert r.formatted_chars >= len(told)


def test_op9_sql_of_many_windows(spark, data):
    import duckdb

    own = duckdb.connect()
    own.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{data}/conversations.parquet')")
    for budget, history in ((60, 25), (200, 50), (12, 3)):
        want = sorted(own.execute(chat_format.chat_sql(budget, history)).fetchall())
        got = sorted(tuple(r) for r in queries.op9_chat_windows(spark, data, budget=budget, history=history).collect())
        assert got == want


def test_op10(spark, data, texts):
    labels = {r.doc_id: r.lang for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    got = rows(spark, data, "op10_language_id")
    assert set(got) == set(texts)
    right = []
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1
        if not any(c.isalpha() for c in texts[i] or ""):
            assert r.lang_pred == "und" and r.score == 0
        else:
            assert r.lang_pred in set(labels.values())
            if r.held_out and labels[i]:
                right.append(r.lang_pred == labels[i])
    assert sum(right) >= 0.95 * len(right) > 10


def test_stages_of_empty_tables(spark, data):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{data}/documents.parquet").limit(0)
    for name, stage in p.STAGES:
        out = stage(spark, docs, data)
        assert out.count() == 0, name
        if name != p.STAGES[-1][0]:
            assert out.columns == docs.columns, name


def test_stages_of_odd_rows(spark, data):
    """Nulls in any column, repeated rows, ties, empty and very long texts."""
    import corpus_pipeline as p

    whole = spark.read.parquet(f"{data}/documents.parquet")
    some = whole.filter("text is not null").orderBy("doc_id").limit(40)
    long = some.first()
    odd = [
        (None, long.text, "en", None, None), (9001, None, None, None, None), (9002, "", "en", "x", 0),
        (9003, (long.text + " ") * 300, long.lang, None, None), (9003, (long.text + " ") * 300, long.lang, None, None),
    ]
    docs = some.union(spark.createDataFrame(odd, whole.schema))
    for name, stage in p.STAGES:
        out = stage(spark, docs, data)
        ids = [r.doc_id for r in out.select("doc_id").collect()]
        assert len(ids) <= docs.count() and set(ids) <= {r.doc_id for r in docs.select("doc_id").collect()}, name
        if name in ("pii_surrogates", "bpe_encode"):
            assert len(ids) == docs.count(), name
