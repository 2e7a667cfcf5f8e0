"""Resampling, packing and collocations against plain Python."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from terraweave.llm import collocations, packing, queries, resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_resample(docs, targets, n_words=1, buckets=resampling.BUCKETS, least=20, percent=10):
    """{doc_id: (n_features, weight, score, rank)} of docs with distinct ids."""

    def grams(text):
        w = WORD.findall(lowered(text))
        return len(w), [" ".join(w[i : i + k]) for k in range(1, n_words + 1) for i in range(len(w) - k + 1)]

    def bucket(g):
        return zlib.crc32(g.encode()) % buckets

    s = Counter(bucket(g) for _, t in docs for g in grams(t)[1])
    t = Counter(bucket(g) for x in targets for g in grams(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)
    ]
    out, fit = {}, []
    for i, text in docs:
        n, own = grams(text)
        weight = sum(gain[bucket(g)] for g in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[i] = (len(own), weight, score)
        if n >= least:
            fit.append((-score, i))
    rank = {i: k + 1 for k, (_, i) in enumerate(sorted(fit)[: percent * len(fit) // 100])}
    return {i: (*v, rank.get(i)) for i, v in out.items()}


def test_op12_whole_table(spark, data):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    targets = [r.text for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    got = {r.doc_id: tuple(r)[1:] for r in queries.op12_importance_resampling(spark, data).collect()}
    assert got == brute_resample(docs, targets)


ODD = [
    (1, None),
    (2, ""),
    (3, "Été ÀB été straße 漢字 x1 " * 9),
    (4, "one two three " * 4000),
    (5, "  ...  "),
    (6, "A\x00b-c_d " * 8),
    (7, "one two three"),
]


@pytest.mark.parametrize("n_words", [1, 2, 3])
def test_resample_odd_rows(spark, n_words):
    df = spark.createDataFrame([(i, t, 0, 1.5) for i, t in ODD], "doc_id long, text string, score int, bucket double")
    aim = spark.createDataFrame([("one two",), (None,), ("漢字 été",)], "text string")
    got = resampling.resample(df, aim, most_words=n_words, least_words=2, percent=50)
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == brute_resample(
        ODD, ["one two", None, "漢字 été"], n_words=n_words, least=2, percent=50
    )


def test_resample_ties_repeats_and_empty_tables(spark):
    twice = [(5, "a b c"), (5, "a b c"), (None, "a b"), (None, None)]
    df = spark.createDataFrame(twice, "doc_id long, text string")
    none = df.limit(0)
    got = resampling.resample(df, none, least_words=1, percent=100).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3] and len(got) == 4
    assert resampling.resample(none, df).collect() == []
    # one score for all rows: numbered by id within it
    even = spark.range(50).select(F.col("id").alias("doc_id"), F.lit(7).cast("long").alias("score"), F.lit(3).cast("long").alias("n_words"))
    even = even.withColumn("n_features", F.col("n_words")).withColumn("weight", F.col("score"))
    ranks = {r.doc_id: r["rank"] for r in resampling.draw(even, least_words=3, percent=30).collect()}
    assert ranks == {i: i + 1 if i < 15 else None for i in range(50)}


def check_pieces(rows, whole, window=1024):
    """All ids of all documents in one piece each, gapless sequences, no padding to speak of.

    `whole` is the list of (doc_id, ids); rows have doc_id, start, length, ids, doc_tokens, sequence_id, offset.
    """
    ids_of = {}
    for r in sorted(rows, key=lambda r: (repr(r.doc_id), r.start)):
        held = ids_of.setdefault(r.doc_id, [])
        assert r.start == len(held) and r.length == len(r.ids) // 4 > 0
        held.extend(struct.unpack(f"<{r.length}I", r.ids))
    assert ids_of == dict(whole)
    assert {r.doc_id: r.doc_tokens for r in rows} == {i: len(x) for i, x in whole}
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    padding = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
        padding += 0 if at.bit_count() == 1 else window - at
    return padding, sequences


def test_op13_whole_table(spark, data):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{data}/documents.parquet").collect()
    whole = {r.doc_id: [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0] for r in docs}
    pieces = packing.pack_documents(spark.read.parquet(f"{data}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    padding, _ = check_pieces(pieces.collect(), list(whole.items()))
    assert padding == 0
    for r in queries.op13_pack_windows(spark, data).collect():
        own = whole[r.doc_id]
        assert r.doc_tokens == len(own)
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *own[r.start : r.start + r.length]))


def test_pack_odd_rows(spark):
    rows = [(1, None, 5), (2, "", 6), (3, "word " * 9000, 7), (4, "<|endoftext|> ß 漢", 8), *((10 + k, "a b c " * (k % 7), k) for k in range(60))]
    df = spark.createDataFrame(rows, "doc_id long, text string, sequence_id int").repartition(2)
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    whole = [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]) for i, t, _ in rows]
    for window, pool in ((64, 100), (1024, 50), (100, 1 << 20)):
        pieces = packing.pack_documents(df, path, end_id=0, window=window, pool_ids=pool)
        padding, made = check_pieces(pieces.collect(), whole, window)
        assert padding == 0
        read = {r.sequence_id: r for r in packing.sequences(pieces, window=window, pad_id=7).collect()}
        for k, own in made.items():
            joined = b"".join(r.ids for r in sorted(own, key=lambda r: r.offset))
            assert read[k].n_tokens * 4 == len(joined) and read[k].ids == joined
    assert packing.pack_documents(df.limit(0), path, end_id=0).collect() == []
    same = spark.createDataFrame([(None, "x"), (None, "x"), (1, "x"), (1, "x")], "doc_id long, text string")
    assert len(packing.pack_documents(same, path, end_id=None).collect()) == 4


def test_sequences_are_padded(spark):
    df = spark.createDataFrame([(1, 0, 3, bytes(range(12))), (2, 0, 4, bytes(16))], "sequence_id long, offset long, length long, ids binary")
    got = {r.sequence_id: r.ids for r in packing.sequences(df, window=8, pad_id=9).collect()}
    assert got == {1: bytes(range(12)) + b"\x09\0\0\0" * 5, 2: bytes(16)}


@given(st.integers(1, 60), st.dictionaries(st.integers(1, 40), st.integers(1, 5), max_size=6))
@settings(max_examples=200, deadline=None)
def test_fill_is_closest(target, counts):
    sums = {0}
    for n, k in counts.items():
        sums = {s + n * j for s in sums for j in range(k + 1)}
    total, need = packing.fill(target, counts)
    assert total == max(s for s in sums if s <= target) == sum(n * k for n, k in need.items())
    assert all(k <= counts[n] for n, k in need.items())


def brute_collocations(rows, least, most=5, covered=100, top=2000):
    """The contract, phrase by phrase, over (lang, text)."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, most + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    found = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    gone = set()
    for (lang, longer), b in found.items():
        for k in range(2, len(longer)):
            for i in range(len(longer) - k + 1):
                short = (lang, longer[i : i + k])
                if short in found and 100 * b >= covered * found[short]:
                    gone.add(short)
    scored = {}
    for (lang, p), a in found.items():
        if (lang, p) not in gone:
            cuts = []
            for k in range(1, len(p)):
                left, right = f[lang, p[:k]], f[lang, p[k:]]
                cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
            s, _, left, right = min(cuts)
            scored.setdefault(lang, []).append((-s, -a, " ".join(p).encode(), left, right))
    return {
        (lang, k + 1, p.decode(), -a, left, right, n[lang], -s)
        for lang, own in scored.items()
        for k, (s, a, p, left, right) in enumerate(sorted(own)[:top])
    }


def told(df):
    return {(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect()}


@pytest.mark.parametrize("options", [{}, {"least": 3, "covered": 60, "top": 50}, {"least": 2, "most": 3}, {"least": 4, "most": 2}])
def test_collocations_of_documents(spark, data, options):
    df = spark.read.parquet(f"{data}/documents.parquet")
    least = options.get("least", 8)
    got = collocations.collocations(
        df, least_count=least, most_words=options.get("most", 5), covered=options.get("covered", 100), top=options.get("top", 2000), shard_words=9000, bucket_keys=20_000
    )
    rows = [(r.lang, r.text) for r in df.select("lang", "text").collect()]
    want = brute_collocations(rows, **({"least": least} | options))
    assert want and told(got) == want


def test_collocations_odd_rows(spark):
    rng = random.Random(4)
    words = ["the", "The", "of", "ÉT", "ét", "漢字", "\x00", "a-b", "x"]
    rows = [(None, "a b, a b. a b! A\tB"), ("und", "a b"), ("en", None), ("en", ""), ("en", " . ,;\r\n"), ("x", "b a " * 3000)]
    rows += [(rng.choice(["en", "de"]), "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", ". ", "\n", " "]) for _ in range(rng.randrange(90)))) for _ in range(60)]
    df = spark.createDataFrame([(a, b, 1, 2) for a, b in rows], "lang string, text string, shard int, n int").repartition(3)
    for shard_words in (50, 1 << 20):
        assert told(collocations.collocations(df, least_count=3, shard_words=shard_words)) == brute_collocations(rows, 3)
    assert collocations.collocations(df.limit(0)).collect() == []
    assert collocations.collocations(df.filter("lang = 'en'"), least_count=10**6).collect() == []


@given(st.lists(st.integers(0, 700), max_size=300), st.lists(st.integers(0, 700), max_size=300))
@settings(max_examples=60, deadline=None)
def test_bitmaps(a, b):
    span = 800
    one, two = (collocations.Bitmap.of(span, np.unique(np.array(x, np.int64))) for x in (a, b))
    assert one.count == len(set(a)) and one.positions().tolist() == sorted(set(a))
    assert (one & two).positions().tolist() == sorted(set(a) & set(b)) and (one & two).count == len(set(a) & set(b))
    assert one.shifted().positions().tolist() == sorted(x + 1 for x in set(a))


def test_dense_and_sparse_phrases_agree(monkeypatch):
    rng = np.random.default_rng(5)
    seq = np.append(rng.choice(6, 3000, p=[0.5, 0.2, 0.1, 0.1, 0.05, 0.05]) - 1, -1).astype(np.int64)
    found = []
    for sparse in (1, 32, 10**6):
        monkeypatch.setattr(collocations, "SPARSE", sparse)
        found.append(dict(collocations.Phrases(seq, 5).all(4)))
    want = Counter()
    for k in (2, 3, 4):
        for i in range(len(seq) - k + 1):
            run = tuple(seq[i : i + k].tolist())
            if min(run) >= 0:
                want[run] += 1
    assert found[0] == found[1] == found[2] == dict(want)


@given(st.lists(st.integers(0, 2**40)))
@settings(max_examples=50, deadline=None)
def test_packed_numbers(values):
    assert collocations.unpack(collocations.pack(np.array(values, np.int64))).tolist() == values
