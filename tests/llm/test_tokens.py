"""Tokenizing operators against the libraries, and packed files both ways."""

import hashlib
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from terraweave.llm import bpe_dp, pieces, queries, textcut, token_counts, token_files

TEXTS = [
    None, "", " ", "  a  b ", "don't it's <|endoftext|>x <|startoftext|> ΟΔΟΣ Σ İstanbul é é ½ ² 123456 \x85 a b \x1c c",
    "日本語 テスト 🙂🙂 a\n\n b", "'s 'st the'll WE'LL", "x" * 300 + " y", "​ ▁ a▁b", "<|endoftext|>",
    "a <|endoftext|> b<|endoftext|><|startoftext|>", "the quick brown fox " * 50, "\x00a \x00b a", "a\tb \t c", "é́ ́x",
    "One. Two, three... four? \x01. a. b", "a.\nb. c .d é. ñ! 5: x; ", "it's. o'clock, '. s", "a\x01. b", " a. b", "x.  y", ".", ". a", "a .",
]


def docs(spark, extra=()):
    rows = [(k, t, "clash") for k, t in enumerate([*TEXTS, *extra])]
    # a repeated row, and columns whose names clash with results
    return spark.createDataFrame([*rows, rows[3]], "doc_id long, text string, n_tokens string")


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_prefix_dp_equals_library(name):
    own, lib = bpe_dp.vocabulary(public_tokenizers.path(name)), Tokenizer.from_file(public_tokenizers.path(name))
    for t in TEXTS[1:]:
        ids = bpe_dp.encode_text(own, t)
        assert ids == lib.encode(t, add_special_tokens=False).ids
        assert bpe_dp.decode_ids(own, ids) == lib.decode(ids, skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_prefix_dp_on_any_text(text):
    path = public_tokenizers.path("word_bpe_49k.json")
    own = bpe_dp.vocabulary(path)
    assert bpe_dp.encode_text(own, text) == own.tokenizer.encode(text, add_special_tokens=False).ids


def test_each_prefix_has_one_last_token():
    own = bpe_dp.vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    for word in ("understanding", "aaaaaaaa", "xyzzyqwv", "Ġinternationalization"):
        symbols = [own.symbol[c] for c in word]
        for n in range(1, len(symbols) + 1):
            assert own.encode_symbols(symbols[:n]) == own.merged(symbols[:n])
        spelled = own.encode_symbols(symbols)
        for a, b in zip(spelled, spelled[1:], strict=False):
            assert own.compatible(a, b) and own.merged([*own.spell(a), *own.spell(b)]) == [a, b]


def test_prefix_dp_of_many_specials_and_long_words():
    path = public_tokenizers.path("word_bpe_49k.json")
    own, lib = bpe_dp.vocabulary(path), Tokenizer.from_file(path)
    for t in ("<|startoftext|>" * 100_000, "<|endoftext|>x" * 2000, "ab" * 3000 + "é" * 200 + " " + "日本" * 400):
        assert bpe_dp.encode_text(own, t) == lib.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("twice", [False, True])
def test_prefix_dp_of_small_vocabularies(tmp_path, twice):
    """Also where an entry comes from several merges."""
    from tokenizers import models

    entries = ["a", "b", "c", "ab", "bc", "abc", "ca", "aa", "aab", "cab", "bb"]
    merges = [("a", "b"), ("b", "c"), ("a", "a"), ("ab", "c"), ("c", "a"), ("b", "b"), ("aa", "b"), ("ca", "b")]
    if twice:
        merges += [("a", "bc"), ("a", "ab"), ("c", "ab")]
    whole = Tokenizer(models.BPE({t: k for k, t in enumerate(entries)}, merges))
    whole.save(str(tmp_path / "small.json"))
    own = bpe_dp.PrefixBpe(str(tmp_path / "small.json"))
    rng = np.random.default_rng(1)
    for n in range(300):
        text = "".join(rng.choice(list("abc"), 1 + n % 23))
        assert bpe_dp.encode_text(own, text) == whole.encode(text).ids


def test_long_texts_are_cut_at_white_space(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    own, lib = bpe_dp.vocabulary(path), Tokenizer.from_file(path)
    monkeypatch.setattr(pieces, "PART_CHARS", 7)
    for t in ("One don't\n\nstop   é́ ́x " * 40, "日本語テスト" * 9, "ΟΔΟΣ Σ\tİx \u0301y " * 9):
        assert bpe_dp.encode_text(own, t) == lib.encode(t, add_special_tokens=False).ids


def test_token_file_ids_of_long_and_odd_texts(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    texts = [*TEXTS[1:], "a  b \n\n c\td 's 'll''ve x's's 12 3½ \r\n", "\x00", "Ж щи, ÷×", "日本語 " * 9]
    for part in (1 << 20, 9):
        monkeypatch.setattr(pieces, "PART_CHARS", part)
        for t, ids in zip(texts, token_files.encode_batch(path, texts), strict=True):
            assert ids.tolist() == lib.encode(t, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab's'tvrel \n\t.,!1éЖ", max_size=40))
def test_token_file_ids_of_plain_texts(text):
    path = public_tokenizers.path("byte_bpe_50k.json")
    ids = token_files.encode_batch(path, [text, None, text + " "])
    lib = token_files.library(path).tokenizer
    assert [i.tolist() for i in ids] == [lib.encode(t, add_special_tokens=False).ids for t in (text, "", text + " ")]


def test_dealing_keeps_order_and_parts_hot_ids():
    dealt = token_files.Dealing(np.array([3, 7, 7, 7, 20]), -5, 39, 3)
    ids = np.repeat(np.arange(-5, 40), 50)
    tie = np.tile(np.arange(50) / 50, 45)
    shard = dealt.shard(ids, np.ones(len(ids), bool), tie)
    assert (np.diff(shard) >= 0).all() and 0 <= shard.min() and shard.max() < dealt.shards
    assert len(set(shard[ids == 7].tolist())) >= 4
    assert dealt.shard(ids, np.zeros(len(ids), bool), tie).max() == 0


def test_pieces_are_encoded_alike_when_their_table_begins_anew():
    own = bpe_dp.vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    table = pieces.PieceTable(own.encode_pieces, most=4)
    texts = [None, "a b c d e f", "f e d c b a a a", "", "xyzzy a"]
    ids, counts = pieces.ids_of_texts(table, own, texts)
    ends = np.cumsum(counts)
    for t, a, b in zip(texts, ends - counts, ends, strict=True):
        assert ids[a:b].tolist() == bpe_dp.encode_text(own, t or "")


def test_op5_query_equals_library(spark, data):
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    got = queries.op5_bpe_prefix_dp(spark, data).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        ids = lib.encode(texts[r.doc_id], add_special_tokens=False).ids
        told = lib.decode(ids, skip_special_tokens=False).encode()
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(told).hexdigest()


def test_op5_operator(spark):
    df = docs(spark)
    path = public_tokenizers.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    got = bpe_dp.encode_documents(df, path).collect()
    assert len(got) == df.count()
    for r in got:
        ids = lib.encode(TEXTS[r.doc_id] or "", add_special_tokens=False).ids
        assert bytes(r.ids) == struct.pack(f"<{len(ids)}I", *ids) and r.n_tokens == len(ids)
        assert r.decoded == lib.decode(ids, skip_special_tokens=False)
    assert bpe_dp.encode_documents(df.limit(0), path).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=80), st.data())
def test_bits_round_trip(bits, ids, data):
    own = np.array([i % (1 << bits) for i in ids], np.uint32)
    packed = token_files.pack_bits(own, bits)
    assert len(packed) == -(-len(own) * bits // 8)
    assert (token_files.unpack_bits(packed, bits, len(own)) == own).all()
    first = data.draw(st.integers(0, len(own)))
    assert (token_files.unpack_bits(packed, bits, len(own) - first, first) == own[first:]).all()


def test_bits_for():
    assert [token_files.bits_for(n) for n in (1, 2, 3, 32000, 50257, 65536, 65537)] == [1, 1, 2, 15, 16, 16, 17]
    with pytest.raises(ValueError):
        token_files.pack_bits(np.array([4]), 2)


def test_token_files(spark, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    df = docs(spark, ["long text " * 3000])
    token_files.write_token_files(df, str(tmp_path / "t"), path, end_id=2, block_ids=40, shards=3)
    got = sorted(token_files.crc32_of(token_files.read_token_files(spark, str(tmp_path / "t"))).collect())
    at = 0
    texts = [*TEXTS, "long text " * 3000]
    order = sorted([*range(len(texts)), 3])
    assert [r.doc_id for r in got] == order
    for r in got:
        ids = [*lib.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens) == (at, len(ids))
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        at += len(ids)
    some = token_files.read_token_files(spark, str(tmp_path / "t"), [5]).collect()
    assert [(r.doc_id, len(r.ids) // 4, r.start) for r in some] == [(r.doc_id, r.n_tokens, r.start) for r in got if r.doc_id == 5]
    token_files.write_token_files(df.limit(0), str(tmp_path / "e"), path, end_id=2)
    assert token_files.read_token_files(spark, str(tmp_path / "e")).count() == 0


def test_token_files_without_end(spark, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    df = spark.createDataFrame([(None, "x y"), (2, None)], "doc_id long, text string")
    token_files.write_token_files(df, str(tmp_path / "t"), path, end_id=None)
    got = token_files.crc32_of(token_files.read_token_files(spark, str(tmp_path / "t"))).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == [("2", 0), ("None", 2)]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=" ab\n▁", max_size=30), st.integers(1, 6))
def test_cuts_join_again(text, limit):
    assert "".join(textcut.parts(text, limit)) == text
    assert " ".join(textcut.segments(text)) == text


def test_batches_are_of_equal_bytes():
    texts = ["a" * 30, "é" * 30, "漢" * 30] * 5
    found = list(textcut.by_bytes(enumerate(texts), 100))
    assert [k for keys, _ in found for k in keys] == list(range(15))
    assert all(100 <= sum(len(t.encode()) for t in own) < 190 for _, own in found[:-1])


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json"])
def test_parts_of_unspaced_texts_have_the_tokens_of_the_whole(name):
    encoder = token_counts.length_encoder(public_tokenizers.path(name))
    rng = np.random.default_rng(4)
    chars = list("漢字仮名交じり文の例でした日本語中国語。、！？\n「」a é7") + ["। ", "ا،", "\n\n", "。。"]
    for n in (50, 400, 3000):
        text = "".join(rng.choice(chars, n))
        parts = list(encoder.parts(text, 20))
        assert sum(encoder.counts([p for p, _ in parts])) - sum(x for _, x in parts) == encoder.counts([text])[0]
        assert n < 400 or len(parts) > 5
    unspaced = "漢字仮名交じり文。" * 5000
    assert max(len(p) for p, _ in encoder.parts(unspaced, 1000)) < 1100

@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_counts(spark, name):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(model.encode(t))
    else:
        lib = Tokenizer.from_file(path)
        count = lambda t: len(lib.encode(t, add_special_tokens=False).ids)
    long = "the quick  brown\nfox jumps " * 2000
    df = docs(spark, [long])
    got = token_counts.count_tokens(df, path, limit=100, part_chars=64).collect()
    texts = [*TEXTS, long]
    assert len(got) == len(texts) + 1
    for r in got:
        t = texts[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), count(t), count(t) > 100)
    assert token_counts.count_tokens(df.limit(0), path).count() == 0


def test_long_words_take_no_longer_than_many_short_ones():
    """A run without blanks: equal ids, within 20 times the library's time."""
    import random
    import time

    path = public_tokenizers.path("word_bpe_49k.json")
    bpe, library = bpe_dp.vocabulary(path), Tokenizer.from_file(path)
    rng = random.Random(3)
    for pool, n in (("abcdefghijklmnopqrstuvwxyz", 1_000_000), ("etaoin shrdlu".replace(" ", ""), 300_000), ("漢字仮名交文例", 20_000), ("ab", 65)):
        text = "".join(rng.choices(pool, k=n))
        began = time.perf_counter()
        want = library.encode(text, add_special_tokens=False).ids
        took = time.perf_counter() - began
        bpe.encode_symbols([0])
        began = time.perf_counter()
        assert bpe_dp.encode_text(bpe, text) == want
        assert time.perf_counter() - began < 20 * took + 2
