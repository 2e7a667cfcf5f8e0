"""BPE by per-prefix dynamic programming.

BPE has a prefix property: if a symbol string is encoded as t1..tk, every prefix
t1..tj is the encoding of what it spells. So each prefix of a word has one last
token. For each position the candidates are the vocabulary entries that end there
(found with a suffix automaton of the vocabulary), and the one that counts is the
one whose pair with the last token of the remaining prefix is compatible, that is,
encoding the two spelled together gives back exactly the two. Back-pointers from
the full length give the ids.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .bpe_tables import NEVER, PairTable, PairTest, PlainPairTest, SuffixAutomaton
from .pieces import PieceTable, binaries, byte_slices, ids_of_texts, map_in_arrow, ragged, release

#: Words encoded side by side at a time; words of more symbols are encoded alone.
LANES = 1 << 14
SIDE_BY_SIDE = 64


#: The normaliser and splitter that PrefixBpe.style stands for.
LATIN_NORMALISER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
LATIN_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: Texts of these characters only are split without the library: lower-casing maps
#: each to one of them, composing changes none, and their classes are plain.
_LATIN = re.compile("[\x20-\x7e\n\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
_WHITE = re.compile("[ \n]")


def _byte_characters() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, the
    others for code points from 256 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class PrefixBpe:
    """A BPE vocabulary of a tokenizers JSON file, encoded by per-prefix DP."""

    style = {"blank_leads": False, "digits_alone": True}
    lower = True

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        model = whole["model"]
        steps = (whole.get("normalizer") or {}).get("normalizers")
        splits = (whole.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.latin = steps == LATIN_NORMALISER and splits[0].get("pattern") == {"Regex": LATIN_SPLIT}
        self.path = path
        # the library only normalises and splits, for which it needs no entries
        bare = {**whole, "added_tokens": [], "model": {**model, "vocab": {}, "merges": []}, "post_processor": None}
        self.splitter = Tokenizer.from_str(json.dumps({**bare, "truncation": None, "padding": None}))
        self.spaced = whole.get("decoder") is None
        vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ", 1)) for m in model["merges"]]
        rank: dict[tuple[int, int], int] = {}
        halves: dict[int, tuple[int, int, int]] = {}
        for r, (a, b) in enumerate(merges):
            if a in vocab and b in vocab and a + b in vocab:
                rank.setdefault((vocab[a], vocab[b]), r)
                halves.setdefault(vocab[a + b], (vocab[a], vocab[b], r))
        if model.get("ignore_merges") or model.get("continuing_subword_prefix") or model.get("byte_fallback") or model.get("dropout"):
            raise ValueError("a vocabulary with rules beside its merges")
        size = max(vocab.values(), default=-1) + 1
        self.halves = np.full((size, 3), -1, np.int32)
        if halves:
            self.halves[list(halves)] = list(halves.values())
        pairs = np.array(list(rank), np.int32).reshape(-1, 2)
        self.rank = PairTable(pairs[:, 0], pairs[:, 1], np.array(list(rank.values()), np.int32))
        made = [vocab[merges[r][0] + merges[r][1]] for r in rank.values()]
        self.joined = PairTable(pairs[:, 0], pairs[:, 1], np.array(made, np.int32))
        if len(rank) == len(halves):
            self.pair_test = PairTest(self.rank, self.halves)
        else:
            self.pair_test = PlainPairTest(self.rank, self.halves, self.merged, self.spell)
        self._name_symbols({t: i for t, i in vocab.items() if i not in halves}, model.get("end_of_word_suffix") or "")
        self._build_automaton(vocab)
        self.special = {t["content"]: t["id"] for t in whole.get("added_tokens") or []}
        texts = [""] * (max([size - 1, *self.special.values()]) + 1)
        for t, i in [*vocab.items(), *self.special.items()]:
            texts[i] = t
        self.texts = pa.array(texts, pa.string())
        longest = sorted(self.special, key=len, reverse=True)
        self.any_special = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None

    @cached_property
    def tokenizer(self):
        """The library's whole tokenizer, for vocabularies that it decodes."""
        from tokenizers import Tokenizer

        own = Tokenizer.from_file(self.path)
        own.no_truncation()
        own.no_padding()
        return own

    def _name_symbols(self, base: dict[str, int], suffix: str) -> None:
        """Which entry a character is inside a word and at its end, by code point.

        Where characters stand for bytes, those below 256 that stand for no byte
        are taken for the byte of their number.
        """
        self.symbol = {t: i for t, i in base.items() if len(t) == 1}
        final = {t[: -len(suffix)]: i for t, i in base.items() if suffix and t.endswith(suffix)} or self.symbol
        self.inside, self.final = (self._by_code_point(m) for m in (self.symbol, final))

    def _by_code_point(self, symbols: dict[str, int]) -> np.ndarray:
        out = np.full(max([511, *map(ord, symbols)]) + 1, -1, np.int32)
        if self.latin:
            for byte, mark in enumerate(_byte_characters()):
                out[byte] = symbols.get(mark, -1)
        for mark, i in symbols.items():
            out[ord(mark)] = i
        return out

    def _build_automaton(self, vocab: dict[str, int]) -> None:
        left, right, rank = self.halves.T
        base = rank < 0
        reached = np.ones(len(rank), bool)
        merged = np.flatnonzero(~base)
        # an entry that merging cannot reach never ends a prefix
        reached[merged] = ~self.pair_test.straddled(left[merged], right[merged], before=-1)
        spelled: dict[int, tuple[int, ...]] = {int(i): (int(i),) for i in np.flatnonzero(base)}
        later = []
        for i in merged[np.argsort(rank[merged], kind="stable")].tolist():
            a, b = int(left[i]), int(right[i])
            if a not in spelled or b not in spelled:
                later.append(i)
                continue
            spelled[i] = spelled[a] + spelled[b]
            reached[i] &= reached[a] and reached[b]
        if later:
            raise ValueError("a merge comes before its halves: not a BPE vocabulary")
        #: Symbols of each entry.
        self.long = np.zeros(len(rank), np.int32)
        self.long[list(spelled)] = [len(w) for w in spelled.values()]
        self.automaton = SuffixAutomaton([(spelled[i], i) for i in vocab.values() if reached[i]])

    def spell(self, token: int) -> tuple[int, ...]:
        """The symbols of an entry."""
        left, right, rank = self.halves[token].tolist()
        return (token,) if rank < 0 else self.spell(left) + self.spell(right)

    def merged(self, symbols: list[int]) -> list[int]:
        """Plain merging of a symbol string, lowest rank first, leftmost first."""
        out = np.array(symbols, np.int32)
        while len(out) > 1:
            rank = self.rank.get(out[:-1], out[1:])
            rank[rank < 0] = NEVER
            k = int(rank.argmin())
            if rank[k] == NEVER:
                break
            out = np.concatenate([out[:k], self.joined.get(out[k : k + 1], out[k + 1 : k + 2]), out[k + 2 :]])
        return out.tolist()

    def compatible(self, a: int, b: int) -> bool:
        """Whether the symbols of a and b together are encoded as a, b."""
        return bool(self.pair_test(np.array([a]), np.array([b]))[0])

    def encode_symbols(self, symbols: list[int]) -> list[int]:
        """The ids of one symbol string."""
        ids, _ = self._encode_lanes(np.array(symbols, np.int32), np.zeros(1, np.int64), np.array([len(symbols)]))
        return ids.tolist()

    def _encode_lanes(
        self, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """The ids of symbol strings, longest first, by the last token of each prefix.

        All strings advance by one symbol at a time: the automaton names the entries
        that end there, longest first, and the first that is compatible with the last
        token of what remains before it is the prefix's own last token.
        """
        machine = self.automaton
        width, lanes = int(sizes[0]) if len(sizes) else 0, len(sizes)
        last = np.full((width + 1, lanes), -1, np.int32)
        state, reach = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)
        for i in range(1, width + 1):
            n = int(np.searchsorted(-sizes, -i, side="right"))
            state, reach = machine.follow(state[:n], reach[:n], symbols[starts[:n] + (i - 1)])
            entry, open_ = machine.entry[state], np.arange(n)
            while len(open_):
                at = entry[open_]
                if (at < 0).any():
                    raise ValueError("no token ends this prefix: not a BPE vocabulary")
                size, token = machine.depth[at], machine.token[at]
                fine = size <= reach[open_]
                joins = np.flatnonzero(fine & (size < i))
                fine[joins] = self.pair_test(last[i - size[joins], open_[joins]], token[joins])
                last[i, open_[fine]] = token[fine]
                open_, at = open_[~fine], at[~fine]
                entry[open_] = machine.shorter[at]
        # back from each string's end, token by token
        found, at, lane = [], sizes.astype(np.int64), np.arange(lanes)
        counts = np.zeros(lanes, np.int64)
        while len(lane):
            on = at[lane] > 0
            lane = lane[on]
            token = last[at[lane], lane]
            found.append((lane, token))
            counts[lane] += 1
            at[lane] -= self.long[token]
        ids, place = np.zeros(int(counts.sum()), np.uint32), np.cumsum(counts) - 1
        for lane, token in found:
            ids[place[lane]] = token
            place[lane] -= 1
        return ids, counts

    @cached_property
    def _single(self) -> tuple[dict[int, int], dict[int, int], list[list[int]]]:
        """Transitions and merges by pair, and the tables of states and entries, for one string at a
        time; made when a worker first meets a long one."""
        machine = self.automaton
        tables = (machine.link, machine.depth, machine.entry, machine.shorter, machine.token, *self.halves.T)
        return machine.transitions.pairs(), self.rank.pairs(), [t.tolist() for t in tables]

    def _apart(self, a: int, b: int) -> bool:
        """PairTest for one pair: whether no merge across the border precedes both."""
        _, ranks, (*_, left, right, made) = self._single
        before = NEVER
        while True:
            rank = ranks.get(a << 32 | b)
            if rank is not None and rank < before:
                return False
            of_a, of_b = made[a], made[b]
            if of_a < 0 and of_b < 0:
                return True
            if of_a > of_b:
                a, before = right[a], of_a
            else:
                b, before = left[b], of_b + 1

    def _encode_alone(self, symbols: np.ndarray) -> np.ndarray:
        """The same for one long string, a symbol at a time, in plain numbers."""
        moves, _, (link, depth, entry, shorter, token, *_) = self._single
        apart = self._apart if type(self.pair_test) is PairTest else self.compatible
        last = [-1] * (len(symbols) + 1)
        state = reach = 0
        for i, symbol in enumerate(symbols.tolist(), 1):
            to = moves.get(state << 32 | symbol)
            while to is None:
                state = link[state]
                if state < 0:
                    raise ValueError("a symbol is in no entry: not a BPE vocabulary")
                reach = depth[state]
                to = moves.get(state << 32 | symbol)
            state, reach = to, reach + 1
            at = entry[state]
            while at >= 0:
                size = depth[at]
                if size <= reach and (size == i or apart(last[i - size], token[at])):
                    break
                at = shorter[at]
            if at < 0:
                raise ValueError("no token ends this prefix: not a BPE vocabulary")
            last[i] = token[at]
        long, out, at = self.long, [], len(symbols)
        while at:
            out.append(last[at])
            at -= int(long[last[at]])
        return np.array(out[::-1], np.uint32)

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces in one array, and how many each has.

        A line feed and a special string are that string; other white space has no
        ids. Pieces of Latin letters stand for their bytes.
        """
        counts = np.zeros(len(pieces), np.int64)
        special: dict[int, int] = {}
        words = pieces
        if self.latin:
            words = [p if p.isascii() or not _LATIN.fullmatch(p) else p.encode().decode("latin-1") for p in pieces]
        for k, p in enumerate(pieces):
            if p[:1] == "\n" and p[1:] in self.special:
                special[k] = self.special[p[1:]]
        gone = [k for k, p in enumerate(pieces) if k in special or (self.latin and p[:1] in (" ", "\n"))]
        if gone:
            words = words.copy() if words is pieces else words
            for k in gone:
                words[k] = ""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        marks = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        symbols = self.inside[marks]
        ends = np.cumsum(sizes)
        filled = sizes > 0
        symbols[ends[filled] - 1] = self.final[marks[ends[filled] - 1]]
        if (symbols < 0).any():
            raise ValueError("a character is no symbol of the vocabulary")
        starts = ends - sizes
        order = np.argsort(-sizes, kind="stable")
        long = int(np.searchsorted(-sizes[order], -SIDE_BY_SIDE, side="left"))
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for k in order[:long].tolist():
            own = self._encode_alone(symbols[starts[k] : ends[k]])
            parts.append((np.array([k]), own, np.array([len(own)])))
        for low in range(long, len(order), LANES):
            lanes = order[low : low + LANES]
            parts.append((lanes, *self._encode_lanes(symbols, starts[lanes], sizes[lanes])))
        for which, _, own in parts:
            counts[which] = own
        for k in special:
            counts[k] = 1
        begin = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), np.uint32)
        for which, ids, own in parts:
            out[ragged(begin[which], own)] = ids
        for k, i in special.items():
            out[begin[k]] = i
        return out, counts

    def plain(self, text: str) -> bool:
        """Whether the text is split without the library; special strings are not."""
        return self.latin and _LATIN.fullmatch(text) is not None and not self._has_special(text)

    def _has_special(self, text: str) -> bool:
        return self.any_special is not None and self.any_special.search(text) is not None

    def parts(self, text: str, most: int) -> Iterator[str]:
        """Parts of about `most` characters: white space separates pieces and is in none."""
        at = 0
        while self.latin and len(text) - at > most:
            found = _WHITE.search(text, at + most)
            if found is None:
                break
            yield text[at : found.start()]
            at = found.start()
        yield text[at:]

    def cut(self, text: str) -> Iterator[list[str]]:
        """The pieces of a text.

        Special strings are found before all else, leftmost first and of those that
        begin together the longest; each is a piece of its own after a line feed.
        """
        if self.any_special is None:
            yield from self._plain(text)
            return
        at = 0
        for found in self.any_special.finditer(text):
            if found.start() > at:
                yield from self._plain(text[at : found.start()])
            yield ["\n" + found.group()]
            at = found.end()
        if at < len(text):
            yield from self._plain(text[at:] if at else text)

    def _plain(self, text: str) -> Iterator[list[str]]:
        """Pieces of text without special strings: normalise, then pre-tokenise."""
        tk = self.splitter
        if tk.normalizer is not None:
            text = tk.normalizer.normalize_str(text)
        yield [p for p, _ in tk.pre_tokenizer.pre_tokenize_str(text)] if tk.pre_tokenizer is not None else [text]

    def decoded(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """What the library's decode(ids, skip_special_tokens=False) gives for each text."""
        ends = np.concatenate([[0], np.cumsum(counts)])
        if self.spaced:
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), self.texts.take(pa.array(ids)))
            return pc.binary_join(lists, " ")
        own = ids.tolist()
        runs = [own[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        return pa.array(self.tokenizer.decode_batch(runs, skip_special_tokens=False), pa.string())


@lru_cache(maxsize=2)
def vocabulary(path: str) -> PrefixBpe:
    """The vocabulary's flat tables, kept by a worker; pieces' ids go with their task."""
    own = PrefixBpe(path)
    release()
    return own


def encode_text(bpe: PrefixBpe, text: str) -> list[int]:
    """Ids of a whole text."""
    return ids_of_texts(PieceTable(bpe.encode_pieces), bpe, [text])[0].tolist()


def decode_ids(bpe: PrefixBpe, ids: list[int]) -> str:
    """The text of ids, special strings included."""
    return bpe.decoded(np.array(ids, np.uint32), np.array([len(ids)]))[0].as_py()


def encode_documents(
    df: DataFrame, path: str, *, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """One row (id, ids binary, n_tokens, decoded) per input row.

    `ids` holds little-endian unsigned 32-bit integers. A null text is empty (no
    ids, decoded ''); null ids, repeated rows and empty tables pass through; other
    columns are not read. Long texts are encoded whole, in parts that end at white
    space, and equal pieces once per task while its bounded table lasts.
    """
    id_type = df.schema[id_col].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        table = PieceTable(bpe.encode_pieces)
        for batch in batches:
            for at, n in byte_slices(batch.column(1)):
                ids, counts = ids_of_texts(table, bpe, batch.column(1).slice(at, n).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, n),
                        binaries(ids, counts, "<u4"),
                        pa.array(counts, pa.int64()),
                        bpe.decoded(ids, counts),
                    ],
                    names=[id_col, "ids", "n_tokens", "decoded"],
                )

    return map_in_arrow(
        df.select(id_col, text_col), encode, f"`{id_col}` {id_type}, ids binary, n_tokens long, decoded string"
    )
