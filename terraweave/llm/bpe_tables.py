"""Flat tables of a BPE vocabulary: suffix automaton, merges, and pair tests.

All are numpy arrays that are read for many words at once.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: An odd multiplier that spreads keys over a hash table's slots.
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
#: Answers of pair tests that are kept: a newer one takes the slot of an older one.
KEPT_PAIRS = 1 << 18
NEVER = 1 << 30


class PairTable:
    """A fixed map from pairs of numbers below 2**31 to numbers, open-addressed."""

    def __init__(self, left: np.ndarray, right: np.ndarray, values: np.ndarray):
        keys = self._keys(left, right)
        bits = max(4, (2 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.last = (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, -1, np.int32)
        at, open_ = self._slots(keys), np.arange(len(keys))
        while len(open_):
            free = open_[self.keys[at[open_]] == -1]
            self.keys[at[free]] = keys[free]
            won = self.keys[at[open_]] == keys[open_]
            self.values[at[open_[won]]] = values[open_[won]]
            open_ = open_[~won]
            at[open_] = (at[open_] + 1) & self.last

    @staticmethod
    def _keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.int64) << 32 | right

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * _SPREAD >> self.shift).view(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The value of each pair; -1 where there is none."""
        keys = self._keys(left, right)
        at = self._slots(keys)
        there = self.keys[at]
        same = there == keys
        out = np.where(same, self.values[at], -1)
        open_ = np.flatnonzero(~same & (there != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.last
            there = self.keys[at[open_]]
            same = there == keys[open_]
            out[open_[same]] = self.values[at[open_[same]]]
            open_ = open_[~same & (there != -1)]
        return out


    def pairs(self) -> dict[int, int]:
        """The same map by left << 32 | right."""
        there = self.keys != -1
        return dict(zip(self.keys[there].tolist(), self.values[there].tolist(), strict=True))


class SuffixAutomaton:
    """The generalised suffix automaton of the vocabulary's symbol strings.

    State 0 is the empty string. A text is followed symbol by symbol: while a state
    has no transition its link leads to a shorter suffix, so the state is always that
    of the longest text suffix that occurs in any entry. `entry` and `shorter` chain
    the entries that are suffixes of what a state spells, longest first.
    """

    def __init__(self, words: list[tuple[tuple[int, ...], int]]):
        self._next: list[dict[int, int]] = [{}]
        self._link: list[int] = [-1]
        self._depth: list[int] = [0]
        for symbols, _ in words:
            last = 0
            for s in symbols:
                last = self._extend(last, s)
        own = {}
        for symbols, token in words:
            at = 0
            for s in symbols:
                at = self._next[at][s]
            own[at] = token
        self.link, self.depth = np.array(self._link, np.int32), np.array(self._depth, np.int32)
        left = np.repeat(np.arange(len(self._next)), [len(n) for n in self._next])
        right = np.fromiter((s for n in self._next for s in n), np.int64, len(left))
        to = np.fromiter((t for n in self._next for t in n.values()), np.int64, len(left))
        self.transitions = PairTable(left, right, to)
        # the nearest state up the links that spells an entry whole: links lead to lower depths
        self.token = np.full(len(self.link), -1, np.int32)
        self.token[list(own)] = list(own.values())
        self.entry = np.full(len(self.link), -1, np.int32)
        self.shorter = np.full(len(self.link), -1, np.int32)
        for at in np.argsort(self.depth, kind="stable")[1:].tolist():
            up = self.entry[self.link[at]]
            self.entry[at] = at if self.token[at] >= 0 else up
            self.shorter[at] = up
        del self._next, self._link, self._depth

    def _new(self, depth: int, like: int | None = None) -> int:
        self._next.append({} if like is None else dict(self._next[like]))
        self._link.append(0 if like is None else self._link[like])
        self._depth.append(depth)
        return len(self._depth) - 1

    def _split(self, p: int, q: int, symbol: int) -> int:
        clone = self._new(self._depth[p] + 1, q)
        self._link[q] = clone
        while p >= 0 and self._next[p].get(symbol) == q:
            self._next[p][symbol] = clone
            p = self._link[p]
        return clone

    def _extend(self, last: int, symbol: int) -> int:
        known = self._next[last].get(symbol)
        if known is not None:
            return known if self._depth[known] == self._depth[last] + 1 else self._split(last, known, symbol)
        new = self._new(self._depth[last] + 1)
        p = last
        while p >= 0 and symbol not in self._next[p]:
            self._next[p][symbol] = new
            p = self._link[p]
        if p >= 0:
            q = self._next[p][symbol]
            self._link[new] = q if self._depth[q] == self._depth[p] + 1 else self._split(p, q, symbol)
        return new

    def follow(self, states: np.ndarray, reach: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States after one more symbol, and how long a suffix each has matched."""
        states, reach = states.copy(), reach.copy()
        out = self.transitions.get(states, symbols)
        lost = np.flatnonzero(out < 0)
        while len(lost):
            up = self.link[states[lost]]
            if (up < 0).any():
                raise ValueError("a symbol is in no entry: not a BPE vocabulary")
            states[lost], reach[lost] = up, self.depth[up]
            found = self.transitions.get(up, symbols[lost])
            out[lost] = found
            lost = lost[found < 0]
        return out, reach + 1


class PairTest:
    """Whether two tokens side by side are encoded as those two.

    `halves` (token: left, right, rank; -1 where nothing merges to it) must have one
    merge for each entry; PlainPairTest serves others. Answers are kept in a table of
    bounded size.
    """

    def __init__(self, rank: PairTable, halves: np.ndarray):
        self.rank = rank
        self.left, self.right, self.made = (np.ascontiguousarray(c) for c in halves.T)
        self.keys = np.full(KEPT_PAIRS, -1, np.int64)
        self.kept = np.zeros(KEPT_PAIRS, bool)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a.astype(np.int64) << 32 | b
        at = (keys.view(np.uint64) * _SPREAD >> np.uint64(64 - KEPT_PAIRS.bit_length() + 1)).view(np.int64)
        out = self.kept[at]
        lost = np.flatnonzero(self.keys[at] != keys)
        if len(lost):
            asked, back = np.unique(keys[lost], return_inverse=True)
            fine = ~self.straddled((asked >> 32).astype(np.int32), (asked & 0xFFFFFFFF).astype(np.int32))
            out[lost] = fine[back]
            # one writer for a slot, so that key and answer belong together
            slots, first = np.unique(at[lost], return_index=True)
            self.keys[slots], self.kept[slots] = keys[lost][first], out[lost][first]
        return out

    def straddled(self, a: np.ndarray, b: np.ndarray, before: int = NEVER) -> np.ndarray:
        """Whether some merge across the border comes before a and b are complete, or
        follows and has a rank below `before`.

        Undo the later of the two inner merges, again and again: what then stands
        at the border was there until that merge. Of equal merges the leftmost is
        the first, so one across the border precedes an equal one inside b.
        """
        out = np.zeros(len(a), bool)
        open_, before = np.arange(len(a)), np.full(len(a), before, np.int64)
        while len(open_):
            rank = self.rank.get(a, b)
            across = (rank >= 0) & (rank < before)
            out[open_[across]] = True
            of_a, of_b = self.made[a], self.made[b]
            on = ~across & ((of_a >= 0) | (of_b >= 0))
            open_, a, b, before, of_a, of_b = (x[on] for x in (open_, a, b, before, of_a, of_b))
            undo_a = of_a > of_b  # one that is no merge has -1
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
            before = np.where(undo_a, of_a, of_b + 1)
        return out


class PlainPairTest(PairTest):
    """The same for vocabularies in which an entry comes from several merges: `merged`
    encodes a symbol string by plain merging, `spell` gives an entry's symbols."""

    def __init__(
        self, rank: PairTable, halves: np.ndarray, merged: Callable[[list[int]], list[int]], spell: Callable[[int], tuple[int, ...]]
    ):
        super().__init__(rank, halves)
        self.merged, self.spell = merged, spell

    def straddled(self, a: np.ndarray, b: np.ndarray, before: int = NEVER) -> np.ndarray:
        pairs = zip(a.tolist(), b.tolist(), strict=True)
        if before < 0:
            # whether the two become one entry, that is, do not stay apart
            return np.array([len(self.merged([*self.spell(x), *self.spell(y)])) != 1 for x, y in pairs], bool)
        return np.array([self.merged([*self.spell(x), *self.spell(y)]) != [x, y] for x, y in pairs], bool)
