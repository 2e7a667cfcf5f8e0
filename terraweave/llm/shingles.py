"""Word shingles of whole texts as 64-bit hashes, a batch of texts at a time."""

from __future__ import annotations

import numpy as np

_MASK = (1 << 64) - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def series(seed: int, n: int) -> np.ndarray:
    """`n` fixed pseudo-random 64-bit numbers."""
    at = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mixed(at + np.uint64(seed * 0xD1342543DE82EF95 & _MASK))


_BYTES = np.arange(256, dtype=np.uint8)
_SPACE = (_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D))
_LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES)
_CODES = series(1, 256)[_LOWER]


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and where each text's words begin.

    A-Z are lower-cased; words are runs of bytes other than blank and 0x09-0x0D.
    The second array has one entry more than there are texts.
    """
    parts = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    inside = np.flatnonzero(~_SPACE[raw])
    edges = np.cumsum(np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts))) if parts else np.zeros(0, np.int64)
    if not len(inside):
        return np.zeros(0, np.uint64), np.zeros(len(parts) + 1, np.int64)
    first = np.concatenate([[True], np.diff(inside) > 1])
    offsets = np.flatnonzero(first)
    sizes = np.diff(np.append(offsets, len(inside)))
    place = np.arange(len(inside)) - np.repeat(offsets, sizes)
    spread = series(2, int(sizes.max()))
    sums = np.add.reduceat(_CODES[raw[inside]] * spread[place], offsets)
    bounds = np.concatenate([[0], np.searchsorted(inside[offsets], edges)])
    return mixed(sums + sizes.astype(np.uint64)), bounds


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its k-word shingles.

    A text of fewer words, but one at least, has its whole word sequence as its
    only shingle; a text without words, or null, has none.
    """
    words, bounds = word_hashes(texts)
    weights = series(3, k) | np.uint64(1)
    n = len(words) - k + 1
    joined = np.zeros(max(0, n), np.uint64)
    for j in range(k if n > 0 else 0):
        joined += words[j : j + n] * weights[j]
    joined = mixed(joined)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= k:
            out.append(np.unique(joined[a : b - k + 1]))
        elif b > a:
            short = (words[a:b] * weights[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mixed(np.array([short])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
