"""HyperMinHash sketches: leading-zero counts plus mantissa bits per bucket.

The first bits of an element's hash name its bucket. Of a bucket's least remainder
a register keeps the count of leading zeros and the mantissa bits that follow the
first one. Registers of empty buckets are filled from full buckets in an order
fixed per bucket, so a register of two sets agrees with about the sets' Jaccard
similarity however small the sets are.
"""

from __future__ import annotations

import hashlib

import numpy as np

from .shingles import series

BUCKET_BITS = 7
BUCKETS = 1 << BUCKET_BITS
MANTISSA_BITS = 10
REST_BITS = 64 - BUCKET_BITS
#: Registers of 16 bits in one band: a band is one 64-bit number.
BAND = 4
BANDS = BUCKETS // BAND
#: Chance that the least remainders of two disjoint sets of like size agree in
#: their leading zeros; their mantissas then agree once in 2 ** MANTISSA_BITS.
SAME_ZEROS = 0.4
CHANCE = SAME_ZEROS / (1 << MANTISSA_BITS)
_EDGES = np.arange(BUCKETS, dtype=np.uint64) << np.uint64(REST_BITS)
#: For each bucket, all buckets in a fixed pseudo-random order that begins with it.
_ORDER = np.argsort(series(5, BUCKETS * BUCKETS).reshape(BUCKETS, BUCKETS), axis=1, kind="stable")


def registers(elements: np.ndarray) -> np.ndarray:
    """The registers of a set of sorted distinct 64-bit hashes; of none: zeros."""
    if not len(elements):
        return np.zeros(BUCKETS, np.uint16)
    at = np.searchsorted(elements, _EDGES)
    least = elements[np.minimum(at, len(elements) - 1)]
    full = (at < len(elements)) & (least >> np.uint64(REST_BITS) == np.arange(BUCKETS, dtype=np.uint64))
    rest = (least & np.uint64((1 << REST_BITS) - 1)).astype(np.float64)
    part, power = np.frexp(np.maximum(rest, 0.5))
    zeros = np.clip(REST_BITS - power, 0, 63).astype(np.uint16)
    mantissa = ((part - 0.5) * (2 << MANTISSA_BITS)).astype(np.uint16)
    out = zeros << np.uint16(MANTISSA_BITS) | mantissa
    if not full.all():
        empty = np.flatnonzero(~full)
        order = _ORDER[empty]
        out[empty] = out[order[np.arange(len(empty)), full[order].argmax(axis=1)]]
    return out


def bands(elements: np.ndarray) -> np.ndarray:
    """The registers, four at a time, as signed 64-bit numbers."""
    return registers(elements).view(np.int64)


def signature(elements: np.ndarray) -> bytes:
    """128 bits that name the set."""
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest()


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard estimates, corrected for chance agreement, of two arrays of bands."""
    same = (a.view(np.uint16).reshape(-1, BUCKETS) == b.view(np.uint16).reshape(-1, BUCKETS)).mean(axis=1)
    return np.clip((same - CHANCE) / (1 - CHANCE), 0, 1)
