"""Words of whole batches of texts, cut at classes of bytes in numpy."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BYTES = np.arange(256)
LOWER = np.where((BYTES >= 0x41) & (BYTES <= 0x5A), BYTES + 32, BYTES).astype(np.uint8)


class Words(NamedTuple):
    """`words` of a run of texts, A-Z lower-cased: word k begins at byte `starts[k]` of
    `raw`, in which each text ends with a line feed; text t has `counts[t]` of them."""

    words: pa.Array
    counts: np.ndarray
    starts: np.ndarray
    raw: np.ndarray


def cut_words(texts: pa.Array, inside: np.ndarray) -> Words:
    """The runs of bytes of which `inside` holds; nulls have none. A line feed parts words."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    joined = b"\n".join(b"" if t is None else t.encode() for t in texts.to_pylist()) + b"\n"
    raw = LOWER[np.frombuffer(joined, np.uint8)]
    edges = np.flatnonzero(np.diff(inside[raw], prepend=False, append=False))
    starts = edges[::2]
    # every run is a string, words and what parts them in turn; only words are taken
    bounds = np.concatenate([[0], edges, [len(raw)]]).astype(np.int32)
    runs = pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(raw.tobytes()))
    found = runs.take(pa.array(np.arange(1, 2 * len(starts), 2)))
    counts = np.diff(np.searchsorted(starts, np.cumsum(sizes + 1)), prepend=0)
    return Words(found, counts, starts, raw)
