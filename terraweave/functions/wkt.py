"""Reading WKT into shapes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from . import geometry as G

SHAPE = f"struct<dimension: int, points: {G.LINE}, lines: array<{G.LINE}>, polygons: {G.MULTIPOLYGON}>"
_HEAD = re.compile(r"^\s*(?:SRID=\d+;)?\s*(MULTI)?(POINT|LINESTRING|POLYGON)\s*(?:Z|M|ZM)?\s*(\(.*\))\s*$", re.I | re.S)


def _nested(text: str):
    """Nested lists from nested brackets; innermost items are points."""
    stack: list[list] = [[]]
    for token in re.findall(r"[()]|[^(),]+", text):
        if token == "(":
            stack.append([])
        elif token == ")":
            done = stack.pop()
            stack[-1].append(done)
        elif token.strip():
            x, y = map(float, token.split()[:2])
            stack[-1].append({"x": x, "y": y})
    return stack[0][0]


def shape_of(text: str | None) -> dict | None:
    """The shape that a WKT text spells; None of null, empty and unknown texts."""
    found = _HEAD.match(text or "")
    if not found:
        return None
    many, kind = bool(found[1]), found[2].upper()
    try:
        body = _nested(found[3])
    except (ValueError, IndexError):
        return None
    out: dict = {"dimension": 0, "points": [], "lines": [], "polygons": []}
    if kind == "POINT":
        out["points"] = [p[0] if isinstance(p, list) else p for p in body]
    elif kind == "LINESTRING":
        out |= {"dimension": 1, "lines": body if many else [body]}
    else:
        out |= {"dimension": 2, "polygons": body if many else [body]}
    return out


_POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])
_ARROW = pa.struct(
    [
        ("dimension", pa.int32()),
        ("points", pa.list_(_POINT)),
        ("lines", pa.list_(pa.list_(_POINT))),
        ("polygons", pa.list_(pa.list_(pa.list_(_POINT)))),
    ]
)


def parse_wkt(rows: DataFrame) -> DataFrame:
    """(id, shape) of (id, wkt)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shape_of(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, _ARROW)], names=["id", "shape"])

    return rows.select("id", "wkt").mapInArrow(run, f"id string, shape {SHAPE}")
