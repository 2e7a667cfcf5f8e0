"""Token counts: batch encoding in Arrow functions that return lengths only.

Texts are cut at safe boundaries (lone spaces, and marks that no vocabulary piece
joins with what is beside them), the parts are encoded in batches of about equal bytes,
and only their lengths leave the worker. The model file is a parameter.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .pieces import map_in_arrow
from .textcut import by_bytes

#: Marks where a text may be cut if the model keeps them apart.
MARKS = "\n。、，．！？；：「」『』（）…—·।॥،؟።"
#: A lone space, as in textcut.
_SPACE = r"(?<=[^\s▁]) (?=[^\s▁])"


@dataclass(frozen=True)
class LengthEncoder:
    """Token counts of a model, and where texts may be cut without changing them.

    After a cut at a space, which is dropped, a part begins with `lead`; a part that
    begins with a mark has `extra` tokens more than it has in the whole.
    """

    counts: Callable[[list[str]], list[int]]
    cuts: re.Pattern | None
    lead: str
    extra: int

    def parts(self, text: str, limit: int) -> Iterator[tuple[str, int]]:
        """(part, tokens too many) of about `limit` characters each.

        A part is longer where no safe boundary follows.
        """
        at, lead, extra = 0, "", 0
        while self.cuts is not None and len(text) - at > limit:
            found = self.cuts.search(text, at + limit)
            if found is None:
                break
            yield lead + text[at : found.start()], extra
            space = found.end() > found.start()
            at, lead, extra = found.end(), self.lead if space else "", 0 if space else self.extra
        yield lead + text[at:], extra


@lru_cache(maxsize=4)
def length_encoder(model_path: str) -> LengthEncoder:
    """The encoder of a model file; cuts that it does not prove safe are not made.

    `.model` files are read with sentencepiece, whose dummy prefix stands for the
    space that a cut drops; `.json` files with tokenizers, where the space is kept.
    """
    if model_path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        mark = "▁"
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        whole = all(mark not in p.lstrip(mark) for p in pieces)
        # the dummy prefix must give a first word the ids that it has after a space
        alike = model.encode("a a") == model.encode("a") * 2
        counts = lambda texts: list(map(len, model.encode(texts, num_threads=1)))
        # a mark that no longer piece holds joins with nothing, so the prefix is one id more
        alone = [c for c in MARKS if not any(c in p and len(p) > 1 for p in pieces)]
        fine = [c for c in alone if model.encode(f"字{c}b") == model.encode("字") + model.encode(f"{c}b")[1:]]
        return LengthEncoder(counts, _cuts(whole and alike, fine, r"(?<=[^\s▁])(?=[{}][^\s▁])"), "", 1)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(model_path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def ids(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    special = [str(t.content) for t in tokenizer.get_added_tokens_decoder().values()]
    safe = all(" " not in t for t in special)
    fine = [
        c
        for c in MARKS
        if not any(c in t for t in special)
        and all(ids(f"{x}{c}{y}") == ids(x) + ids(f"{c}{y}") for x in ("字", "aé", "7") for y in ("字", "bé", "7"))
    ]
    counts = lambda texts: [len(e) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    # between letters or digits, so that a mark is no part of a run of marks
    return LengthEncoder(counts, _cuts(safe, fine, r"(?<=[^\W_])(?=[{}][^\W_])"), " ", 0)


def _cuts(spaces: bool, marks: list[str], pattern: str) -> re.Pattern | None:
    ways = [_SPACE] * spaces + [pattern.format(re.escape("".join(marks)))] * bool(marks)
    return re.compile("|".join(ways)) if ways else None


def count_tokens(
    df: DataFrame,
    model_path: str,
    *,
    text_col: str = "text",
    id_col: str = "doc_id",
    limit: int = 4096,
    batch_bytes: int = 1 << 20,
    part_chars: int = 1 << 15,
) -> DataFrame:
    """One row (id, n_bytes, n_tokens, over_limit) per input row.

    A null text counts as empty (0 bytes, 0 tokens); a null id stays null; repeated
    rows give repeated results; an empty table gives an empty result. Other columns
    of `df`, whatever their names, are not read. Very long texts are encoded in
    parts, so a worker holds about `batch_bytes` bytes of texts and their ids at a
    time; a stretch without any safe boundary is one part.
    """
    id_type = df.schema[id_col].dataType.simpleString()

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = length_encoder(model_path)
        for batch in batches:
            column = batch.column(1)
            counts = [0] * batch.num_rows

            def parts(column=column, counts=counts):
                for row, text in enumerate(column):
                    for part, extra in encoder.parts(text.as_py() or "", part_chars):
                        counts[row] -= extra
                        yield row, part

            for rows, own in by_bytes(parts(), batch_bytes):
                for row, n in zip(rows, encoder.counts(own), strict=True):
                    counts[row] += n
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pc.fill_null(pc.binary_length(column), 0).cast(pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([n > limit for n in counts], pa.bool_()),
                ],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    return map_in_arrow(
        df.select(id_col, text_col), lengths, f"`{id_col}` {id_type}, n_bytes long, n_tokens long, over_limit boolean"
    )
