"""Language ID by language-bitmask n-gram filters.

One bit-sliced Bloom filter serves all languages: each slot is a bitmask of one bit a
language, in as many 64-bit words as there are languages for, and the masks at an
n-gram's slots, and-ed, name all languages that contain it. A text's n-grams are looked
up; per-language popcounts, corrected for the false positives that the slots' fill
predicts, decide. The number of slots follows from the n-grams that were learned.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .pieces import byte_slices, map_in_arrow
from .shingles import mixed, series
from .tables import remove_table, stored

UNKNOWN = "und"
#: n-gram lengths, in characters of a text's letters with one blank between words.
LENGTHS = (2, 3, 4, 5)
#: Slots per n-gram, and slots for each n-gram of the richest language: with these one
#: n-gram in a hundred is taken for one of a language that lacks it.
PROBES = 3
SLOTS_PER_NGRAM = 13
#: Power of two of a filter's slots, at least. At most they are 2**25, as LEAST_SHARE leaves
#: a language half a million n-grams of each length: 256 MiB for up to 64 languages.
LEAST_BITS = 16
#: Slots that are or-ed into one row before they go to the driver, a power of two.
BLOCK_BITS = 13
#: Different words, and code points of texts, that a task counts before it hands them on.
HELD_WORDS = 200_000
HELD_CODES = 1 << 23
#: An n-gram belongs to a language if at least this share of its n-grams of that
#: length, and two occurrences, are it; junk and foreign passages stay below.
LEAST_SHARE = 2e-6
LEAST_COUNT = 2
#: Languages of one word of a slot, and of the part of a word that is counted at once.
_WORD = 64
_PART = 4
#: For each value of such a part, its bits.
_BITS = (np.arange(1 << _PART)[:, None] >> np.arange(_PART)) & 1
#: Bytes of texts that are looked up at a time.
BATCH_BYTES = 1 << 18
#: Thresholds are fitted for so many powers of two of a text's n-grams, below all but
#: this share of the labelled texts.
SIZES = 24
TAIL = 0.01
#: Steps of 1 that measures are counted in, so that quantiles of any number of texts are exact
#: within a step and come from at most some ten thousand counts.
STEPS = 10_000
#: The fall that TAIL of samples of one n-gram exceed: 2.33 deviations of a share of
#: 0.95, where 16 n-grams, about a word's, are found or missed as one.
SPREAD = 2.33 * (0.95 * 0.05 * 16) ** 0.5
_BLANK = 32


def _letter_tables() -> tuple[np.ndarray, np.ndarray]:
    """For all code points: lower-cased ones and whether they are letters."""
    lower = np.arange(0x110000, dtype=np.uint32)
    letter = np.zeros(0x110000, bool)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            letter[c] = True
            low = s.lower()
            if len(low) == 1:
                lower[c] = ord(low)
    return lower, letter


_LOWER, _LETTER = _letter_tables()


def letters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased letters of all texts, and each one's text.

    Every other run of characters is one blank; each text begins and ends with one.
    """
    raw = "".join(" " if t is None else f" {t} " for t in texts)
    codes = np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter((1 if t is None else len(t) + 2 for t in texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts)), sizes)
    out = np.where(_LETTER[codes], _LOWER[codes], _BLANK).astype(np.uint32)
    blank = out == _BLANK
    keep = ~blank | np.concatenate([[True], ~blank[:-1] | (owner[1:] != owner[:-1])])
    return out[keep], owner[keep]


def ngrams(codes: np.ndarray, owner: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams and their texts; blanks only at an n-gram's ends."""
    n = len(codes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    weights = series(11 + length, length) | np.uint64(1)
    h = np.zeros(n, np.uint64)
    whole = owner[:n] == owner[length - 1 :]
    for k in range(length):
        part = codes[k : k + n]
        h += part.astype(np.uint64) * weights[k]
        if 0 < k < length - 1 or length == 1:
            whole &= part != _BLANK
    # a blank alone beside a letter is no evidence for two characters
    if length == 2:
        whole &= (codes[:n] != _BLANK) & (codes[1 : 1 + n] != _BLANK)
    return mixed(h[whole]), owner[:n][whole]


def _slots(h: np.ndarray, bits: int) -> list[np.ndarray]:
    size = np.uint64((1 << bits) - 1)
    step = (h >> np.uint64(40)) | np.uint64(1)
    return [((h + np.uint64(k) * step) & size).astype(np.int64) for k in range(PROBES)]


def _parts(masks: np.ndarray, languages: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first language, the _PART bits of each mask from there on)."""
    for first in range(0, languages, _PART):
        word = masks[:, first // _WORD]
        yield first, (word >> np.uint64(first % _WORD)).astype(np.int64) & ((1 << _PART) - 1)


@dataclass
class LanguageFilter:
    """The trained filter: languages in order of their bits, slots of words, false-positive rates."""

    languages: list[str]
    slots: np.ndarray
    false_rate: np.ndarray

    def masks(self, h: np.ndarray) -> np.ndarray:
        """For each n-gram the bitmask (in words) of the languages that contain it."""
        first, *more = _slots(h, len(self.slots).bit_length() - 1)
        found = self.slots[first]
        for at in more:
            found &= self.slots[at]
        return found

    def shares(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each language's corrected share of each text's n-grams, the number of
        n-grams of each text, and whether it has letters."""
        codes, owner = letters(texts)
        lettered = np.bincount(owner[codes != _BLANK], minlength=len(texts)) > 0
        n, hits = np.zeros(len(texts)), np.zeros((len(self.languages), len(texts)))
        for length in LENGTHS:
            h, own = ngrams(codes, owner, length)
            n += np.bincount(own, minlength=len(texts))
            for first, part in _parts(self.masks(h), len(self.languages)):
                # how often each text has each value; its bits are popcounts by language
                seen = np.bincount(own << _PART | part, minlength=len(texts) << _PART).reshape(-1, 1 << _PART)
                hits[first : first + _PART] += (seen @ _BITS).T[: len(self.languages) - first]
        wrong = self.false_rate[:, None]
        return np.clip((hits / np.maximum(n, 1) - wrong) / (1 - wrong), 0, 1), n, lettered

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The language and score of each text; UNKNOWN and 0 without letters.

        The score is the winner's corrected share of the text's n-grams. Ties go to
        the first language in alphabetical order.
        """
        if not texts:
            return [], []
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        share, _, lettered = self.shares(texts)
        best = share.argmax(axis=0)
        names = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)]
        return names, np.where(lettered, share[best, np.arange(len(texts))], 0.0).tolist()


def _words(rows: DataFrame) -> DataFrame:
    """(lang, word, n): how often the texts of a language have each word, of all (lang, text).

    No n-gram reaches beyond a word and the blanks around it, so words and their counts
    hold all that n-grams are counted from, and there are far fewer of them.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        read = 0

        def told() -> Iterator[pa.RecordBatch]:
            for lang, words in held.items():
                words.pop("", None)
                columns = [pa.array([lang] * len(words), pa.string()), pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "word", "n"])
            held.clear()

        for batch in batches:
            named = batch.column(0).to_pylist()
            for at, size in byte_slices(batch.column(1), BATCH_BYTES):
                langs, texts = named[at : at + size], batch.column(1).slice(at, size).to_pylist()
                for lang in sorted(set(langs)):
                    codes, _ = letters([t for t, x in zip(texts, langs, strict=True) if x == lang])
                    held.setdefault(lang, Counter()).update(codes.tobytes().decode("utf-32-le").split(" "))
                    read += len(codes)
                if read > HELD_CODES or sum(map(len, held.values())) > HELD_WORDS:
                    yield from told()
                    read = 0
        yield from told()

    pieces = map_in_arrow(rows.select("lang", "text"), count, "lang string, word string, n long")
    return pieces.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _counts(words: DataFrame) -> DataFrame:
    """(lang, length, h, n): n-gram counts of each language, from those of its words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = batch.column(0).to_pylist()
            for at, size in byte_slices(batch.column(1), BATCH_BYTES):
                langs, texts = np.array(named[at : at + size], object), batch.column(1).slice(at, size).to_pylist()
                times = batch.column(2).slice(at, size).to_numpy()
                for lang in sorted(set(langs)):
                    mine = np.flatnonzero(langs == lang)
                    codes, owner = letters([texts[k] for k in mine])
                    for length in LENGTHS:
                        h, own = ngrams(codes, owner, length)
                        if not len(h):
                            continue
                        order = np.argsort(h)
                        h, n = h[order], times[mine][own[order]]
                        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([lang] * len(first), pa.string()),
                                pa.array([length] * len(first), pa.int32()),
                                pa.array(h[first].view(np.int64), pa.int64()),
                                pa.array(np.add.reduceat(n, first), pa.int64()),
                            ],
                            names=["lang", "length", "h", "n"],
                        )

    pieces = map_in_arrow(words.select("lang", "word", "n"), count, "lang string, length int, h long, n long")
    return pieces.groupBy("lang", "length", "h").agg(F.sum("n").alias("n"))


def _blocks(held: DataFrame, bits: int) -> DataFrame:
    """(block, word, masks): the filter's slots of n-grams (h, place), or-ed where the n-grams are,
    in runs of 2**BLOCK_BITS slots."""
    size = F.lit((1 << bits) - 1).cast("long")
    step = F.shiftrightunsigned("h", 40).bitwiseOR(F.lit(1).cast("long")).bitwiseAND(size)
    at = F.array(*((F.col("h").bitwiseAND(size) + step * k).bitwiseAND(size) for k in range(PROBES)))
    slots = (
        held.select(F.explode(at).alias("slot"), "place")
        .groupBy("slot", F.floor(F.col("place") / _WORD).cast("int").alias("word"))
        .agg(F.expr(f"bit_or(shiftleft(1L, place % {_WORD}))").alias("mask"))
    )

    def joined(table: pa.Table) -> pa.Table:
        masks = np.zeros(1 << BLOCK_BITS, np.int64)
        masks[table["slot"].to_numpy() & ((1 << BLOCK_BITS) - 1)] = table["mask"].to_numpy()
        return pa.table({"block": table["block"][:1], "word": table["word"][:1], "masks": pa.array([masks.tobytes()], pa.binary())})

    placed = slots.select(F.shiftright("slot", BLOCK_BITS).alias("block"), "word", "slot", "mask")
    return placed.groupBy("block", "word").applyInArrow(joined, "block long, word int, masks binary")


def train(df: DataFrame, *, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> LanguageFilter:
    """A filter from all labelled documents.

    Rows with a null text, language or id teach nothing. Every other label is learned,
    however many there are. Without labelled rows the filter knows no language and
    predicts UNKNOWN.
    """
    # a row for each language
    named = df.select(F.col(lang_col).alias("lang")).filter("lang is not null").distinct()
    languages = sorted(r["lang"] for r in named.collect())
    if not languages:
        return LanguageFilter([], np.zeros((1, 1), np.uint64), np.zeros(0))
    told = df.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("id")).dropna()
    counted = stored(_counts(_words(told)), "counts")
    totals = counted.groupBy("lang", "length").agg(F.sum("n").alias("total"))
    spark = df.sparkSession
    order = spark.createDataFrame(pa.table({"place": pa.array(range(len(languages)), pa.int32()), "lang": languages}))
    held = stored(
        counted.join(F.broadcast(totals), ["lang", "length"])  # a row for each language and length
        .filter((F.col("n") >= LEAST_COUNT) & (F.col("n") >= F.col("total") * LEAST_SHARE))
        .join(F.broadcast(order), "lang")
        .select("h", "place"),
        "ngrams",
    )
    richest = held.groupBy("place").count().agg(F.max("count")).first()[0] or 0
    words = -(-len(languages) // _WORD)
    bits = max(LEAST_BITS, (SLOTS_PER_NGRAM * richest).bit_length())
    slots = np.zeros((1 << bits, words), np.uint64)
    for block in _blocks(held, bits).toLocalIterator():
        first = block.block << BLOCK_BITS
        slots[first : first + (1 << BLOCK_BITS), block.word] = np.frombuffer(block.masks, np.uint64)
    remove_table(held)
    remove_table(counted)
    fill = np.zeros(len(languages))
    for first, part in _parts(slots, len(languages)):
        own = np.bincount(part, minlength=1 << _PART) @ _BITS / len(slots)
        fill[first : first + _PART] = own[: len(languages) - first]
    return LanguageFilter(languages, slots, np.minimum(fill**PROBES, 0.99))


def predict(
    df: DataFrame,
    model: LanguageFilter,
    *,
    text_col: str = "text",
    keep: list[str],
    batch_bytes: int = BATCH_BYTES,
    names: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """The columns `keep` with the prediction and its score, named by `names`."""
    kept = [df.schema[c] for c in keep]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    shared = df.sparkSession.sparkContext.broadcast(model)  # see LEAST_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            texts = batch.column(len(keep))
            for at, n in byte_slices(texts, batch_bytes):
                found, scores = known.predict(texts.slice(at, n).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(at, n) for k in range(len(keep))]
                    + [pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                    names=[*(f.name for f in kept), *names],
                )

    return map_in_arrow(df.select(*keep, text_col), run, f"{schema}`{names[0]}` string, `{names[1]}` double")


def held_out(id_col: str = "doc_id") -> F.Column:
    """Whether a document is kept from training: crc32 of its id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(df: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row.

    Learns from the rows that are not held out. A null text, or one without letters,
    is UNKNOWN with score 0; a null id is not held out; repeated rows and long texts
    count whole; an empty table gives an empty result; other columns are not read.
    """
    model = train(df.filter(~held_out()).select("doc_id", "text", "lang"))
    found = predict(df, model, keep=["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def evidence(share: np.ndarray, labels: list[int | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text the language that is claimed (its label's, else the winner), its
    share, and how far that lies above the best other share (below: negative)."""
    at = np.arange(share.shape[1])
    claimed = np.array([b if k is None else k for k, b in zip(labels, share.argmax(axis=0), strict=True)], np.int64)
    own = share[claimed, at]
    rest = share.copy()
    rest[claimed, at] = 0
    return claimed, own, own - rest.max(axis=0)


@dataclass
class Thresholds:
    """Least share and margin by language and power of two of a text's n-grams."""

    share: np.ndarray
    margin: np.ndarray

    def accepts(self, share: np.ndarray, n: np.ndarray, labels: list[int | None]) -> np.ndarray:
        claimed, own, margin = evidence(share, labels)
        size = np.log2(np.maximum(n, 1)).astype(np.int64).clip(0, SIZES - 1)
        return (own > 0) & (own >= self.share[claimed, size]) & (margin >= self.margin[claimed, size])


def _quantiles(counted: DataFrame, keys: list[str], share: float) -> DataFrame:
    """(keys, value): the quantile of each group of (keys, value, n), between ranks in proportion.

    Values are whole steps, so a group has few rows however many texts it counts.
    """
    of = Window.partitionBy(*keys)
    rank = (F.sum("n").over(of) - 1) * share
    placed = counted.withColumn("rank", rank).withColumn("upto", F.sum("n").over(of.orderBy("value")))
    below, above = (F.min(F.when(F.col("upto") > f("rank"), F.col("value"))) for f in (F.floor, F.ceil))
    part = F.first(F.col("rank") - F.floor("rank"))
    return placed.groupBy(*keys).agg((below + (above - below) * part).alias("value"))


def fit_thresholds(measured: DataFrame, languages: int) -> Thresholds:
    """Thresholds that labelled texts (lang, n, share, margin), which the filter has not seen, stay above.

    Around a language's median both measures may fall by twice what all but TAIL of
    its texts, or of all texts, stay within; so a few bad labels do not count. For
    sizes below a text's own the spread of a sample is added to its fall; falls of
    shorter texts hold for longer ones. A margin above 0 is never asked for, as the
    languages of a corpus may be close. A language without such texts asks for any share.
    """
    spark = measured.sparkSession
    step = lambda c: F.round(c * STEPS).cast("long")
    kinds = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), step(F.col(c)).alias("value")) for k, c in enumerate(("share", "margin")))))
    valued = measured.select("lang", "n", kinds.alias("m")).select("lang", "n", "m.*")
    # two rows for each language
    middle = _quantiles(valued.groupBy("kind", "lang", "value").agg(F.count("*").alias("n")), ["kind", "lang"], 0.5).toArrow()
    middles = F.broadcast(spark.createDataFrame(middle.rename_columns(["kind", "lang", "middle"])))
    spread = SPREAD**2 * F.greatest(F.pow(F.lit(2.0), -F.col("size")) - 1 / F.greatest("n", F.lit(1.0)), F.lit(0.0))
    fall = F.greatest(F.col("middle") - F.col("value"), F.lit(0.0)) / STEPS
    sized = valued.join(middles, ["kind", "lang"]).withColumn("size", F.explode(F.sequence(F.lit(0), F.lit(SIZES - 1))))
    falls = sized.groupBy("kind", "size", "lang", step(F.sqrt(fall * fall + spread)).alias("value")).agg(F.count("*").alias("n"))
    # -1: all languages together
    both = falls.select("kind", "size", F.explode(F.array("lang", F.lit(-1).cast("long"))).alias("lang"), "value", "n")
    groups = both.groupBy("kind", "size", "lang", "value").agg(F.sum("n").alias("n"))
    # SIZES rows for each language and measure
    tails = {(r.kind, r.size, r.lang): r.value for r in _quantiles(groups, ["kind", "size", "lang"], 1 - TAIL).collect()}
    out = np.full((2, languages, SIZES), -1.0)
    for kind, lang, half in zip(*(middle[c].to_pylist() for c in middle.column_names), strict=True):
        for size in range(SIZES):
            out[kind, lang, size] = (half - 2 * max(tails[kind, size, -1], tails[kind, size, lang])) / STEPS
    return Thresholds(out[0], np.minimum(out[1], 0))


def calibrate(df: DataFrame, model: LanguageFilter) -> Thresholds:
    """Thresholds for `model` from the labelled rows (doc_id, text, lang) it learned from.

    A filter of one half of the rows, by a hash of their ids, measures the other half:
    a text's own n-grams would flatter it.
    """
    half = F.pmod(F.xxhash64(F.lit("half"), F.col("doc_id").cast("string")), F.lit(2)) == 0
    named = df.filter(~half).dropna(subset=["doc_id", "text", "lang"])
    known = df.sparkSession.sparkContext.broadcast(train(df.filter(half)))
    bits = {lang: k for k, lang in enumerate(model.languages)}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = known.value
        at = {lang: k for k, lang in enumerate(part.languages)}
        for batch in batches:
            labels = batch.column(0).to_pylist()
            for start, size in byte_slices(batch.column(1), BATCH_BYTES):
                rows = zip(labels[start : start + size], batch.column(1).slice(start, size).to_pylist(), strict=True)
                rows = [(x, t) for x, t in rows if x in at]
                if not rows:
                    continue
                langs, texts = zip(*rows, strict=True)
                share, n, lettered = part.shares(list(texts))
                _, own, margin = evidence(share, [at[x] for x in langs])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([bits[x] for x, ok in zip(langs, lettered, strict=True) if ok], pa.int64()),
                        *(pa.array(v[lettered], pa.float64()) for v in (n, own, margin)),
                    ],
                    names=["lang", "n", "share", "margin"],
                )

    found = map_in_arrow(named.select("lang", "text"), measure, "lang long, n double, share double, margin double")
    measured = stored(found, "measures")
    fitted = fit_thresholds(measured, len(model.languages))
    remove_table(measured)
    return fitted


def drop_unidentified(df: DataFrame, *, least_score: float = 0.0) -> DataFrame:
    """The rows whose language is known, all columns.

    A row stays if the share of its label's language (without a known label: of the
    best) and that share's margin over all others reach what clean texts of its size
    reach (see `fit_thresholds`), and the share is `least_score` at least. Text of no
    learned language, gibberish and labels that the text contradicts go. `lang` of a
    row without label becomes the prediction. A table in which no row has a label raises,
    as nothing can be told of its rows; an empty one stays empty.
    """
    training = df.filter(~held_out()).select("doc_id", "text", "lang")
    model = train(training)
    # the verdict rides on the row itself, so no join and no shuffle
    columns = df.columns
    if not model.languages:
        if df.isEmpty():
            return df
        raise ValueError("no row has a label to learn from, so no row can be judged")
    shared = df.sparkSession.sparkContext.broadcast((model, calibrate(training, model)))
    text, label, schema = columns.index("text"), columns.index("lang"), df.schema
    bits = {lang: k for k, lang in enumerate(model.languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, least = shared.value
        for batch in batches:
            langs = batch.column(label).to_pylist()
            for at, size in byte_slices(batch.column(text), BATCH_BYTES):
                part, labels = batch.slice(at, size), langs[at : at + size]
                share, n, lettered = known.shares(part.column(text).to_pylist())
                own = [bits.get(x) for x in labels]
                claimed, score, _ = evidence(share, own)
                good = lettered & least.accepts(share, n, own) & (score >= least_score)
                named = [known.languages[k] if x is None else x for x, k in zip(labels, claimed, strict=True)]
                part = part.set_column(label, batch.schema.field(label), pa.array(named, batch.schema.field(label).type))
                yield part.filter(pa.array(good))

    return map_in_arrow(df, run, schema)
