"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

Fixed masks pick token positions of a window and ignore the others, so a hash
survives substitutions at ignored positions. Hashes of benchmark windows are joined
to those of documents; around each hit the document and the item are compared word
by word on the hit's alignment, and a span with enough equal words is a leak.

A document is read once and never moved: every word position meets the broadcast
seeds where it is read, and a hit takes along only the words around it. What is
shuffled is one number for each hit stretch of a document, the equal words in it.

A seed that many items share is one probe: items are grouped by the seed and by what a
hit's alignment implies, and a hit is taken only where another one of the same alignment
does not imply it, so a run of equal words is one hit at its first word, not one for each
of its words and masks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import without_ids

#: Masks by the positions they read. Together they meet every SPAN of words with at
#: most SPAN - LEAST substitutions (tests try all of them). The first one reads a run.
MASKS = ((0, 1, 2, 3, 4, 5), (0, 1, 2, 4, 5, 6), (0, 1, 3, 4, 6, 7), (0, 2, 3, 5, 7, 8))
WEIGHT = 6
#: A leak is a span of SPAN aligned words of which LEAST at least are equal, or a shorter item
#: of which the same share is (all of up to six words, all but one of 7 to 12). An item under
#: ALONE words leaks only if a document is nothing else.
SPAN = 13
LEAST = 11
ALONE = 3
#: Words that masks of a shorter item read, at least, if it may lose one.
FEWEST = 5
#: Seeds that are broadcast (about 60 bytes each); beyond, documents' seeds are shuffled once.
#: Words of items that are broadcast; beyond, a shuffle join.
BROADCAST_SEEDS = 2_000_000
BROADCAST_WORDS = 4_000_000
#: Words before and after a run's first word that a span through the run can reach.
BEFORE = SPAN - 1
AFTER = SPAN - 1 + SPAN - WEIGHT
#: Equal words are bits of a 64-bit number that begins at every STEP-th word of an item.
STEP = 32

#: Scripts that are written without blanks; each character is a word.
UNSPACED = (
    r"[\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{31F0}-\x{31FF}"
    r"\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}]"
)


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits, of UNSPACED scripts single ones; of null: none."""
    low = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    apart = F.when(F.rlike(low, F.lit(UNSPACED)), F.regexp_replace(low, f"({UNSPACED})", " $1 ")).otherwise(low)
    return F.array_remove(F.split(apart, r"[^\p{L}\p{N}]+"), "")


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def least_equal(n: int) -> int:
    """Equal words that make an item of `n` words a leak: its share of LEAST of SPAN, rounded up."""
    n = min(n, SPAN)
    return -(-n * LEAST // SPAN)


def short_masks(n: int) -> list[tuple[int, ...]]:
    """Masks of a whole item of `n` < SPAN words: one meets it whichever words it may lose.

    Where one may be lost, the words are cut into blocks, and each mask leaves one out.
    """
    if least_equal(n) == n:
        return [tuple(range(n))]
    blocks = -(-n // max(1, n - FEWEST))
    edges = [-(-n * k // blocks) for k in range(blocks + 1)]
    return [tuple(o for o in range(n) if not edges[k] <= o < edges[k + 1]) for k in range(blocks)]


def _pattern(mask: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(o - mask[0] for o in mask)


def _patterns(lengths: list[int]) -> list[tuple[int, ...]]:
    """All masks in use, from their first word on; those of long items come first."""
    more = {_pattern(m) for n in lengths for m in short_masks(n)}
    return [*MASKS, *sorted(more - set(MASKS))]


def _seed(kind: int, pattern: tuple[int, ...], at: Column) -> Column:
    return F.xxhash64(F.lit(kind), *(F.get("hashes", at + o) for o in pattern))


def _implied(kind: int, at: Column) -> Column:
    """What must be equal for another hit to imply this one of a long item: of a run, the word
    before it; of other masks, the words they ignore, as the run then hits as well."""
    if kind == 0:
        return F.get("hashes", F.when(at > 0, at - 1))
    return F.xxhash64(*(F.get("hashes", at + o) for o in range(MASKS[kind][-1]) if o not in MASKS[kind]))


def _probe(kind: int, at: Column, seed: Column, implied: Column) -> Column:
    return F.struct(seed.alias("seed"), implied.cast("long").alias("implied"), F.lit(kind).alias("kind"), at.cast("int").alias("at"))


def _placed(docs: DataFrame, patterns: list[tuple[int, ...]]) -> DataFrame:
    """(doc_id, text_version, hashes, at, kind, seed): each mask at each word.

    A mask that reads beyond the end has no seed. Runs of fewer than ALONE words count
    only where they are the whole text.
    """
    placed = docs.select("doc_id", "text_version", "hashes", F.posexplode("hashes").alias("at", "word"))
    size, at = F.size("hashes"), F.col("at")
    every = []
    for kind, p in enumerate(patterns):
        there = (at == 0) & (size == len(p)) if len(p) < ALONE else at + p[-1] < size
        every.append(F.when(there, F.xxhash64(F.lit(kind), "word", *(F.get("hashes", at + o) for o in p[1:]))))
    found = placed.select("doc_id", "text_version", "hashes", "at", F.posexplode(F.array(*every)).alias("kind", "seed"))
    return found.filter("seed is not null")


def _implied_here() -> Column:
    """_implied of a document's mask of any kind."""
    out = F.lit(None).cast("long")
    for kind in range(len(MASKS)):
        out = F.when(F.col("kind") == kind, _implied(kind, F.col("at"))).otherwise(out)
    return out


def leaks(
    df: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, matched_words): the benchmark items that documents contain.

    `matched_words` is the most equal words in one span. An item of fewer than SPAN
    words may lose one from seven on (see least_equal); one of fewer than ALONE words must
    be all the document has. Null and empty texts, texts without words and null ids match nothing; equal
    rows count once; texts of any length are searched whole; empty tables give an
    empty result; further columns are not read.
    """
    cut = df.select(F.col(id_col).alias("doc_id"), word_hashes(F.col(text_col)).alias("hashes")).filter("doc_id is not null")
    # rows that share an id are texts of their own
    docs = cut.select("doc_id", F.xxhash64("hashes").alias("text_version"), "hashes")
    known = (
        items.select(F.col(item_col).alias("item_id"), word_hashes(F.col(item_text_col)).alias("hashes"))
        .filter(F.col("item_id").isNotNull() & (F.size("hashes") > 0))
        .select("item_id", F.xxhash64("hashes").alias("version"), "hashes")
        .dropDuplicates(["item_id", "version"])
    )
    # what decides the plan: how much the benchmark holds, and the lengths of short items
    size = F.size("hashes")
    total, lengths = known.agg(F.sum(size), F.sort_array(F.collect_set(F.when(size < SPAN, size)))).first()
    patterns = _patterns(lengths or [])
    probes = _probes(known, lengths or [], patterns)
    few = (total or 0) * len(MASKS) <= BROADCAST_SEEDS
    found = _hits(docs, _placed(docs, patterns), probes, few)
    wide = (total or 0) > BROADCAST_WORDS
    beside = found.join(known if wide else F.broadcast(known), ["item_id", "version"])
    return _matched(beside)


def _probes(known: DataFrame, lengths: list[int], patterns: list[tuple[int, ...]]) -> DataFrame:
    """(seed, implied, items): the masks of items, those that cannot be told apart in one row."""
    size = F.size("hashes")
    cut = known.filter(size >= SPAN).select("item_id", "version", "hashes", F.posexplode("hashes").alias("at", "word"))
    at = F.col("at")
    every = [F.when(at + m[-1] < size, _probe(k, at, _seed(k, m, at), _implied(k, at))) for k, m in enumerate(MASKS)]
    rows = [cut.select("item_id", "version", F.explode(F.array(*every)).alias("p")).filter("p is not null")]
    for n in lengths:
        masks = [(patterns.index(_pattern(m)), m) for m in short_masks(n)]
        own = [_probe(k, F.lit(m[0]), _seed(k, _pattern(m), F.lit(m[0])), F.lit(None)) for k, m in masks]
        rows.append(known.filter(size == n).select("item_id", "version", F.explode(F.array(*own)).alias("p")))
    all_rows = rows[0]
    for more in rows[1:]:
        all_rows = all_rows.unionAll(more)
    told = all_rows.select("p.seed", "p.implied", F.struct("item_id", "version", F.col("p.at").alias("item_at")).alias("item"))
    return told.groupBy("seed", "implied").agg(F.collect_list("item").alias("items"))


def _hits(docs: DataFrame, placed: DataFrame, probes: DataFrame, few: bool) -> DataFrame:
    """Meetings of seeds that no other one implies, with the document's words around each.

    Beyond what can be broadcast, seeds are shuffled without words; documents give the words
    to the hits afterwards.
    """
    p = probes.select("seed", F.col("implied").alias("other"), "items")
    told = "implied is null or other is null or implied <> other"
    if few:
        met = placed.join(F.broadcast(p), "seed").withColumn("implied", F.when(F.col("other").isNotNull(), _implied_here())).filter(told)
    else:
        met = placed.withColumn("implied", _implied_here()).drop("hashes").join(p, "seed").filter(told)
    met = met.select("doc_id", "text_version", "at", *(["hashes"] if few else []), F.explode("items").alias("i"))
    if not few:
        met = met.join(docs, ["doc_id", "text_version"])
    lead = F.least(F.col("at"), F.lit(BEFORE))
    return met.select(
        "doc_id",
        "text_version",
        "i.item_id",
        "i.version",
        "i.item_at",
        (F.col("at") - F.col("i.item_at")).alias("shift"),
        lead.alias("lead"),
        F.slice("hashes", F.col("at") - lead + 1, lead + 1 + AFTER).alias("near"),
    )


def _matched(hits: DataFrame) -> DataFrame:
    """(doc_id, item_id, matched_words) of the hits whose surroundings make a leak.

    The words around a hit that equal the item's are bits, by their place in the item;
    the bits of all hits of an alignment are joined, and spans are counted in them.
    """
    item, at = F.col("hashes"), F.col("item_at")
    first = (F.floor((at - BEFORE) / STEP) * STEP).cast("int")

    def bit(o: Column) -> Column:
        one = F.call_function("shiftleft", F.lit(1).cast("long"), at + o - first)
        return F.when(F.get("near", F.col("lead") + o) == F.get(item, at + o), one).otherwise(F.lit(0).cast("long"))

    around = F.sequence(F.lit(-BEFORE), F.lit(AFTER))
    bits = F.aggregate(around, F.lit(0).cast("long"), lambda acc, o: acc.bitwiseOR(bit(o)))
    joined = (
        hits.select("doc_id", "text_version", "item_id", "version", "shift", F.size(item).alias("n"), first.alias("first"), bits.alias("bits"))
        .groupBy("doc_id", "text_version", "item_id", "version", "n", "shift", "first")
        .agg(F.bit_or("bits").alias("bits"))
    )
    span = F.lit((1 << SPAN) - 1).cast("long")
    most = F.greatest(*(F.bit_count(F.shiftrightunsigned("bits", j).bitwiseAND(span)) for j in range(64 - SPAN + 1)))
    scored = joined.select(
        "doc_id", "item_id", "n", F.when(F.col("n") >= SPAN, most).otherwise(F.bit_count("bits")).alias("matched")
    )
    return (
        scored.filter(F.col("matched") >= _enough(F.col("n")))
        .groupBy("doc_id", "item_id")
        .agg(F.max("matched").cast("long").alias("matched_words"))
    )


def _enough(n: Column) -> Column:
    """least_equal as an expression."""
    return F.ceil(F.least(n, F.lit(SPAN)) * LEAST / SPAN)


def drop_contaminated(df: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of `df` without leaks, all their columns; rows with a null id stay."""
    return without_ids(df, leaks(df, items).select("doc_id").distinct(), "doc_id")


def _sql_words(table: str, key: str) -> str:
    apart = f"regexp_replace(lower(text), '({UNSPACED})', ' \\1 ', 'g')"
    return f"""SELECT {key}, list_filter(string_split_regex({apart}, '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS ws
    FROM {table} WHERE {key} IS NOT NULL AND text IS NOT NULL"""


#: DuckDB SQL for leaks(documents, benchmark): every alignment of equal words, no seeds.
LEAKS_SQL = f"""
WITH dw AS (
  SELECT doc_id, len(ws) AS dn, unnest(ws) AS word, CAST(generate_subscripts(ws, 1) AS BIGINT) AS at
  FROM ({_sql_words('documents', 'doc_id')})
), iw AS (
  SELECT item_id, len(ws) AS n, unnest(ws) AS word, CAST(generate_subscripts(ws, 1) AS BIGINT) AS item_at
  FROM ({_sql_words('benchmark', 'item_id')})
), eq AS (
  SELECT DISTINCT d.doc_id, i.item_id, i.n, d.at - i.item_at AS shift, i.item_at
  FROM dw d JOIN iw i ON d.word = i.word WHERE i.n >= {ALONE} OR d.dn = i.n
), enough AS (
  SELECT *, count(*) OVER (PARTITION BY doc_id, item_id, shift) AS c FROM eq
), spans AS (
  SELECT doc_id, item_id, n, count(*) OVER (PARTITION BY doc_id, item_id, shift ORDER BY item_at
    RANGE BETWEEN CURRENT ROW AND {SPAN - 1} FOLLOWING) AS matched
  FROM enough WHERE c >= (least(n, {SPAN}) * {LEAST} + {SPAN - 1}) // {SPAN}
)
SELECT doc_id, item_id, max(matched) AS matched_words FROM spans
WHERE matched >= (least(n, {SPAN}) * {LEAST} + {SPAN - 1}) // {SPAN}
GROUP BY doc_id, item_id
"""
