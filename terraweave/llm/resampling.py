"""Importance resampling towards a target, by hashed n-grams of words.

Counts of hashed n-grams in the target and in the raw table give one gain for each
bucket, an array of fixed length. A document's weight is the mean of its n-grams'
gains, looked up in that array; a keyed hash of its id adds Gumbel noise, so that the
highest scores are a draw without replacement. The draw itself sorts nothing as a
whole: a histogram of the integer scores, summed from the highest down, tells each
score's first rank and the score at which the draw ends; documents are numbered by id
within a score that survives, and only survivors are shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .pieces import byte_slices, map_in_arrow
from .tables import spread, stored
from .wordcut import LOWER, cut_words

BUCKETS = 10_000
#: The draw's key, the words a document needs, and the percentage drawn of those that have them.
SALT = "2024"
LEAST_WORDS = 20
PERCENT = 10
#: N-grams whose buckets a task remembers.
MOST_KNOWN = 500_000

#: Digits, letters and all bytes of characters beyond ASCII make words.
INSIDE = ((LOWER >= 0x30) & (LOWER <= 0x39)) | ((LOWER >= 0x61) & (LOWER <= 0x7A)) | (LOWER >= 0x80)


def _joined(words: pa.Array, counts: np.ndarray, n: int) -> tuple[pa.Array, np.ndarray]:
    """Runs of `n` words of one text, joined by a blank, and how many each text has."""
    if n == 1 or not len(words):
        return words, counts
    ends = np.cumsum(counts)
    left = np.repeat(ends, counts) - np.arange(len(words))
    at = np.flatnonzero(left >= n)
    columns = [words.take(pa.array(at + k)) for k in range(n)]
    return pc.binary_join_element_wise(*columns, " "), np.maximum(counts - n + 1, 0)


class Buckets:
    """Buckets of n-grams; crc32 is reckoned once for each distinct n-gram held."""

    def __init__(self, buckets: int, most: int = MOST_KNOWN):
        self.buckets, self.most = buckets, most
        self.known: dict[str, int] = {}

    def of(self, grams: pa.Array) -> np.ndarray:
        coded = grams.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) + len(distinct) > self.most:
            self.known.clear()
        known, found = self.known, np.empty(len(distinct), np.int64)
        for k, gram in enumerate(distinct):
            bucket = known.get(gram)
            if bucket is None:
                bucket = known[gram] = zlib.crc32(gram.encode()) % self.buckets
            found[k] = bucket
        return found[coded.indices.to_numpy(zero_copy_only=False)]


def bucket_counts(df: DataFrame, text_col: str, *, most_words: int, buckets: int) -> np.ndarray:
    """How often the n-grams of all texts fall into each bucket: a task sends one array."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own = np.zeros(buckets, np.int64), Buckets(buckets)
        for batch in batches:
            for at, n in byte_slices(batch.column(0)):
                words, counts, _, _ = cut_words(batch.column(0).slice(at, n), INSIDE)
                for k in range(1, most_words + 1):
                    grams, _ = _joined(words, counts, k)
                    held += np.bincount(own.of(grams), minlength=buckets)
        there = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(held[there])], names=["bucket", "n"])

    texts = df.select(F.col(text_col).cast("string").alias("text"))
    parts = map_in_arrow(texts, count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in parts.collect():  # at most `buckets` rows
        out[row.bucket] = row.n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the target's share over the raw share of each bucket, one added to each count."""
    own, all_raw, all_target = len(raw), float(raw.sum()), float(target.sum())
    share = (target + 1.0) * (all_raw + own) / ((raw + 1.0) * (all_target + own))
    return np.floor(1000 * np.log(share)).astype(np.int64)


def weights(df: DataFrame, gain: np.ndarray, *, id_col: str, text_col: str, most_words: int) -> DataFrame:
    """(doc_id, n_features, n_words, weight): the floored mean gain of each row's n-grams."""
    id_type = df.schema[id_col].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Buckets(len(gain))
        for batch in batches:
            for at, n in byte_slices(batch.column(1)):
                words, counts, _, _ = cut_words(batch.column(1).slice(at, n), INSIDE)
                features, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
                for k in range(1, most_words + 1):
                    grams, each = _joined(words, counts, k)
                    before = np.concatenate([[0], np.cumsum(gain[own.of(grams)])])
                    ends = np.cumsum(each)
                    total += before[ends] - before[ends - each]
                    features += each
                weight = np.floor_divide(total, np.maximum(features, 1))
                columns = [batch.column(0).slice(at, n), pa.array(features), pa.array(counts.astype(np.int64)), pa.array(weight)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_features", "n_words", "weight"])

    texts = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_in_arrow(texts, score, f"doc_id {id_type}, n_features long, n_words long, weight long")


def noise(salt: str) -> F.Column:
    """Gumbel noise in thousandths from the first 8 hex digits of sha256('salt:doc_id')."""
    told = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(told, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(
    df: DataFrame,
    target: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    most_words: int = 1,
    buckets: int = BUCKETS,
    salt: str = SALT,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of `df`; undrawn ones have no rank.

    Of the rows with `least_words` words or more, `percent` of a hundred are drawn, by
    descending score, then ascending id. Null and empty texts have no features, weight 0,
    and are drawn only where no word is asked for; a null id is hashed as the empty
    string and comes first among equal scores; rows that repeat an id share its noise
    and are ranked by features and weight. An empty target leaves all shares to the raw
    counts; an empty table gives an empty result. Other columns are not read.
    """
    df = spread(df)
    raw = bucket_counts(df, text_col, most_words=most_words, buckets=buckets)
    aim = bucket_counts(target, target_text_col, most_words=most_words, buckets=buckets)
    weighed = weights(df, gains(raw, aim), id_col=id_col, text_col=text_col, most_words=most_words)
    scored = stored(weighed.withColumn("score", F.col("weight") + noise(salt)), "scored")
    return draw(scored, least_words=least_words, percent=percent).select("doc_id", "n_features", "weight", "score", "rank")


def draw(scored: DataFrame, *, least_words: int, percent: int) -> DataFrame:
    """`scored` with the rank of the rows drawn.

    The histogram has as many rows as there are integer scores: some ten thousand,
    as gains are logarithms of counts and the noise of 32 bits is below 23 000.
    """
    fit = F.col("n_words") >= least_words
    histogram = scored.filter(fit).groupBy("score").agg(F.count("*").alias("n")).collect()
    histogram.sort(key=lambda r: -r.score)
    wanted = percent * sum(r.n for r in histogram) // 100
    first, before = {}, 0
    for row in histogram:
        if before >= wanted:
            break
        first[row.score] = before
        before += row.n
    last = min(first, default=None)
    chosen = F.lit(False) if last is None else fit & (F.col("score") >= last)
    offsets = scored.sparkSession.createDataFrame(list(first.items()), "score long, offset long")
    within = Window.partitionBy("score").orderBy("doc_id", "n_features", "weight")
    survivors = scored.filter(chosen).withColumn("place", F.row_number().over(within).cast("long"))
    rank = F.col("offset") + F.col("place")
    ranked = survivors.join(F.broadcast(offsets), "score").select(*scored.columns, F.when(rank <= wanted, rank).alias("rank"))
    rest = scored.filter(~chosen | chosen.isNull()).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest)


def _sql_buckets(table: str) -> str:
    """(word, bucket) of the distinct words of `table`: crc32 byte by byte, by its table."""
    return f"""
  SELECT word, list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), list_transform(range(CAST(octet_length(encode(word)) AS BIGINT)),
      lambda i: CAST('0x' || substr(hex(encode(word)), 2 * i + 1, 2) AS UBIGINT))),
      lambda c, b: xor(c >> 8, crc[CAST((xor(c, b) & 255) + 1 AS BIGINT)])) AS c
  FROM (SELECT DISTINCT word FROM {table}), crc_table"""


#: DuckDB SQL for resample(documents, benchmark) with the parameters above.
RESAMPLE_SQL = rf"""
WITH crc_table AS (
  SELECT list(c ORDER BY b) AS crc FROM (
    SELECT b, list_reduce(list_prepend(CAST(b AS UBIGINT), list_transform(range(8), lambda i: CAST(i AS UBIGINT))),
      lambda c, i: xor(c >> 1, CASE WHEN c & 1 = 1 THEN CAST(3988292384 AS UBIGINT) ELSE CAST(0 AS UBIGINT) END)) AS c FROM range(256) t(b))
), docs AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws FROM documents
), aims AS (
  SELECT list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws FROM benchmark
), dw AS (SELECT doc_id, unnest(ws) AS word FROM docs), aw AS (SELECT unnest(ws) AS word FROM aims),
every AS (SELECT word FROM dw UNION SELECT word FROM aw),
buckets AS (SELECT word, CAST(xor(c, CAST(4294967295 AS UBIGINT)) % {BUCKETS} AS BIGINT) AS bucket FROM ({_sql_buckets('every')})),
raw AS (SELECT bucket, count(*) AS s FROM dw JOIN buckets USING (word) GROUP BY bucket),
aim AS (SELECT bucket, count(*) AS t FROM aw JOIN buckets USING (word) GROUP BY bucket),
totals AS (SELECT (SELECT count(*) FROM dw) AS ss, (SELECT count(*) FROM aw) AS tt),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (ss + {BUCKETS})::DOUBLE
    / ((s + 1)::DOUBLE * (tt + {BUCKETS})::DOUBLE))) AS BIGINT) AS g
  FROM raw LEFT JOIN aim USING (bucket), totals
), weighed AS (
  SELECT doc_id, count(*) AS n, CAST(floor(sum(g)::DOUBLE / count(*)) AS BIGINT) AS w
  FROM dw JOIN buckets USING (word) JOIN gain USING (bucket) GROUP BY doc_id
), scored AS (
  SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features, coalesce(w, 0) AS weight,
    coalesce(w, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{SALT}:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
      / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM docs d LEFT JOIN weighed USING (doc_id)
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS fit
  FROM scored WHERE n_features >= {LEAST_WORDS}
)
SELECT s.doc_id, n_features, weight, score, CASE WHEN rank <= {PERCENT} * fit // 100 THEN rank END AS rank
FROM scored s LEFT JOIN ranked USING (doc_id)
"""
