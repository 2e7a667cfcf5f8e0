"""MinHash near-dedup: HyperMinHash registers, banding, estimates, full-set checks.

Texts with equal shingle sets form classes first. A class has a HyperMinHash sketch
whose registers, four at a time, name the buckets it falls into. In each bucket the
member that meets most others is the head; star pairs (member, head) are estimated
from the registers and confirmed on full sets. Two texts of one bucket that are
still in different components are compared in a second round, so no link between
bucket mates is lost:

* strays are the members outside their group's largest component;
* groups of at most SMALL_GROUP members pair their strays with the other members;
* in larger groups each member is described by its difference to the head: how many
  elements of the head it lacks, and the elements that only one of the two has. The
  intersection of two members is the head's size less what each lacks, plus what
  their differences share. Blocks of strays meet blocks of members, one row for a
  pair of blocks, and all overlaps of two blocks are one matrix product; only links
  leave the task.

Groups and buckets of more than HOT rows are never gathered in a task: what is known of
such a group is broadcast to its rows, and pairs of its blocks are dealt by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hyperminhash as hm
from .components import connected_components
from .pieces import byte_slices, map_in_arrow
from .shingles import shingle_sets
from .tables import BROADCAST_IDS, remove_table, stored, without_ids

#: Similarity in hundredths, as in 100 * intersection >= SIMILARITY * union.
SIMILARITY = 80
SMALL_GROUP = 48
#: Members in a block of a larger group, on average, and matrix columns at a time.
BLOCK = 96
COLUMNS = 8192
#: A group of more rows than this is joined by broadcast.
HOT = 1000
BATCH_BYTES = 1 << 20


def _with_group(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """`rows` with their group's columns; `groups` has a stored row (key, size, ...) for each.

    Rows of hot groups stay where they are: there are fewer such groups than rows by
    HOT times, and their rows of `groups` are broadcast, BROADCAST_IDS at most; beyond
    that the join shuffles.
    """
    hot = groups.filter(F.col(size) > HOT)
    if not 0 < hot.count() <= BROADCAST_IDS:
        return rows.join(groups, key)
    cold = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(groups.filter(F.col(size) <= HOT), key)
    return cold.unionByName(rows.join(F.broadcast(hot), key).select(*cold.columns))


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str | None]]]:
    """Runs of a batch's texts (column 1) of about BATCH_BYTES bytes."""
    for at, n in byte_slices(batch.column(1), BATCH_BYTES):
        yield at, batch.column(1).slice(at, n).to_pylist()


def sketches(df: DataFrame, words: int, *, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n, sig, bands): set size, its 128-bit name and HyperMinHash bands.

    A null text, or one without words, has n = 0 and null sig and bands.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in _pieces(batch):
                sets = shingle_sets(texts, words)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(sets)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hm.signature(s) if len(s) else None for s in sets], pa.binary()),
                        pa.array([hm.bands(s).tolist() if len(s) else None for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n", "sig", "bands"],
                )

    texts = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_in_arrow(texts, sketch, "doc_id long, n long, sig binary, bands array<long>")


def _sets_of(df: DataFrame, ids: DataFrame, words: int, text_col: str, id_col: str) -> DataFrame:
    """(id, elements): the full shingle sets of the documents in `ids` (id)."""
    texts = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    few = ids.count() <= BROADCAST_IDS
    wanted = texts.join(F.broadcast(ids) if few else ids, "id", "left_semi")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, own in _pieces(batch):
                sets = shingle_sets(own, words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(sets)), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["id", "elements"],
                )

    # repeated ids stand for one document; the class's representative is any of them
    return map_in_arrow(wanted, build, "id long, elements binary")


def _may_link(a: str, b: str, similarity: int) -> F.Column:
    """Sets this different in size cannot be similar."""
    low, high = F.least(a, b), F.greatest(a, b)
    return low * 100 >= high * similarity


def _estimated(pairs: DataFrame, classes: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) whose sizes and register estimates allow a link.

    The floor lies six standard deviations under the similarity, reckoned with the
    registers that a set of that size fills by itself.
    """
    one = classes.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("bands").alias("bands_a"))
    two = classes.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("bands").alias("bands_b"))
    known = pairs.join(one, "a").join(two, "b").filter(_may_link("n_a", "n_b", similarity))
    level = similarity / 100

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (batch.column(k).flatten().to_numpy(zero_copy_only=False) for k in (4, 5))
            guess = hm.estimate(a, b)
            n = np.minimum(batch.column(2).to_numpy(), batch.column(3).to_numpy())
            filled = hm.BUCKETS * -np.expm1(-n / hm.BUCKETS)
            floor = level - 6 * np.sqrt(level * (1 - level) * 1.5 / filled)
            yield pa.RecordBatch.from_arrays(batch.columns[:4], names=batch.schema.names[:4]).filter(
                pa.array(guess >= floor)
            )

    sketched = known.select("a", "b", "n_a", "n_b", "bands_a", "bands_b")
    return map_in_arrow(sketched, keep, "a long, b long, n_a long, n_b long")


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    one = sets.select(F.col("id").alias("a"), F.col("elements").alias("elements_a"))
    two = sets.select(F.col("id").alias("b"), F.col("elements").alias("elements_b"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "elements_a", "elements_b")


def _links(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) that are similar on their full sets."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                one, two = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * common >= similarity * (len(one) + len(two) - common))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return map_in_arrow(_with_sets(pairs, sets), check, "a long, b long")


def _differences(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, n, lacks, n_b, elements): a's size, how many elements of its head b it
    lacks, b's size, and the elements that only one of the two has."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, lacks, n_b, elements = [], [], [], []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                own, head = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                only = np.setxor1d(own, head, assume_unique=True)
                n.append(len(own))
                n_b.append(len(head))
                lacks.append((len(only) + len(head) - len(own)) // 2)
                elements.append(only.tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], *(pa.array(c, pa.int64()) for c in (n, lacks, n_b)), pa.array(elements, pa.binary())],
                names=["a", "b", "n", "lacks", "n_b", "elements"],
            )

    return map_in_arrow(
        _with_sets(pairs, sets), build, "a long, b long, n long, lacks long, n_b long, elements binary"
    )


def _shared(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of `one` shares with each of `two`."""
    sizes = np.array([len(x) for x in [*one, *two]])
    rows = np.repeat(np.arange(len(sizes)), sizes)
    every, at = np.unique(np.concatenate([*one, *two]), return_inverse=True)
    order = np.argsort(at, kind="stable")
    rows, at = rows[order], at[order]
    out = np.zeros((len(one), len(two)), np.float32)
    for low in range(0, len(every), COLUMNS):
        span = slice(*np.searchsorted(at, (low, low + COLUMNS)))
        table = np.zeros((len(sizes), min(COLUMNS, len(every) - low)), np.float32)
        table[rows[span], at[span] - low] = 1
        out += table[: len(one)] @ table[len(one) :].T
    return out


def _block_links(members: DataFrame, told: DataFrame, similarity: int) -> DataFrame:
    """Links (a, b) between strays and members of their groups, by blocks."""
    known = members.join(told, ["a", "b"])
    entry = F.struct(F.col("a").alias("id"), F.col("of_a").alias("of"), "n", "lacks", "elements")

    def blocks(rows: DataFrame, total: str, name: str) -> DataFrame:
        part = F.pmod(F.xxhash64("a"), F.ceil(F.col(total) / BLOCK)).cast("int")
        return rows.groupBy("b", part.alias(f"{name}_block")).agg(
            F.collect_list(entry).alias(name), F.first("n_b").alias(f"{name}_head"), F.first("size").alias(f"{name}_of")
        )

    # each block of strays goes to every block of members, wherever that is
    last = F.ceil(F.col("one_of") / BLOCK).cast("int") - 1
    strays = blocks(known.filter("of_a <> most"), "strays", "one").withColumn("two_block", F.explode(F.sequence(F.lit(0), last)))
    met = strays.join(blocks(known, "size", "two"), ["b", "two_block"]).select("one", "two", F.col("one_head").alias("n_b"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one, two = (batch.column(k)[row].as_py() for k in (0, 1))
                head = batch.column(2)[row].as_py()
                both = [[np.frombuffer(x["elements"], np.uint64) for x in side] for side in (one, two)]
                (n1, l1, c1), (n2, l2, c2) = (
                    [np.array([x[f] for x in side], np.int64) for f in ("n", "lacks", "of")] for side in (one, two)
                )
                common = _shared(*both).astype(np.int64) + (head - l1[:, None] - l2[None, :])
                union = n1[:, None] + n2[None, :] - common
                i, j = np.nonzero((100 * common >= similarity * union) & (c1[:, None] != c2[None, :]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([one[k]["id"] for k in i], pa.int64()),
                        pa.array([two[k]["id"] for k in j], pa.int64()),
                    ],
                    names=["a", "b"],
                )

    return map_in_arrow(met, compare, "a long, b long")


def near_duplicates(
    df: DataFrame, *, words: int = 5, similarity: int = SIMILARITY, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """One row (doc_id, n_shingles, component_id, kept) per input row.

    Null texts and texts without words have no shingles, are linked with nothing and
    kept. Rows with equal sets share a component whatever their number; ties go to the
    least doc_id. A null doc_id gives a null component and kept = null. Repeated ids are one
    document for linking. Ids are whole numbers; others raise. Other columns of `df`
    are not read. An empty table gives an empty result.
    """
    drawn = stored(sketches(df, words, text_col=text_col, id_col=id_col), "sketches")
    classes = stored(
        drawn.filter("n > 0 and doc_id is not null")
        .groupBy("sig")
        .agg(F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands")),
        "classes",
    )
    component = _class_components(df, classes, words, similarity, text_col, id_col)
    named = classes.select("sig", "id").join(component, "id", "left").select(
        "sig", F.coalesce("component", "id").alias("of_class")
    )
    whole = drawn.select("doc_id", F.col("n").alias("n_shingles"), "sig").join(named, "sig", "left")
    return whole.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("of_class", "doc_id")).alias("component_id"),
        (F.col("doc_id") == F.coalesce("of_class", "doc_id")).alias("kept"),
    )


def _class_components(
    df: DataFrame, classes: DataFrame, words: int, similarity: int, text_col: str, id_col: str
) -> DataFrame:
    """(id, component) of the classes that have links."""
    rows = classes.select("id", F.posexplode("bands").alias("band", "key")).select(
        "id", F.xxhash64("band", "key").alias("bucket")
    )
    shared = stored(rows.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1"), "shared")
    mates = stored(_with_group(rows, shared, "bucket", "members"), "mates")
    met = mates.groupBy("id").agg(F.sum(F.col("members") - 1).alias("met"))
    ranked = stored(mates.join(met, "id"), "ranked")
    heads = stored(
        ranked.groupBy("bucket")
        .agg(F.max(F.struct("met", (-F.col("id")).alias("minus"))).alias("most"), F.first("members").alias("members"))
        .select("bucket", (-F.col("most.minus")).alias("b"), "members"),
        "heads",
    )
    stars = stored(
        _with_group(ranked.select(F.col("id").alias("a"), "bucket"), heads, "bucket", "members")
        .filter("a <> b").select("a", "b").distinct(),
        "stars",
    )
    for done in (shared, mates, ranked, heads):
        remove_table(done)
    # every set that either round compares, made once
    sets = stored(_sets_of(df, _ends(stars), words, text_col, id_col), "sets")
    likely = _estimated(stars, classes, similarity)
    links = stored(_links(likely.select("a", "b"), sets, similarity), "links")
    component = connected_components(links)

    # the second round: members outside their group's largest component
    named = component.select("id", "component")
    of_a = stored(
        stars.join(named.withColumnRenamed("id", "a"), "a", "left").select("a", "b", F.coalesce("component", "a").alias("of_a")),
        "placed",
    )
    parts = stored(of_a.groupBy("b", "of_a").agg(F.count("*").alias("n")), "parts")
    largest = stored(
        parts.groupBy("b")
        .agg(F.sum("n").alias("size"), F.max(F.struct("n", "of_a")).alias("top"))
        .select("b", "size", F.col("top.of_a").alias("most"), (F.col("size") - F.col("top.n")).alias("strays"))
        .filter("strays > 0"),
        "largest",
    )
    members = stored(_with_group(of_a, largest, "b", "size"), "members")
    pairs = _mates_of_strays(members.filter(F.col("size") <= SMALL_GROUP))
    further = _links(_estimated(pairs, classes, similarity).select("a", "b"), sets, similarity)
    large = members.filter(F.col("size") > SMALL_GROUP)
    told = None
    if large.limit(1).count():
        told = stored(_differences(large.select("a", "b"), sets), "differences")
        further = further.union(_block_links(large, told, similarity))
    out = connected_components(links.union(further))
    for done in (stars, sets, links, of_a, parts, largest, members, *([] if told is None else [told])):
        remove_table(done)
    return out


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()


def _mates_of_strays(members: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of a stray and a member of its group in another component."""
    strays = members.filter("of_a <> most").select(
        F.col("a").alias("x"), F.col("of_a").alias("of_x"), F.col("b").alias("head")
    )
    others = members.select(F.col("a").alias("y"), F.col("of_a").alias("of_y"), F.col("b").alias("head"))
    met = strays.join(others, "head").filter("of_x <> of_y")
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def drop_near_duplicates(df: DataFrame, *, words: int = 5, similarity: int = SIMILARITY) -> DataFrame:
    """The rows of `df` that near_duplicates keeps, all their columns; null ids stay."""
    found = near_duplicates(df, words=words, similarity=similarity)
    return without_ids(df, found.filter("not kept").select("doc_id").distinct(), "doc_id")


#: DuckDB SQL for near_duplicates(documents, words=2): all pairs that share a shingle.
NEAR_DUPLICATES_SQL = f"""
WITH RECURSIVE cut AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) < 2 THEN ws ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS s
  FROM cut
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  WHERE 100 * least(x.n, y.n) >= {SIMILARITY} * greatest(x.n, y.n)
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= {SIMILARITY} * (x.n + y.n - count(*))
), reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT c.doc_id, coalesce(n, 0) AS n_shingles, least(c.doc_id, coalesce(l.b, c.doc_id)) AS component_id,
  c.doc_id = least(c.doc_id, coalesce(l.b, c.doc_id)) AS kept
FROM cut c LEFT JOIN sizes z ON z.doc_id = c.doc_id LEFT JOIN least_of l ON l.a = c.doc_id
"""
