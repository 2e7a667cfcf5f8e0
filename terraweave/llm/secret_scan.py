"""Secret scans: candidates by shape, false positives removed by a random forest.

Candidates are all runs of value characters that are long enough and mix character
kinds or that a key introduces, and all that a key name of secrets introduces. The
forest looks at length, character transitions, dictionary coverage, path and
neighbouring words; it is trained on labelled findings. The dictionary has words of
programs and the most frequent words of the corpus. All steps are DataFrame functions
and the JVM's tree ensembles.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Labelled findings that a forest is fitted on, its size and its threshold.
LABELLED = 8000
TREES, DEPTH, SEED = 24, 8, 7
THRESHOLD = 0.5
SHORTEST = 12
#: A run without digits that no key introduces has so many characters at least.
LONG = 20

#: Words that names and identifiers of any program are made of; those of
#: the corpus at hand come from `learned_words`.
DICTIONARY = (
    "access account action address admin array asset author backup base block board body buffer build button cache "
    "call card category change channel check child class client cloud cluster code color column command comment "
    "company component config connect container content context control copy count create current customer data "
    "database date default delete deploy design device directory display document domain driver element email "
    "enable engine entity entry error event example export factory field file filter folder format frame function "
    "gateway global graph group handler header history home image import index info input instance interface item "
    "kernel label language layer layout library license line link list listener local location login lookup mail "
    "main manager mapping master media member memory message method metric mobile model module monitor name network "
    "node number object option order output package page panel parent parser password path pattern payment phone "
    "placeholder player plugin point policy pool port process product profile project property provider proxy "
    "public query queue random record region register report request reset resource response result role root route "
    "runtime schema screen script search section security"
).split()
#: Words that are learned from a corpus, words that are counted for each, and letters
#: that a word has at least.
LEARNED, TRIED, LEAST_LETTERS = 150, 4, 4
#: Items that the search for frequent words keeps.
TRACKED = 10_000
#: Key names that introduce secrets, and words beside things that are none.
KEY_WORDS = r"(?i)pass(word|wd|phrase)?|pwd|secret|token|api.?key|auth|credential|private|access.?key|bearer"
CALM_WORDS = r"(?i)^\W*(example|dummy|sample|placeholder|commit|sha1?|sha256|md5|checksum|digest|hash|etag|uuid|guid|id|version|rev|revision|order|isbn|invoice|serial|build)\W*$"
VENDOR = r"^(AKIA|ASIA|ghp_|gho_|github_pat_|glpat-|sk_live_|sk-|xox[abp]-|AIza|eyJ)"
CALM_PATH = r"(?i)test|example|sample|fixture|mock|docs?/|vendor|node_modules|\.lock$"
RISKY_PATH = r"(?i)\.env|config|secret|credential|deploy|settings|\.ya?ml$|\.properties$"

FEATURES = [
    "length", "transitions", "coverage", "digits", "uppers", "variety", "entropy", "hex", "uuid", "vendor",
    "keyed", "calm", "assigned", "filler", "risky_path", "calm_path", "letters_only", "digits_only",
]
_LETTERS = "abcdefghijklmnopqrstuvwxyz"


_RUN = r"[A-Za-z0-9_+/\-]"
_QUOTE = r"""\\?["'`]"""
#: A key and its sign before a value, also within a word: not where a value begins.
_PAIR = (
    rf"""(?<![\w.\-=:])(?<![=:]["'`])(?<![=:]\\["'`])([A-Za-z_][\w.\-]*+)(?:{_QUOTE})?[=:]++(?:{_QUOTE})?(?=[^=:;,&"'`)\]}}\\])"""
)
_SECRET_KEY = KEY_WORDS.replace("(?i)", "")
_BLOCK = 256


def _bound(value: Column, of: Callable[[Column], Column]) -> Column:
    """of(value), with the value reckoned once."""
    return F.get(F.transform(F.array(value), of), 0)


def _located(parts: Column) -> Column:
    """(text, from, at) of each part: how many code points and parts stand before it."""
    total = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x)
    whole = lambda sizes: F.transform(
        F.sequence(F.lit(0), F.floor(F.size(sizes) / _BLOCK).cast("int")),
        lambda b: total(F.slice(sizes, b * _BLOCK + 1, _BLOCK)),
    )

    def place(own: Column, sizes: Column, blocks: Column) -> Column:
        return F.transform(
            own,
            lambda x, i: F.struct(
                x.alias("text"),
                (
                    total(F.slice(blocks, 1, F.floor(i / _BLOCK).cast("int")))
                    + total(F.slice(sizes, i - i % _BLOCK + 1, i % _BLOCK))
                ).alias("from"),
                i.alias("at"),
            ),
        )

    return _bound(
        parts,
        lambda own: _bound(
            F.transform(own, lambda x: F.length(x)),
            lambda sizes: _bound(whole(sizes), lambda blocks: place(own, sizes, blocks)),
        ),
    )


def candidates(df: DataFrame, *, text_col: str = "text", id_col: str = "doc_id", path_col: str | None = "source") -> DataFrame:
    """(doc_id, start, value, key, before, after, path): what may be a secret.

    `start` counts code points from 0. Each word is cut at all its key/value pairs,
    and each run of value characters that is long enough is a candidate with the key
    in front of it, in the same word or the one before; what a key name of secrets
    introduces is one whatever its length and marks. Null and empty texts have none; a
    missing path column, or a null path, is an empty path.
    """
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col in df.columns else F.lit("")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    cut = df.select(
        F.col(id_col).alias("doc_id"),
        path.alias("path"),
        # without such a mark no key introduces anything
        (text.contains("=") | text.contains(":")).alias("signed"),
        F.split(text, r"\s").alias("words"),
    )

    def introduced(word: Column, one: Column, two: Column) -> Column:
        """Whether the word holds a key of secrets and its sign, or follows them."""
        return ((word.contains("=") | word.contains(":")) & word.rlike(rf"(?i)(?:{_SECRET_KEY})[\w.\-\\\"'`]*[=:]+.")) | (
            (one.endswith("=") | one.endswith(":"))
            & (one.rlike(rf"(?i)(?:{_SECRET_KEY})[\w.\-\\\"'`]*[=:]+$") | (one.rlike("^[=:]+$") & two.rlike(KEY_WORDS)))
        )

    def looked_at(words: Column, signed: Column, word: Column, at: Column) -> Column:
        """Whether a word may hold a candidate; what is cheap to tell comes first."""
        beside = word.contains("=") | word.contains(":") | F.coalesce(F.get(words, at - 1).rlike("[=:]$"), F.lit(False))
        size = F.length(word)
        run = (size >= SHORTEST) & ((size >= LONG) | word.rlike("[0-9]") | (signed & beside)) & word.rlike(rf"{_RUN}{{{SHORTEST}}}")
        return run | (signed & (word != "") & F.coalesce(introduced(word, F.get(words, at - 1), F.get(words, at - 2)), F.lit(False)))

    # bound, as the optimiser would cut and search the text again for each word
    chosen = _bound(
        F.col("signed"),
        lambda signed: _bound(
            F.col("words"),
            lambda words: F.array_compact(
                F.transform(
                    words,
                    lambda w, i: F.when(looked_at(words, signed, w, i), F.struct(i.alias("at"), w.alias("word"))),
                )
            ),
        ),
    )
    found = cut.withColumn("found", chosen).filter(F.size("found") > 0)
    near = F.transform(
        "found",
        lambda x: F.struct(
            x["word"].alias("word"),
            # each word before it, and one blank for each
            (F.length(F.array_join(F.slice("words", 1, x["at"]), " ")) + F.when(x["at"] > 0, 1).otherwise(0)).alias("from"),
            F.coalesce(F.get("words", x["at"] - 1), F.lit("")).alias("one"),
            F.coalesce(F.get("words", x["at"] - 2), F.lit("")).alias("two"),
            F.coalesce(F.get("words", x["at"] + 1), F.lit("")).alias("after"),
        ),
    )
    rows = found.select("doc_id", "path", F.explode(near).alias("x")).select("doc_id", "path", "x.*")
    parts = rows.select(
        "doc_id", "path", "from", "one", "two", "after",
        F.explode(_located(F.split("word", f"(?={_PAIR})"))).alias("part"),
    )
    first = F.col("part.at") == 0
    sign = first & F.col("one").rlike(r"^[=:]+$")
    own_key = F.regexp_extract("part.text", f"^{_PAIR}", 1)
    head = F.regexp_extract("part.text", f"^{_PAIR}", 0)
    key = F.when(own_key != "", own_key).when(sign, F.col("two")).when(
        first & F.col("one").rlike(r"[=:]$"), F.regexp_replace("one", r"[=:]+$", "")
    ).otherwise("")
    keyed = parts.select(
        "doc_id", "path", key.alias("key"), "after",
        (F.col("from") + F.col("part.from") + F.length(head)).alias("from"),
        F.substring("part.text", F.length(head) + 1, F.length("part.text")).alias("rest"),
        F.regexp_extract(head, r"""(["'`])$""", 1).alias("quote"),
        F.when(~first, F.lit("")).when(sign, F.col("two")).otherwise(F.col("one")).alias("before"),
        (sign | (first & F.col("one").rlike(r"[=:]$")) | (own_key != "")).alias("assigned"),
    )
    # the whole value: to the quote that it began with, else without closing marks
    opened = F.when(F.col("quote") == "", F.regexp_extract("rest", rf"^(?:{_QUOTE}|[(\[{{])+", 0)).otherwise("")
    inner = F.substring("rest", F.length(opened) + 1, F.length("rest"))
    mark = F.when(F.col("quote") != "", F.col("quote")).otherwise(F.regexp_extract(opened, r"""(["'`])$""", 1))
    value = F.when(
        (mark != "") & inner.contains(mark), F.regexp_replace(F.split_part(inner, mark, F.lit(1)), r"\\\\$", "")
    ).otherwise(F.regexp_replace(inner, r"""[;,&"'`)\]}>.:|<\\\\]+$""", ""))
    runs = F.filter(
        _located(F.regexp_extract_all("rest", F.lit(rf"{_RUN}+={{0,2}}|[^A-Za-z0-9_+/\-]+"), F.lit(0))),
        lambda x: x["text"].rlike(rf"^{_RUN}{{{SHORTEST}}}"),
    )
    each = F.transform(runs, lambda x: F.struct(x["text"].alias("value"), x["from"].alias("at"), F.lit(False).alias("whole")))
    own = F.struct(value.alias("value"), F.length(opened).alias("at"), F.lit(True).alias("whole"))
    secret = F.col("assigned") & F.col("key").rlike(KEY_WORDS)
    both = F.when(secret, F.concat(F.array(own), F.filter(each, lambda x: x["value"] != value))).otherwise(each)
    return (
        keyed.withColumn("found", both)
        .select("doc_id", "path", "key", "before", "after", "assigned", "from", F.explode("found").alias("x"))
        .filter(
            F.when(F.col("x.whole"), F.col("x.value") != "").otherwise(
                F.col("assigned") | F.col("x.value").rlike(r"[0-9]") | (F.length("x.value") >= LONG)
            )
        )
        .select(
            "doc_id", (F.col("from") + F.col("x.at")).cast("long").alias("start"), F.col("x.value").alias("value"),
            "key", "before", "after", "path", "assigned",
        )
    )


def learned_words(df: DataFrame, *, text_col: str = "text", n: int = LEARNED) -> list[str]:
    """The `n` most frequent words of all texts, ties in alphabetical order.

    A sketch of bounded size names TRIED times as many, which are then counted; of null
    and empty texts, and of an empty table, there are none.
    """
    shape = F.lit(rf"[a-z]{{{LEAST_LETTERS},}}")
    each = df.select(F.explode(F.regexp_extract_all(F.lower(F.col(text_col).cast("string")), shape, F.lit(0))).alias("word"))
    top = each.agg(F.expr(f"approx_top_k(word, {TRIED * n}, {TRACKED})").alias("top")).first().top
    tried = [x["item"] for x in top or []]
    if not tried:
        return []
    few = df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, tried))).alias("word"))
    counted = each.join(F.broadcast(few), "word").groupBy("word").count()
    return [r.word for r in counted.orderBy(F.desc("count"), "word").limit(n).collect()]


def with_features(found: DataFrame, words: Sequence[str] = DICTIONARY) -> DataFrame:
    """`found` (value, key, before, after, path, assigned) and the columns FEATURES;
    `words` are those that cover a value."""
    v = F.col("value")
    size = F.length(v)
    kinds = F.translate(
        v, _LETTERS + _LETTERS.upper() + "0123456789", "a" * 26 + "A" * 26 + "0" * 10
    )
    runs = F.length(F.regexp_replace(kinds, r"(.)\1+", "$1"))
    chars = F.split(v, "")
    distinct = F.array_distinct(F.filter(chars, lambda c: c != ""))
    entropy = F.aggregate(
        distinct,
        F.lit(0.0),
        lambda acc, c: acc
        - ((size - F.length(F.replace(v, c, F.lit("")))) / size) * F.log2((size - F.length(F.replace(v, c, F.lit("")))) / size),
    )
    covered = 1 - F.length(F.regexp_replace(F.lower(v), "|".join(sorted(set(words), key=lambda w: (-len(w), w))), "")) / size
    flag = lambda c: F.when(c, 1.0).otherwise(0.0)
    return (
        found.withColumn("length", size.cast("double"))
        .withColumn("transitions", ((runs - 1) / size).cast("double"))
        .withColumn("coverage", covered.cast("double"))
        .withColumn("digits", (F.length(F.regexp_replace(v, "[^0-9]", "")) / size).cast("double"))
        .withColumn("uppers", (F.length(F.regexp_replace(v, "[^A-Z]", "")) / size).cast("double"))
        .withColumn("variety", (F.size(distinct) / size).cast("double"))
        .withColumn("entropy", entropy.cast("double"))
        .withColumn("hex", flag(v.rlike("^([0-9a-f]+|[0-9A-F]+)$")))
        .withColumn("uuid", flag(v.rlike("^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$")))
        .withColumn("vendor", flag(v.rlike(VENDOR)))
        .withColumn("keyed", flag(F.concat_ws(" ", "key", "before").rlike(KEY_WORDS)))
        .withColumn("calm", flag(F.col("key").rlike(CALM_WORDS) | F.col("before").rlike(CALM_WORDS) | F.col("after").rlike(CALM_WORDS)))
        .withColumn("assigned", F.col("assigned").cast("double"))
        .withColumn("filler", flag(v.rlike(r"(?i)example|changeme|placeholder|your[_-]|x{4}|1234|(.)\1{4}")))
        .withColumn("risky_path", flag(F.col("path").rlike(RISKY_PATH)))
        .withColumn("calm_path", flag(F.col("path").rlike(CALM_PATH)))
        .withColumn("letters_only", flag(v.rlike("^[A-Za-z]+$")))
        .withColumn("digits_only", flag(v.rlike("^[0-9]+$")))
    )


#: Labelled kinds: (is a secret, value, key, word before, word after, path). In the
#: expressions a is hexadecimal noise, b base-64 noise, w and x dictionary words, y a
#: long word that can be spoken and is in no dictionary.
KINDS = (
    (1, "concat('AKIA', upper(substr(translate(b, '+/=_-', 'ABCDE'), 1, 16)))", "''", "w", "x", "p"),
    (1, "concat('ghp_', substr(translate(b, '+/=', 'xyz'), 1, 36))", "''", "w", "x", "p"),
    (1, "substr(a, 1, 12 + pmod(n, 30))", "'password'", "'password'", "x", "p"),
    (1, "substr(a, 1, 16 + pmod(n, 40))", "'token'", "'token'", "x", "p"),
    (1, "substr(b, 1, 20 + pmod(n, 30))", "'secret_key'", "'secret_key'", "x", "'deploy/config.yml'"),
    (1, "concat('sk_live_', substr(translate(b, '+/=', 'xyz'), 1, 24))", "'api_key'", "w", "x", "p"),
    (1, "substr(b, 1, 32)", "'authorization'", "'bearer'", "x", "p"),
    (1, "substr(a, 1, 32)", "'apikey'", "'apikey'", "x", "p"),
    (1, "concat(substr(b, 1, 3 + pmod(n, 6)), substr('!$#@%', 1 + pmod(n, 5), 1), substr(a, 1, 2 + pmod(n, 3)))", "'password'", "'password'", "x", "p"),
    (1, "substr(a, 1, 6 + pmod(n, 6))", "'secret'", "'secret'", "x", "p"),
    (0, "w", "'password'", "'password'", "x", "p"),
    (0, "concat('<', w, '>')", "'token'", "'token'", "x", "p"),
    (0, "substr(a, 1, 40)", "''", "'commit'", "x", "p"),
    (0, "substr(a, 1, 32)", "'md5'", "'md5'", "x", "p"),
    (0, "substr(a, 1, 64)", "'sha256'", "'digest'", "x", "p"),
    (0, "substr(a, 1, 40)", "''", "w", "x", "'docs/example.md'"),
    (0, "concat_ws('-', substr(a, 1, 8), substr(a, 9, 4), substr(a, 13, 4), substr(a, 17, 4), substr(a, 21, 12))", "''", "'id'", "x", "p"),
    (0, "concat_ws('-', substr(a, 1, 8), substr(a, 9, 4), substr(a, 13, 4), substr(a, 17, 4), substr(a, 21, 12))", "'uuid'", "'uuid'", "x", "p"),
    (0, "concat(w, x, w)", "''", "x", "w", "p"),
    (0, "concat(w, initcap(x), initcap(w))", "''", "x", "w", "p"),
    (0, "concat(w, '_', x, '_', w, pmod(n, 90))", "w", "x", "w", "p"),
    (0, "concat(w, '/', x, '/', w, '-', pmod(n, 9))", "''", "w", "x", "p"),
    (0, "substr(y, 1, 12 + pmod(n, 14))", "''", "w", "x", "p"),
    (0, "initcap(substr(y, 1, 12 + pmod(n, 11)))", "''", "x", "w", "p"),
    (0, "substr(y, 1, 12 + pmod(n, 9))", "w", "w", "x", "p"),
    (0, "concat(substr(y, 1, 6), '-', substr(y, 7, 5), '-', w, '.example')", "''", "w", "x", "p"),
    (0, "translate(substr(a, 1, 12 + pmod(n, 8)), 'abcdef', '012345')", "''", "w", "x", "p"),
    (0, "translate(substr(a, 1, 16), 'abcdef', '678901')", "'order'", "'order'", "x", "p"),
    (0, "concat('changeme', pmod(n, 9999), 'example')", "'password'", "'password'", "x", "p"),
    (0, "concat('your_', w, '_token_here')", "'token'", "'token'", "x", "p"),
    (0, "concat('AKIA', upper(substr(a, 1, 9)), 'EXAMPLE')", "''", "'example'", "x", "'docs/readme.md'"),
    (0, "concat('xxxxxxxxxxxx', substr(a, 1, 2), 'xxxx')", "'api_key'", "'api_key'", "x", "p"),
)


def labelled_findings(spark: SparkSession, n: int = LABELLED) -> DataFrame:
    """`n` labelled findings (label, value, key, before, after, path, assigned), always the same."""
    words = "array(" + ", ".join(f"'{w}'" for w in DICTIONARY) + ")"
    base = spark.range(0, n, 1, 4).select(
        F.col("id").alias("n"),
        F.expr("concat(md5(cast(id as string)), md5(concat('x', id)))").alias("a"),
        F.expr("replace(base64(unhex(concat(md5(concat('b', id)), md5(concat('c', id))))), '\\n', '')").alias("b"),
        F.expr(f"get({words}, cast(pmod(xxhash64(id, 1), {len(DICTIONARY)}) as int))").alias("w"),
        F.expr(f"get({words}, cast(pmod(xxhash64(id, 2), {len(DICTIONARY)}) as int))").alias("x"),
        F.expr("get(array('src/main.py', '', 'lib/util.js', 'app/server.go', 'notes.txt'), cast(pmod(xxhash64(id, 3), 5) as int))").alias("p"),
        # consonants by one noise, vowels by another, in turn
        F.expr(
            "array_join(zip_with(split(translate(md5(concat('y', id)), '0123456789abcdef', 'bcdfghklmnprstvz'), ''), "
            "split(translate(md5(concat('z', id)), '0123456789abcdef', 'aeiouaeiouaeioua'), ''), (c, v) -> concat(c, v)), '')"
        ).alias("y"),
    )
    kind = F.pmod(F.col("n"), F.lit(len(KINDS)))

    def pick(k: int) -> Column:
        out = F.lit(None)
        for at, row in enumerate(KINDS):
            out = F.when(kind == at, F.expr(row[k])).otherwise(out)
        return out

    label = F.lit(0.0)
    for at, row in enumerate(KINDS):
        label = F.when(kind == at, F.lit(float(row[0]))).otherwise(label)
    return base.select(
        label.alias("label"), pick(1).alias("value"), pick(2).alias("key"), pick(3).alias("before"),
        pick(4).alias("after"), pick(5).alias("path"),
    ).withColumn("assigned", F.col("key") != "")


def fit(findings: DataFrame, words: Sequence[str] = DICTIONARY) -> RandomForestClassificationModel:
    """A forest from labelled findings, as of labelled_findings; its size bounds the fit.

    Findings of one's own, labelled by hand, serve as well: (label, value, key, before,
    after, path, assigned). `words` must be those of the scan.
    """
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(with_features(findings, words))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label", featuresCol="features")
    return forest.fit(rows.select("label", "features"))


def scan(
    df: DataFrame,
    model: RandomForestClassificationModel,
    *,
    words: Sequence[str] = DICTIONARY,
    threshold: float = THRESHOLD,
    path_col: str | None = "source",
) -> DataFrame:
    """(doc_id, start, candidate, probability, is_secret) of every candidate in `df`.

    Null or empty texts have no candidates; null ids pass through; repeated rows
    repeat their findings; texts are searched whole; an empty table gives none.
    """
    found = with_features(candidates(df, path_col=path_col), words)
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)
    scored = model.transform(rows).withColumn("p", vector_to_array("probability")[1])
    return scored.select(
        "doc_id",
        "start",
        F.col("value").alias("candidate"),
        F.round("p", 6).alias("probability"),
        (F.col("p") >= threshold).alias("is_secret"),
    )
