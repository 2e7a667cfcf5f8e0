"""Literals, names and IRIs by value tables."""

import pytest
from pyspark.sql import functions as F

from terraweave import vocabulary as V
from terraweave.functions import tags
from terraweave.functions import text as T


def table(spark, values, make):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string")
    return [r.x for r in rows.select("k", make(F.col("v")).alias("x")).orderBy("k").collect()]


def test_string_literals(spark):
    got = table(spark, ['a"b', "a\\b", "a\nb\rc", "a\tb'c", ""], T.string_literal)
    assert got == ['"a\\"b"', '"a\\\\b"', '"a\\nb\\rc"', '"a\tb\'c"', '""']


def test_single_quoted(spark):
    assert table(spark, ["it's", 'a"b\\'], T.single_quoted_literal) == ["'it\\'s'", "'a\"b\\\\'"]


def test_iri_references(spark):
    values = ["<prefix>", "allöwed", "a b", "\x01{|}^`\\\"", "\\u003c"]
    assert table(spark, values, lambda v: T.iri_ref(v, "ttl")) == [
        "\\u003cprefix\\u003e", "allöwed", "a\\u0020b", "\\u0001\\u007b\\u007c\\u007d\\u005e\\u0060\\u005c\\u0022", "\\u005cu003c",
    ]
    assert table(spark, values, lambda v: T.iri_ref(v, "qlever"))[0:4] == [
        "%3cprefix%3e", "allöwed", "a%20b", "%01%7b%7c%7d%5e%60%5c%22",
    ]


def test_local_names(spark):
    values = [".bc", "a.c", "ab.", "-bc", "a-c", "()*+,;=/", "{|}", "100%", "größe", "a'b", ""]
    assert table(spark, values, T.pn_local) == [
        "\\.bc", "a.c", "ab\\.", "\\-bc", "a-c", "\\(\\)\\*\\+\\,\\;\\=\\/", "%7b%7c%7d", "100\\%", "größe", "a\\'b", "",
    ]


def test_key_classes(spark):
    values = ["name:de", "a.b", ".a", "a b", "größe", "a×b", "·a", "a·b", "‿a", " x"]
    assert table(spark, values, T.key_class) == [0, 0, 1, 1, 1, 2, 2, 1, 2, 1]


def test_iris_by_format(spark):
    assert table(spark, ["a b"], lambda v: T.iri("osmkey", v, "ttl")) == ["osmkey:a%20b"]
    assert table(spark, ["a b"], lambda v: T.iri("osmkey", v, "nt")) == [f"<{V.PREFIXES['osmkey']}a\\u0020b>"]
    assert table(spark, ["-5", "17179869184"], lambda v: T.id_iri("osmnode", v, "ttl")) == ["osmnode:\\-5", "osmnode:17179869184"]


def test_times(spark):
    rows = spark.createDataFrame([(0,), (1555936496,), (-1,)], "s long")
    got = [r.x for r in rows.select(T.date_time("s", "ttl").alias("x")).collect()]
    assert [g.split('"')[1] for g in got] == ["1970-01-01T00:00:00", "2019-04-22T12:34:56", "1969-12-31T23:59:59"]


def test_numbers(spark):
    rows = spark.createDataFrame([(48.0,), (7.51,), (-0.00000001,), (122568687.46541,), (100.0,)], "x double")
    assert [r.x for r in rows.select(T.trimmed(F.col("x"), 4).alias("x")).collect()] == ["48", "7.51", "0", "122568687.4654", "100"]


def test_lang_tags(spark):
    values = ["one", "Four-four", "SIX-6", "Seven-7-seven", "2", "-Three", "Five5", "Eight§"]
    assert table(spark, values, T.lang_tag) == ["@one", "@Four-four", "@SIX-6", "@Seven-7-seven", None, None, None, None]


def test_single_values():
    assert (T.uchar(0x64), T.uchar(0xFFF64), T.uchar(0xFF)) == ("\\u0064", "\\U000fff64", "\\u00ff")
    assert (T.percent(0x7C), T.percent(0xFFF64)) == ("%7c", "%0f%ff%64")
    assert T.valid_prefix_name("osm2") == "osm2"
    for bad in ("-a", "a b", "1a"):
        with pytest.raises(ValueError):
            T.valid_prefix_name(bad)


def test_admin_levels(spark):
    values = ["42", "5", "+5", "-5", "   -5  ", "+5  ", "", "  ", "A5", "99999999999999999999"]
    assert table(spark, values, tags.admin_level) == [42, 5, 5, -5, -5, 5, None, None, None, 2**63 - 1]


def test_dates(spark):
    values = "11 -11 1111 -1111 11-1 -11-1 1111-11 -1111-11 -1111-13 11-1-1 -11-1-1 1111-11-11 -1111-11-32 lorem -lo-r-em- -1111-22-33-44 20200101 2000- 2000--01 - -- --5".split()
    got = table(spark, [*values, ""], lambda v: F.concat_ws(" ", tags.date(v)["kind"], tags.date(v)["text"]))
    assert got == [
        "gYear 0011", "gYear -0011", "gYear 1111", "gYear -1111", "gYearMonth 0011-01", "gYearMonth -0011-01",
        "gYearMonth 1111-11", "gYearMonth -1111-11", "", "date 0011-01-01", "date -0011-01-01", "date 1111-11-11",
        "", "", "", "", "gYear 2020", "", "", "", "", "gYearMonth -0000-05", "",
    ]


def test_years_of_many_digits(spark):
    values = ["20201199995", "-99999999999999999999-5", "000000000000000012", "00000"]
    got = table(spark, values, lambda v: F.concat_ws(" ", tags.date(v)["kind"], tags.date(v)["text"]))
    assert got == ["gYear 2020", "gYearMonth -9999-05", "gYear 0012", "gYear 0000"]


def test_wiki_values(spark):
    assert table(spark, ["  Q42  ", "Q42;Q1337", "q7", ""], tags.wikidata_id) == ["Q42", "Q42", "7", ""]
    got = table(spark, ["de:Bremen im Breisgau", "Bremen_im_Breisgau", "fr:a:b"], lambda v: tags.wikipedia_iri(v, "qlever"))
    assert got == [
        "<https://de.wikipedia.org/wiki/Bremen%20im%20Breisgau>", "<https://www.wikipedia.org/wiki/Bremen_im_Breisgau>",
        "<https://fr.wikipedia.org/wiki/a:b>",
    ]
