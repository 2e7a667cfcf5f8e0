"""What a tag becomes: raw literals, numbers, links and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as T

#: Keys with rules of their own.
ADMIN_LEVEL = "admin_level"
WIKIDATA, WIKIPEDIA = "wikidata", "wikipedia"
DATE_KEYS = ("start_date", "end_date")


def clean_key(key: Column) -> Column:
    """White space of ASCII becomes underscores."""
    return F.translate(key, " \t\n\x0b\f\r", "______")


def pieces(key: Column, value: Column, split_keys: list[str]) -> Column:
    """The value, or for the keys that are split its parts at semicolons."""
    if not split_keys:
        return F.array(value)
    return F.when(key.isin(split_keys), F.split(value, ";", -1)).otherwise(F.array(value))


def admin_level(value: Column) -> Column:
    """The whole number that the value spells; null where it spells none."""
    bare = F.regexp_replace(value, r"^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$", "")
    number = bare.rlike(r"^[+-]?[0-9]+$")
    # beyond 64 bits the nearest number counts
    far = F.when(F.substring(bare, 1, 1) == "-", F.lit(-(2**63))).otherwise(F.lit(2**63 - 1))
    return F.when(number, F.coalesce(bare.try_cast("bigint"), far))


def wikidata_id(value: Column) -> Column:
    """Of what stands before the first semicolon, the letters Q and digits."""
    return F.regexp_replace(F.substring_index(value, ";", 1), "[^Q0-9]", "")


def is_link_key(key: Column, kind: str) -> Column:
    return (key == kind) | F.endswith(key, F.lit(f":{kind}"))


def wikipedia_iri(value: Column, fmt: str) -> Column:
    """The page of `lang:entry`, by the first colon, or of the bare value."""
    lang = F.substring_index(value, ":", 1)
    entry = F.substring(value, F.length(lang) + 2, 1 << 30)
    page = T.full_iri(F.concat(F.lit("https://"), lang, F.lit(".wikipedia.org/wiki/")), entry, fmt)
    plain = T.full_iri(F.lit("https://www.wikipedia.org/wiki/"), value, fmt)
    return F.when(F.contains(value, F.lit(":")), page).otherwise(plain)


def date(value: Column) -> Column:
    """(datatype, text) of a year, month or day; null where the value is no date.

    Digits and hyphens only; a leading hyphen is a year before the era; the year is
    padded to four digits and cut after them; months reach 12, days 31.
    """
    # behind the leading hyphen an empty year counts as 0
    shape = r"^(?=.*[0-9])(-?)([0-9]*)(?:-([0-9]+))?(?:-([0-9]+))?$"
    part = [F.regexp_extract(value, shape, k) for k in range(5)]
    # by its digits, as a year may have more of them than a number holds
    year = F.concat(part[1], F.lpad(F.regexp_replace(part[2], "^0+", ""), 4, "0"))
    month, day = part[3].try_cast("int"), part[4].try_cast("int")
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    good_month, good_day = month.between(1, 12), day.between(1, 31)
    kind = (
        F.when(~value.rlike(shape), None)
        .when(part[3] == "", "gYear")
        .when(~F.coalesce(good_month, F.lit(False)), None)
        .when(part[4] == "", "gYearMonth")
        .when(F.coalesce(good_day, F.lit(False)), "date")
    )
    text = (
        F.when(part[3] == "", year)
        .when(part[4] == "", F.concat_ws("-", year, two(month)))
        .otherwise(F.concat_ws("-", year, two(month), two(day)))
    )
    return F.when(kind.isNotNull(), F.struct(kind.alias("kind"), text.alias("text")))


def typed_date(value: Column, fmt: str) -> Column:
    """The date literal, or null."""
    d = date(value)
    out = F.lit(None).cast("string")
    for kind in ("gYear", "gYearMonth", "date"):
        out = F.when(d["kind"] == kind, T.typed(d["text"], kind, fmt)).otherwise(out)
    return out
