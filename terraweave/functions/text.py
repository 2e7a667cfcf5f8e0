"""Literals, IRIs and blank nodes as column expressions, one format at a time.

Formats: "nt" expands prefixes, "ttl" and "qlever" keep them; IRI references escape
what they must not hold as \\u00xx in "nt" and "ttl", as %xx in "qlever".
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocabulary as V

FORMATS = ("nt", "ttl", "qlever")
#: Stands for "%" until a local name's own "%" are escaped; no valid name holds it.
_HOLD = ""


def _as_column(x: Column | str) -> Column:
    return x if isinstance(x, Column) else F.col(x)


# -- literals ---------------------------------------------------------------


def string_literal(text: Column | str) -> Column:
    """Double-quoted; escapes backslash, quote, line feed, carriage return. Tabs stay."""
    out = _as_column(text)
    for plain, code in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r")):
        out = F.replace(out, F.lit(plain), F.lit(code))
    return F.concat(F.lit('"'), out, F.lit('"'))


def single_quoted_literal(text: Column | str) -> Column:
    """As string_literal, with single quotes."""
    out = _as_column(text)
    for plain, code in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r")):
        out = F.replace(out, F.lit(plain), F.lit(code))
    return F.concat(F.lit("'"), out, F.lit("'"))


def name(term: tuple[str, str], fmt: str) -> str:
    """A fixed term, as the format writes it."""
    prefix, local = term
    return f"<{V.PREFIXES[prefix]}{local}>" if fmt == "nt" else f"{prefix}:{local}"


def term(value: tuple[str, str], fmt: str) -> Column:
    return F.lit(name(value, fmt))


def typed(text: Column, datatype: str, fmt: str) -> Column:
    """A literal whose text needs no escapes, of an XSD or other datatype."""
    kind = name(("geo", "wktLiteral") if datatype == "wktLiteral" else ("xsd", datatype), fmt)
    return F.concat(F.lit('"'), text, F.lit(f'"^^{kind}'))


def integer(number: Column | str, fmt: str) -> Column:
    return typed(_as_column(number).cast("string"), "integer", fmt)


def boolean(flag: Column, fmt: str) -> Column:
    return F.when(flag, F.lit(f'"true"^^{name(("xsd", "boolean"), fmt)}')).otherwise(
        F.lit(f'"false"^^{name(("xsd", "boolean"), fmt)}')
    )


def date_time(seconds: Column | str, fmt: str) -> Column:
    """Epoch seconds as UTC date and time, without zone and fraction."""
    s = _as_column(seconds).cast("long")
    day = F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.floor(s / 86400).cast("int")), "yyyy-MM-dd")
    rest = F.pmod(s, F.lit(86400))
    clock = F.concat_ws(
        ":", *(F.lpad(x.cast("int").cast("string"), 2, "0") for x in (F.floor(rest / 3600), F.pmod(F.floor(rest / 60), F.lit(60)), F.pmod(rest, F.lit(60))))
    )
    return typed(F.concat(day, F.lit("T"), clock), "dateTime", fmt)


def trimmed(number: Column, digits: int) -> Column:
    """Fixed point with `digits` decimals, then without trailing zeros and point."""
    text = number.cast(f"decimal(30,{digits})").cast("string")
    # a number with decimals has a point, where the zeros end
    text = F.rtrim(F.rtrim(text, F.lit("0")), F.lit(".")) if digits else text
    return F.when(text == "-0", "0").otherwise(text)


def lang_tag(tag: Column | str) -> Column:
    """`@tag`; null where the tag is not one: letters, digits only behind a hyphen."""
    t = _as_column(tag)
    return F.when(t.rlike(r"^([A-Za-z][A-Za-z]*(-[A-Za-z0-9]*)*)?$"), F.concat(F.lit("@"), t))


# -- names ------------------------------------------------------------------


def _code_class(ranges) -> str:
    return "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges)


_LATER = _code_class(V.LOCAL_RANGES + V.LOCAL_NOT_FIRST)
_FIRST = _code_class(V.LOCAL_RANGES)
#: ASCII that is neither allowed nor escaped by a backslash.
_PERCENT = [c for c in range(128) if not (chr(c).isalnum() or chr(c) in ":_" or chr(c) in V.LOCAL_ESCAPED)]


def key_class(key: Column | str) -> Column:
    """0: a local name as it is; 1: one after encoding; 2: none at all."""
    k = _as_column(key)
    plain = k.rlike(r"^([A-Za-z0-9_:]([A-Za-z0-9_:.\-]*[A-Za-z0-9_:\-])?)?$")
    possible = k.rlike(rf"^([\x00-\x7F{_FIRST}][\x00-\x7F{_LATER}]*)?$")
    return F.when(plain, 0).when(possible, 1).otherwise(2)


def pn_local(text: Column | str) -> Column:
    """A local name. Of class 2 the characters that have no encoding stay as they are;
    callers write such keys as literals."""
    c = _as_column(text)
    out = c
    for code in _PERCENT:
        out = F.replace(out, F.lit(chr(code)), F.lit(f"{_HOLD}{code:02x}"))
    out = F.regexp_replace(out, r"[!#$%&'()*+,/;=?@~]", r"\\$0")
    out = F.regexp_replace(out, r"^[.\-]|\.$", r"\\$0")
    out = F.replace(out, F.lit(_HOLD), F.lit("%"))
    return F.when(c.rlike("^[A-Za-z0-9_:]*$"), c).otherwise(out)


def iri_ref(text: Column | str, fmt: str) -> Column:
    """The text of an IRI reference, without its brackets."""
    c = _as_column(text)
    out = c
    if fmt == "qlever":
        # nothing that the loop writes is escaped by it again
        for code in [*range(33), *map(ord, V.IRI_RESERVED)]:
            out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02x}"))
    else:
        out = F.replace(out, F.lit("\\"), F.lit("\\u005c"))
        for code in [*range(33), *(ord(x) for x in V.IRI_RESERVED if x != "\\")]:
            out = F.replace(out, F.lit(chr(code)), F.lit(f"\\u{code:04x}"))
    return F.when(c.rlike(r"""[\x00-\x20<>{}"|^`\\]"""), out).otherwise(c)


def iri(prefix: str, local: Column | str, fmt: str) -> Column:
    """The IRI of a known prefix and a local part that may need encoding."""
    if fmt == "nt":
        return F.concat(F.lit(f"<{V.PREFIXES[prefix]}"), iri_ref(local, fmt), F.lit(">"))
    return F.concat(F.lit(f"{prefix}:"), pn_local(local))


def full_iri(base: Column | str, local: Column | str, fmt: str) -> Column:
    """An IRI outside the prefix table."""
    return F.concat(F.lit("<"), iri_ref(base, fmt), iri_ref(local, fmt), F.lit(">"))


def id_iri(prefix: str, number: Column | str, fmt: str) -> Column:
    """The IRI of a number; only a minus sign would need an escape."""
    n = _as_column(number).cast("string")
    if fmt == "nt":
        return F.concat(F.lit(f"<{V.PREFIXES[prefix]}"), n, F.lit(">"))
    return F.concat(F.lit(f"{prefix}:"), F.when(F.startswith(n, F.lit("-")), F.concat(F.lit("\\"), n)).otherwise(n))


def blank(*parts: Column | str) -> Column:
    """A blank node named by what it stands for, so that a retry names it alike."""
    return F.concat(F.lit("_:"), F.concat_ws("_", *(_as_column(p).cast("string") for p in parts)))


def line(s: str = "s", p: str = "p", o: str = "o") -> Column:
    """One row of output."""
    return F.concat_ws(" ", s, p, o, F.lit("."))


# -- single values (for headers, options and checks) --------------------------


def uchar(code: int) -> str:
    """The numeric escape of a code point."""
    return f"\\u{code:04x}" if code <= 0xFFFF else f"\\U{code:08x}"


def percent(code: int) -> str:
    """The bytes of a code point (not of its UTF-8), big-endian, each as %xx."""
    size = max(1, (code.bit_length() + 7) // 8)
    return "".join(f"%{b:02x}" for b in code.to_bytes(size, "big"))


def valid_prefix_name(text: str) -> str:
    """The prefix name itself; an error where it is none."""
    ok = lambda c, ranges: any(a <= ord(c) <= b for a, b in ranges)
    for at, c in enumerate(text):
        if c.isascii():
            good = c.isalpha() or (at and (c.isdigit() or c in "_-" or (c == "." and at < len(text) - 1)))
        else:
            good = ok(c, V.LOCAL_RANGES) or (at and ok(c, V.LOCAL_NOT_FIRST))
        if not good:
            raise ValueError(f"no prefix name: {text!r}")
    return text


def utf8_length(value: Column) -> Column:
    """Code points of a text; of bytes that are no UTF-8: null."""
    return F.when(F.is_valid_utf8(value), F.length(value))


def first_codepoint(value: Column) -> Column:
    """The number of a text's first code point; of the empty text: null."""
    return F.when(F.length(value) > 0, F.ascii(value))
