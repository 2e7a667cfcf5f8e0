"""PII surrogates: keyed, type-consistent replacements that keep entities distinct.

Every entity is read as a shape (what stays) and a number (what identifies it). A
keyed permutation of the numbers of that shape gives the surrogate's number, so
equal entities get equal surrogates wherever they stand, different entities get
different ones, and no entity keeps its own value. A name's permutation runs over
the names of the same gender and script; digits stay digits, letters stay letters,
and check digits and octet ranges stay valid.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import struct
import unicodedata
from bisect import bisect
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pieces import byte_slices, map_in_arrow
from .tables import stored

ROUNDS = 6

#: Given names by script and gender, family names by script.
GIVEN = {
    ("latin", "f"): "Anna Maria Emma Laura Julia Sophie Claire Elena Lucia Carmen Isabel Marie Camille Heidi Greta Ingrid Alice Sarah Emily Grace Hannah Olivia Martha Rose Fatima Aisha Yuki Priya Mei Zeynep Leila Ingeborg".split(),
    ("latin", "m"): "Peter Thomas Paul Martin Hans Karl Lukas Pierre Jean Louis Antoine Carlos Miguel Diego Pablo Javier John James Robert William David George Henry Daniel Akira Hiroshi Ahmed Mohammed Omar Raj Wei Mehmet".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана Юлия Екатерина".split(),
    ("cyrillic", "m"): "Иван Пётр Алексей Дмитрий Сергей Андрей Николай Михаил Павел Владимир".split(),
    ("greek", "f"): "Μαρία Ελένη Άννα Κατερίνα Σοφία Βασιλική Δήμητρα Ειρήνη".split(),
    ("greek", "m"): "Γιώργος Νίκος Δημήτρης Κώστας Γιάννης Παναγιώτης Χρήστος Μιχάλης".split(),
}
FAMILY = {
    "latin": "Smith Johnson Brown Taylor Wilson Clark Walker Miller Schmidt Weber Wagner Becker Hoffmann Koch Richter Klein Dubois Moreau Laurent Girard Garcia Lopez Martinez Sanchez Romero Torres".split(),
    "cyrillic": "Смирнов Кузнецов Попов Соколов Лебедев Козлов Новиков Морозов Волков Павлов".split(),
    "greek": "Παπαδόπουλος Γεωργίου Δημητρίου Νικολάου Ιωάννου Βασιλείου Οικονόμου Αντωνίου".split(),
}
#: Titles before a name, with the gender they tell, in four languages.
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Frau Monsieur Madame Mme Señor Señora Sr Sra Don Doña Господин Госпожа Κύριος Κυρία السيد السيدة श्री श्रीमती Պարոն Տիկին".split()

_FEISTEL_KEY_BYTES = 8


def mark_ranges() -> list[tuple[str, str]]:
    """Ranges of the marks that belong to the letter before them."""
    marks = [c for c in range(0x300, 0x11800) if unicodedata.category(chr(c)) in ("Mn", "Mc")]
    starts = [c for k, c in enumerate(marks) if not k or marks[k - 1] != c - 1]
    ends = [c for k, c in enumerate(marks) if k + 1 == len(marks) or marks[k + 1] != c + 1]
    return [(chr(a), chr(b)) for a, b in zip(starts, ends, strict=True)]


def keyed_number(key: bytes, *parts: object) -> int:
    """A number from the key and the parts, of 64 bits."""
    told = "\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass")
    return int.from_bytes(hmac.digest(key, told, hashlib.sha256)[:_FEISTEL_KEY_BYTES], "big")


def permuted(key: bytes, tweak: str, x: int, n: int, inverse: bool = False) -> int:
    """A keyed permutation of 0..n-1: a balanced Feistel network, walked into range."""
    half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        left, right = x >> half, x & mask
        for r in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
            if inverse:
                left, right = right ^ _round(key, tweak, r, left, half), left
            else:
                left, right = right, left ^ _round(key, tweak, r, right, half)
        x = left << half | right
        if x < n:
            return x


def _round(key: bytes, tweak: str, r: int, x: int, half: int) -> int:
    out, need = b"", (half + 7) // 8
    k = 0
    while len(out) < need:
        out += hmac.digest(key, f"{tweak}\x1f{r}\x1f{k}\x1f{x}".encode(), hashlib.sha256)
        k += 1
    return int.from_bytes(out[:need], "big") & ((1 << half) - 1)


def replaced_number(key: bytes, tweak: str, x: int, n: int, fits: Callable[[int], bool] = lambda _: True) -> int:
    """Where x goes: one to one on 0..n-1 (on those that fit, if x fits), never to x.

    Along the keyed order of all numbers each goes to the next one that fits. Where
    x is the only number that fits, it stays.
    """
    if n <= 1:
        return x
    at = permuted(key, tweak, x, n, inverse=True)
    while True:
        at = (at + 1) % n
        y = permuted(key, tweak, at, n)
        if fits(y) or y == x:
            return y


_ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def replaced_characters(key: bytes, tweak: str, text: str, free: Callable[[int], bool] = lambda _: True) -> str:
    """Text of the same shape: ASCII digits, small and capital letters at the places
    that are free change within their kind, all else stays."""
    kinds = [next((a for a in _ALPHABETS if c in a), None) if free(k) else None for k, c in enumerate(text)]
    x, n = 0, 1
    for c, a in zip(text, kinds, strict=True):
        if a:
            x, n = x * len(a) + a.index(c), n * len(a)
    # what stays names the order, so that different shapes have orders of their own
    shape = "".join(c if a is None else a[0] for c, a in zip(text, kinds, strict=True))
    y = replaced_number(key, f"{tweak}\x1f{shape}", x, n)
    out = []
    for c, a in zip(reversed(text), reversed(kinds), strict=True):
        if a:
            y, digit = divmod(y, len(a))
            c = a[digit]
        out.append(c)
    return "".join(reversed(out))


def luhn_digit(digits: str) -> str:
    """The check digit that follows `digits`."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _digits(text: str) -> str:
    return re.sub(r"\D", "", text)


def _in_place(text: str, digits: str) -> str:
    """The digits put where the text's digits stand."""
    left = iter(digits)
    return "".join(next(left) if "0" <= c <= "9" else c for c in text)


def _email(key: bytes, text: str) -> str:
    """Local part and host names change; the case pattern, marks and the top domain stay."""
    low = text.lower()
    end = low.rindex(".")
    at = low.index("@")
    new = replaced_characters(key, "email", low[:end], lambda k: k != at) + low[end:]
    return "".join(n.upper() if c.isupper() else n for c, n in zip(text, new, strict=True))


def _country_code(text: str) -> str:
    """The digits of a phone number's country code; without one: none.

    It ends at the first mark; in a run of digits it has one digit for 1 and 7, else two.
    """
    if not text.startswith("+"):
        return ""
    run = re.match(r"\d+", text[1:]).group()
    return run if len(run) <= 3 else run[0] if run[0] in "17" else run[:2]


def _phone(key: bytes, text: str) -> str:
    """The national number changes, the country code and the marks stay.

    With country code 1 and without any a number has the same surrogate digits; other
    codes have orders of their own, as their numbers are other people's.
    """
    code, digits = _country_code(text), _digits(text)
    tweak = "phone" if code in ("", "1") else f"phone+{code}"
    own = digits[len(code) :]
    # a zero before an area code is no part of the number
    new = replaced_characters(key, tweak, own, lambda k: k > 0 or own[0] != "0")
    return _in_place(text, code + new)


def _card(key: bytes, text: str) -> str:
    """Issuer's first digit and length stay; a valid check digit stays valid."""
    digits = _digits(text)
    good = luhn_digit(digits[:-1]) == digits[-1]
    if good:
        body = replaced_characters(key, "card", digits[:-1], lambda k: k > 0)
        return _in_place(text, body + luhn_digit(body))
    size = len(digits) - 1
    spelled = lambda x: f"{digits[0]}{x:0{size}d}"
    # among numbers without a valid check digit only, so none meets a card's
    new = replaced_number(
        key, f"number\x1f{spelled(0)}", int(digits[1:]), 10**size, lambda x: luhn_digit(spelled(x)[:-1]) != spelled(x)[-1]
    )
    return _in_place(text, spelled(new))


def _ordinary(number: int) -> bool:
    """Host addresses of the unicast range."""
    a, d = number >> 24, number & 255
    return 1 <= a <= 223 and a != 127 and 1 <= d <= 254


def _ipv4(key: bytes, text: str) -> str:
    a, b, c, d = map(int, text.split("."))
    x = a << 24 | b << 16 | c << 8 | d
    y = replaced_number(key, "ipv4", x, 1 << 32, _ordinary if _ordinary(x) else lambda n: not _ordinary(n))
    return ".".join(str(y >> s & 255) for s in (24, 16, 8, 0))


def _ipv6(key: bytes, text: str) -> str:
    """Groups of zeros stay, the others change together and keep their digits' number: all
    spellings of an address lead to like spellings of one other."""
    groups = [f"{g:x}" for g in struct.unpack(">8H", ipaddress.IPv6Address(text).packed)]
    # digits of a group stay as many, the first one other than 0
    radix = [1 if g == "0" else 15 * 16 ** (len(g) - 1) for g in groups]
    x, n = 0, 1
    for g, r in zip(groups, radix, strict=True):
        x, n = x * r + (int(g, 16) - 16 ** (len(g) - 1) if g != "0" else 0), n * r
    y = replaced_number(key, "ipv6" + "".join("0" if g == "0" else str(len(g)) for g in groups), x, n)
    new = []
    for g, r in zip(reversed(groups), reversed(radix), strict=True):
        y, at = divmod(y, r)
        new.append(g if g == "0" else f"{at + 16 ** (len(g) - 1):x}")
    new.reverse()
    # as it was written: the same groups are left out, short ones stay short
    head, gap, tail = text.partition("::")
    ahead = head.split(":") if head else []
    behind = tail.split(":") if tail else []
    upper = text.upper() == text and text.lower() != text
    show = lambda old, g: (g.upper() if upper else g).rjust(len(old), "0")
    one = [show(o, g) for o, g in zip(ahead, new, strict=False)]
    two = [show(o, g) for o, g in zip(behind, new[8 - len(behind) :], strict=True)] if behind else []
    return ":".join(one) + gap + ":".join(two)


def _iban_check(country: str, body: str) -> int:
    return 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97


def _iban(key: bytes, text: str) -> str:
    """Country and length stay; the two check digits are reckoned anew, and as far
    from the right ones as they were."""
    plain = re.sub(r"\s", "", text).upper()
    country, body = plain[:2], replaced_characters(key, f"iban{plain[:2]}", plain[4:])
    wrong = int(plain[2:4]) - _iban_check(country, plain[4:])
    new = country + f"{(_iban_check(country, body) + wrong) % 100:02d}" + body
    left = iter(new)
    return "".join(c if c.isspace() else next(left).lower() if c.islower() else next(left) for c in text)


@lru_cache(maxsize=1)
def _name_tables() -> tuple[dict[str, tuple[str, str, int]], dict[str, tuple[str, int]]]:
    given = {n: (s, g, k) for (s, g), names in GIVEN.items() for k, n in enumerate(names)}
    family = {n: (s, k) for s, names in FAMILY.items() for k, n in enumerate(names)}
    return given, family


#: Vowels of the scripts that have them, and endings that tell a gender.
_VOWELS = frozenset("aeiouyàáâãäåæèéêëìíîïòóôõöøùúûüýÿœаеёиоуыэюяіїєαεηιουωάέήίόύώ")
_FEMALE, _MALE = frozenset("aаяαηάή"), frozenset("oойοςό")
#: What is put to a name whose own ending tells another gender than its title.
_ENDS = {"latin": "ao", "cyrillic": "ао", "greek": "αο"}


@lru_cache(maxsize=None)
def _alphabet(letter: str) -> str:
    """The letters that may stand for `letter`, of its script's block and of its kind.

    In blocks of vowels and consonants those of one kind; in others all letters of the same
    case, or without case.
    """
    first = ord(letter) & ~0x7F
    # plain letters of Cyrillic and Greek lie in the middle of their block
    plain = next((r for r in (range(0x430, 0x450), range(0x450, 0x460), range(0x3B1, 0x3CA)) if ord(letter) in r), range(first, first + 128))
    block = map(chr, plain)
    script = unicodedata.name(letter, "").split(" ")[0]
    block = [c for c in block if c.isalpha() and c.islower() == letter.islower() and unicodedata.name(c, "").split(" ")[0] == script]
    block = [c for c in block if c.islower() == (c != c.upper()) and len(c.upper()) == 1 and c.upper().lower() == c]
    if letter in _VOWELS or any(c in _VOWELS for c in block):
        block = [c for c in block if (c in _VOWELS) == (letter in _VOWELS)]
    return "".join(block) if letter in block else letter


def _spelled(kinds: list[str], x: int) -> str:
    out = []
    for a in reversed(kinds):
        x, at = divmod(x, len(a))
        out.append(a[at])
    return "".join(reversed(out))


def _unlisted(key: bytes, word: str, gender: str = "") -> str:
    """A name in no list: as many letters of the same script and kinds, in the same case.

    A keyed permutation of the words of that shape moves it, so different words have
    different surrogates. A last vowel that tells a gender keeps telling it; where a title
    tells another one, its vowel is put to the end.
    """
    low = word.lower()
    if len(low) != len(word):
        low = word
    kinds = [_alphabet(c) for c in low]
    end = next((e for e in (_FEMALE, _MALE) if len(low) > 1 and low[-1] in e), None)
    if end is not None:
        kinds[-1] = "".join(c for c in kinds[-1] if c in end) or low[-1]
    elif len(low) > 1:
        kinds[-1] = "".join(c for c in kinds[-1] if c not in _FEMALE | _MALE)
    if all(len(a) == 1 for a in kinds):
        # nothing of its shape but itself: signs of the script stand for it
        kinds = [_alphabet(c) for c in low]
    x, n = 0, 1
    for c, a in zip(low, kinds, strict=True):
        x, n = x * len(a) + a.index(c), n * len(a)
    given, family = _name_tables()
    # an unlisted name must not become a listed one
    free = lambda y: (w := _spelled(kinds, y).capitalize()) not in given and w not in family
    out = _spelled(kinds, replaced_number(key, "name\x1f" + "\x1f".join(kinds), x, n, free))
    told = {"f": _FEMALE, "m": _MALE}.get(gender)
    if told is not None and end is not None and end is not told:
        ends = next((_ENDS[s] for s in ("cyrillic", "greek") if any(c in _ENDS[s] for c in low[-1])), _ENDS["latin"])
        out += ends[gender == "m"]
    return "".join(n.upper() if c.isupper() else n for c, n in zip(word, out, strict=False)) + out[len(word) :]


#: Titles that tell a gender.
_OF_WOMEN = frozenset("mrs ms miss frau madame mme señora sra doña госпожа κυρία السيدة श्रीमती տիկին".split())
_OF_MEN = frozenset("mr herr monsieur señor sr don господин κύριος السيد श्री պարոն".split())


def _name_parts(text: str) -> tuple[str, str]:
    """The titles with what follows them, and the name itself."""
    title = _TITLE.match(text)
    return (title.group(), text[title.end() :]) if title else ("", text)


def _gender(text: str) -> str:
    """What a name's titles, else its first listed given name, tell: f, m or nothing."""
    head, own = _name_parts(text)
    for word in re.findall(_WORD, head.lower()):
        if word in _OF_WOMEN or word in _OF_MEN:
            return "f" if word in _OF_WOMEN else "m"
    first = re.match(_WORD, own)
    listed = _name_tables()[0].get(first.group().capitalize()) if first else None
    return listed[1] if listed else ""


def _name(key: bytes, text: str, gender: str | None = None) -> str:
    """Listed names change within gender and script, others within their shape; particles stay.

    `gender` is what the whole name's titles tell where `text` is a later mention of its words.
    """
    given, family = _name_tables()
    gender = _gender(text) if gender is None else gender

    def one(word: str) -> str:
        plain = word.capitalize()
        if plain in given:
            script, own, k = given[plain]
            names = GIVEN[script, own]
            new = names[replaced_number(key, f"given\x1f{script}\x1f{own}", k, len(names))]
        elif plain in family:
            script, k = family[plain]
            names = FAMILY[script]
            new = names[replaced_number(key, f"family\x1f{script}", k, len(names))]
        elif word in PARTICLES:
            return word
        else:
            return _unlisted(key, word, gender)
        return new.upper() if word.isupper() and len(word) > 1 else new.lower() if word.islower() else new

    head, own = _name_parts(text)
    return head + re.sub(_WORD, lambda m: one(m.group()), own)


#: Small words inside names; words that announce a name; words with which one tells
#: one's own name, however it is written; words that end such a name; words for what people do.
PARTICLES = frozenset("de del della der den di da dos das du la le van von zu bin ibn al el y".split())
AMBIGUOUS = frozenset("Rose Grace".split())
OWN_CUES = "my name is|mi nombre es|me llamo|ich heiße|mein name ist|je m'appelle|меня зовут|με λένε|我叫|私の名前は|اسمي|मेरा नाम".split("|")
CUES = [*OWN_CUES, *"name is|name:|dear|sehr geehrte|sehr geehrter|signed:?|contact:|attn:?".split("|")]
ENDING = frozenset("and but or so from in at of with not who i am the a here und aus ich bin y soy de et je suis и я και".split())
PEOPLE = "met meets said says told asked wrote replied traf sagte sagt schrieb dijo dice rencontra déclara сказал сказала".split()
#: Marks that belong to the letter before them, in every script.
_MARKS = "".join(f"{a}-{b}" for a, b in mark_ranges())
_WORD = rf"[^\W\d_](?:[^\W\d_]|[{_MARKS}])*"
_TITLES = rf"(?:(?:{'|'.join(sorted(TITLES, key=len, reverse=True))})(?![\w{_MARKS}])\.?[ \u00a0])+"
_TITLE = re.compile(rf"(?:(?:{'|'.join(sorted(TITLES, key=len, reverse=True))})(?![\w{_MARKS}])\.?\s+)+", re.IGNORECASE)
_GIVEN = "|".join(sorted({n for names in GIVEN.values() for n in names}, key=len, reverse=True))
#: Where a name may begin: after titles or a cue, at a listed given name, beside what people do.
_BEGIN = re.compile(
    rf"(?<![\w{_MARKS}])(?:(?P<title>{_TITLES}(?=\w))"
    rf"|(?P<own>(?:{'|'.join(sorted(OWN_CUES, key=len, reverse=True))})[ \u00a0]?(?=\w))"
    rf"|(?P<cue>(?:{'|'.join(sorted(CUES, key=len, reverse=True))})[ \u00a0])"
    rf"|(?P<given>(?:{_GIVEN}))\b"
    rf"|(?P<after>(?:{'|'.join(PEOPLE)})[ \u00a0](?=\w)))",
    re.IGNORECASE,
)
#: The next word of a name: after a blank, a hyphen or an apostrophe, or an initial's point.
_NEXT = re.compile(rf"(?:[ \u00a0]|-|['’]|(?<=\b\w)\.[ \u00a0]?)({_WORD})")
_JOINED = re.compile(rf"[ \u00a0](?:and|und|y|et|и|και|&)[ \u00a0](?={_WORD})")
#: A run of two capitalised words or more, right before what people do.
_BEFORE = re.compile(rf"(?:{_WORD}(?:[ \u00a0]|-))+(?:{'|'.join(PEOPLE)})(?!\w)")
#: Words of a name that is written without capitals, as it has no end of its own: given and family name.
_UNCASED_WORDS = 2


def _name_end(text: str, at: int, cased: bool = True) -> tuple[int, int]:
    """Where the words of a name end that begin at `at`, and how many they are.

    They are capitalised, however many; particles count only between two of them. After a
    title or a cue (not `cased`) words of scripts without case, or small ones after one's own
    cue, count as well, up to _UNCASED_WORDS.
    """
    m = _FIRST.match(text, at)
    end, words, small = at, 0, 0
    while m is not None:
        word = m.group(m.lastindex or 0)
        if word[0].isupper():
            end, words = m.end(), words + 1
        elif not cased and small < _UNCASED_WORDS and word.lower() not in ENDING and word not in PARTICLES:
            end, words, small = m.end(), words + 1, small + 1
        elif not (words and word in PARTICLES):
            break
        m = _NEXT.match(text, m.end())
    return end, words


_FIRST = re.compile(_WORD)


def _names(text: str) -> Iterator[tuple[str, int, int, str, str, str]]:
    """(kind, start, end, text, whole, gender): names after titles and cues, from listed given names
    on, beside words for what people do, and then later mentions of their words, with the
    name that last had the word before.

    Without a title two words are needed, as a listed name may be another word; after
    one that often is, the second must be listed too.
    """
    families = _name_tables()[1]
    at, whole = 0, []
    while (m := _BEGIN.search(text, at)) is not None:
        at = m.end()
        if not text[m.start()].isupper() and not (m["cue"] or m["own"] or m["after"]) and text[m.start()].islower():
            continue
        first = m.start() if m["given"] else m.end()
        uncased = bool(m["own"]) or bool(m["title"] and not text[first].isupper() and not text[first].islower())
        end, words = _name_end(text, first, cased=not uncased)
        if m["title"] and m["title"].rstrip(" .\u00a0").isupper() and m["title"].rstrip(" .\u00a0").lower() != m["title"].rstrip(" .\u00a0") and not text[first:end].isupper() and len(m["title"]) > 4:
            words = 0
        if m["given"] and m["given"].capitalize() in AMBIGUOUS and text[first:end].split()[-1].capitalize() not in families:
            words = 0
        while words >= (1 if m["title"] or m["own"] else 2):
            start = m.start() if m["title"] and first == m.end() else first
            whole.append((start, end, text[start:end], text[first:end]))
            at = end
            # what is joined to a name by "and" is one too, if it has two words
            joined = _JOINED.match(text, end)
            if joined is None or _BEGIN.match(text, joined.end()):
                break
            first = joined.end()
            end, words = _name_end(text, first)
            words = words if words > 1 else 0
    for m in _BEFORE.finditer(text):
        words = list(_FIRST.finditer(text, m.start(), m.end()))[:-1]
        k = len(words)
        while k and words[k - 1].group()[0].isupper():
            k -= 1
        if len(words) - k > 1:
            first, end = words[k].start(), words[-1].end()
            if not any(a < end and first < b for a, b, *_ in whole):
                whole.append((first, end, text[first:end], text[first:end]))
    if not whole:
        return
    whole.sort()
    known: dict[str, list[tuple[int, str, str]]] = {}
    for start, end, told, own in whole:
        gender = _gender(told)
        yield "name", start, end, told, told, gender
        for w in re.findall(_WORD, own):
            if len(w) > 2 and w not in PARTICLES:
                known.setdefault(w, []).append((start, told, gender))
    if known:
        every = "|".join(sorted(map(re.escape, known), key=len, reverse=True))
        for m in re.finditer(rf"(?<![\w{_MARKS}])(?:{every})(?![\w{_MARKS}])", text):
            named = known[m.group()]
            _, told, gender = next((x for x in reversed(named) if x[0] < m.start()), named[0])
            yield "mention", m.start(), m.end(), m.group(), told, gender


#: Kinds in order of precedence, with the pattern that finds each.
KINDS: dict[str, tuple[str, Callable[[bytes, str], str]]] = {
    "email": (r"(?<![\w.+-])[A-Za-z0-9](?:[\w.+-]{0,62}[\w+-])?@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}(?![\w-])", _email),
    "iban": (r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?\b|\b[a-z]{2}\d{2}(?: ?[a-z0-9]{4}){2,7}(?: ?[a-z0-9]{1,4})?\b", _iban),
    "card": (r"(?<![\d.+-])(?:\d{4}[ .-]\d{4}[ .-]\d{4}[ .-]\d{4}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?![\d-]|\.\d)", _card),
    "ipv4": (r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)", _ipv4),
    "ipv6": (r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])", _ipv6),
    "ssn": (r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])|(?<![\d.,-])(?<!\d )\d{3} \d{2} \d{4}(?![\d-]| \d|[.,]\d)", lambda key, t: replaced_characters(key, "ssn", t)),
    "phone": (r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){3,5}(?!\d)|(?<![\w+/.-])0\d{2,4}(?: |/| / |-)\d{5,8}(?![\w/-])|(?<![\w+/.-])0\d(?:[ .]\d{2}){4}(?![\w/.-])"
              r"|(?:(?<=(?i:phone|mobil) )|(?<=(?i:call|cell) )|(?<=(?i:tel|fon) )|(?<=(?i:tel|fon)[.:] ))\d{7,12}(?![\d-]|\.\d)", _phone),
    "name": ("", _name),
    "mention": ("", _name),
}
#: Shortened IPv6 addresses; `::1` and slices like `1::2` have too few digits for one.
_SHORT_IPV6 = re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?(?![\w:]|\.\d)")
_LEAST_HEXES = 5
_IPV6 = re.compile(KINDS["ipv6"][0])
_COLONS = re.compile(r":[0-9A-Fa-f]{1,4}:")
_EMAIL = re.compile(KINDS["email"][0])
_NUMBERED = [k for k in KINDS if k not in ("name", "mention", "email")]
#: Numbers begin at a digit, a sign, a bracket or the letters of a country or group.
_NUMBER = re.compile(r"(?=[\da-z+(A-Z])(?:" + "|".join(f"(?P<{k}>{KINDS[k][0]})" for k in _NUMBERED) + ")")
_DIGITS = re.compile(r"\d\D{0,2}\d\D{0,2}\d")
_WORDS = re.compile(r"\w+")
#: Words without one of which a text has no name that is looked for: titles and given
#: names as written with a capital, and the longest word of each cue.
_NAME_WORDS = frozenset(
    form
    for w in (*TITLES, *PEOPLE, *(n for names in GIVEN.values() for n in names), *(max(re.findall(_WORD, c), key=len) for c in CUES))
    for form in (w, w.capitalize(), w.upper(), *re.findall(r"\w+", w))
)
#: Cues of scripts without blanks between words are looked for as they are.
_UNSPACED_CUES = re.compile("|".join(c for c in OWN_CUES if not re.search(r"[A-Za-zА-я ]", c)))
#: Characters around a run of digits that a number may reach to.
_REACH = 48


def _numbers(text: str) -> Iterator[tuple[str, int, int, str]]:
    """Numbers, looked for around runs of digits only."""
    at = 0
    while (near := _DIGITS.search(text, at)) is not None:
        low = max(at, near.start() - _REACH)
        m = _NUMBER.search(text, low)
        if m is None:
            return
        at = m.end()
        # codes in small letters are other things too, unless their check digits are right
        if m.lastgroup == "iban" and m.group()[0].islower():
            plain = re.sub(r"\s", "", m.group()).upper()
            if int(plain[2:4]) != _iban_check(plain[:2], plain[4:]):
                at = m.start() + 2
                continue
        yield m.lastgroup, m.start(), m.end(), m.group()


def people(text: str | None) -> list[tuple[str, int, int, str, str, str]]:
    """(kind, start, end, text, whole, gender) of each entity, from left to right; of null: none.

    Where two overlap, the first of KINDS stays, then the one that begins first. `whole` is
    what identifies the entity: of a later mention of a name's words, that name.
    """
    if not text:
        return []
    found = []
    if "@" in text:
        found += [("email", m.start(), m.end(), m.group()) for m in _EMAIL.finditer(text)]
    found += _numbers(text)
    if _COLONS.search(text):
        found += [("ipv6", m.start(), m.end(), m.group()) for m in _IPV6.finditer(text)]
    if "::" in text:
        found += [
            ("ipv6", m.start(), m.end(), m.group())
            for m in _SHORT_IPV6.finditer(text)
            if len(m.group().replace(":", "")) >= _LEAST_HEXES and sum(map(bool, m.group().split(":"))) <= 7
        ]
    found = [(*x, x[3], "") for x in found]
    if not _NAME_WORDS.isdisjoint(_WORDS.findall(text)) or _UNSPACED_CUES.search(text):
        found += _names(text)
    order = {k: n for n, k in enumerate(KINDS)}
    starts: list[int] = []
    taken: list[tuple[str, int, int, str, str, str]] = []
    for x in sorted(found, key=lambda x: (order[x[0]], x[1])):
        at = bisect(starts, x[1])
        if (at and taken[at - 1][2] > x[1]) or (at < len(taken) and taken[at][1] < x[2]):
            continue
        starts.insert(at, x[1])
        taken.insert(at, x)
    return taken


def entities(text: str | None) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, text) of each entity, from left to right; of null: none."""
    return [x[:4] for x in people(text)]


def surrogate(key: bytes, kind: str, text: str) -> str:
    """The replacement of one entity."""
    return KINDS[kind][1](key, text)


def canonical(kind: str, text: str) -> str:
    """What mentions of one entity have in common."""
    if kind == "email":
        return text.lower()
    if kind == "phone":
        code = _country_code(text)
        return ("" if code == "1" else code) + "/" + _digits(text)[len(code) :]
    if kind in ("card", "ssn"):
        return _digits(text)
    if kind == "iban":
        return re.sub(r"\s", "", text).upper()
    if kind in ("name", "mention"):
        return " ".join(re.findall(_WORD, _name_parts(text)[1])).lower()
    if kind == "ipv6":
        return ipaddress.IPv6Address(text).packed.hex()
    return text.lower()


_TITLES_SQL = rf"^(?iU)(?:(?:{'|'.join(sorted(TITLES, key=len, reverse=True))})\b\.?\s+)+"
_FOUND = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("surrogate", pa.string()), ("entity", pa.int64())])
)


def replace_entities(df: DataFrame, key: bytes, *, text_col: str = "text", keep: list[str], out_col: str = "text", list_col: str = "entities") -> DataFrame:
    """The columns `keep`, the text with surrogates, and the list of replacements.

    `entities` has, from left to right, the kind, the place in the new text (code
    points from 0), the surrogate, and a keyed number that is equal for mentions of
    one entity. Null texts stay null with no entities; empty and clean texts stay as
    they are; long texts are searched whole; repeated rows are replaced alike; an
    empty table stays empty.
    """
    kept = [df.schema[c] for c in keep]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, n, batch in ((*at_n, b) for b in batches for at_n in byte_slices(b.column(len(keep)))):
            batch = batch.slice(at, n)
            texts, found = [], []
            for text in batch.column(len(keep)).to_pylist():
                new, at, moved, own = [], 0, 0, []
                for kind, start, end, mention, whole, gender in people(text):
                    other = _name(key, mention, gender) if kind == "mention" else surrogate(key, kind, mention)
                    number = keyed_number(key, "name" if kind == "mention" else kind, canonical(kind, whole)) >> 1
                    own.append({"kind": kind, "start": start + moved, "surrogate": other, "entity": number})
                    new += [text[at:start], other]
                    moved += len(other) - len(mention)
                    at = end
                texts.append(None if text is None else "".join([*new, text[at:]]))
                found.append(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in range(len(keep))] + [pa.array(texts, pa.string()), pa.array(found, _FOUND)],
                names=[f.name for f in kept] + [out_col, list_col],
            )

    return map_in_arrow(
        df.select(*keep, text_col),
        run,
        f"{schema}`{out_col}` string, `{list_col}` array<struct<kind: string, start: long, surrogate: string, entity: long>>",
    )


def collisions(replaced: DataFrame) -> DataFrame:
    """(kind, surrogate, entities): surrogates that stand for more than one entity.

    A word of a name alone may be of several people, so only whole names count. Mentions are counted once for each entity and task before they are moved.
    """
    own = F.when(F.col("e.kind") == "name", F.regexp_replace("e.surrogate", _TITLES_SQL, "")).otherwise(F.col("e.surrogate"))
    each = replaced.select(F.explode(F.filter("entities", lambda e: e["kind"] != "mention")).alias("e")).select("e.kind", F.lower(own).alias("surrogate"), "e.entity")
    return (
        each.distinct().groupBy("kind", "surrogate").agg(F.count("*").alias("entities")).filter("entities > 1")
    )


def replace_checked(df: DataFrame, key: bytes, *, list_col: str = "entities", **options) -> DataFrame:
    """`replace_entities`, written and checked for collisions before it is used.

    The result is the written table. Surrogates of different entities that are equal
    although the permutations should leave none lead to another try with a key of its
    own; a third failure raises.
    """
    for turn in range(3):
        own = key if not turn else hmac.digest(key, f"turn {turn}".encode(), hashlib.sha256)
        out = stored(replace_entities(df, own, list_col=list_col, **options), "surrogates")
        met = collisions(out.select(F.col(list_col).alias("entities"))).limit(3).collect()
        if not met:
            return out
    raise RuntimeError(f"different entities share surrogates: {met}")


def replace_in_documents(df: DataFrame, key: bytes) -> DataFrame:
    """All columns of `df`, with surrogates in `text` and n_chars (if there) to match."""
    columns = df.columns
    out = replace_checked(df, key, keep=[c for c in columns if c != "text"], list_col="_replaced_entities")
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(df.schema["n_chars"].dataType), F.col("n_chars")))
    return out.select(*columns)
