"""Cutting texts where subword tokenizers cannot merge across, in bounded batches."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

#: A space with a non-space character on both sides.
_LONE_SPACE = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")
#: White space other than blanks and line feeds, and the pieces' own space mark.
_RARE = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\u2581]")


def _only_lone_spaces(text: str) -> bool:
    """Whether every blank has characters other than white space on both sides."""
    return not (
        text[0] == " " or text[-1] == " " or "  " in text or " \n" in text or "\n " in text
    ) and _RARE.search(text) is None


def segments(text: str) -> list[str]:
    """The text's words by lone spaces, without those spaces.

    Every cut is a lone space, so `" ".join(segments(t)) == t`. White space that
    touches other white space stays inside a segment.
    """
    if not text:
        return []
    if _only_lone_spaces(text):
        return text.split(" ")
    return _LONE_SPACE.split(text)


#: A sentence mark between a letter or digit and a blank: no run of letters, digits
#: or marks goes on across its left side, so texts may be cut there as well.
_MARK = re.compile("([.,;:!?])(?<=[A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff].) ")
#: Begins the key of what follows a cut without a blank.
_JOINED_ON = "\x01"


def keys_of(text: str) -> list:
    """The text in pieces that are encoded on their own as in the whole.

    A key stands for a blank and itself, after _JOINED_ON for the rest of it alone;
    the text's first piece, which has no blank, is in a tuple.
    """
    if _JOINED_ON not in text:
        text = _MARK.sub(" \x01\\1 ", text)
        keys: list = segments(text)
    else:
        keys = [" " + s if k else s for k, s in enumerate(segments(text))]
        keys = [_JOINED_ON + s for s in keys]
    if keys and keys[0][:1] != _JOINED_ON:
        keys[0] = (keys[0],)
    return keys


def spelled(key) -> str:
    """The piece that a key stands for."""
    if isinstance(key, tuple):
        return key[0]
    return key[1:] if key[:1] == _JOINED_ON else " " + key


def parts(text: str, most: int) -> Iterator[str]:
    """The text in parts of about `most` characters; all but the first begin with a
    lone blank. A part is longer where no lone blank stands before that point."""
    at = 0
    while len(text) - at > most:
        found = _LONE_SPACE.search(text, at + most)
        if found is None:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


def by_bytes(items: Iterable[tuple[int, str]], most: int) -> Iterator[tuple[list[int], list[str]]]:
    """Batches of (key, text) whose texts come to about `most` bytes of UTF-8 each."""
    keys: list[int] = []
    texts: list[str] = []
    size = 0
    for key, text in items:
        keys.append(key)
        texts.append(text)
        size += len(text) if text.isascii() else len(text.encode("utf-8", "surrogatepass"))
        if size >= most:
            yield keys, texts
            keys, texts, size = [], [], 0
    if keys:
        yield keys, texts
