"""Plain forms of words: one spelling for look-alike letters, accents, case and invisible characters."""

from __future__ import annotations

import re
import unicodedata

# Cyrillic and Greek letters that look like Latin ones.
LOOKALIKES = str.maketrans(
    "абвгдеёзийкмнорстухцчшіјѕԁԛԝһӏ" "αβγεικνορτυχω" "ʏɡɑı",
    "abbrdee3uukmhopctyxu4wijsdqwhl" "abyeikvoptuxw" "ygai",
)
_LETTERS = {"ł": "l", "ø": "o", "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ð": "d"}
_OTHER = str.maketrans(_LETTERS)
_WORD = re.compile(r"[^\W_]+")
_INVISIBLE = re.compile("[­͏؜ᅟ᠎​-‏‪-‮⁠-⁤︀-️﻿]")
_LATIN = re.compile(r"[a-z]")


class _Letters(dict):
    """Plain letters of a character, found once."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        t = "" if _INVISIBLE.match(c) else unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", c).casefold())
        self[code] = found = "".join(x for x in t if not unicodedata.combining(x)).translate(_OTHER)
        return found


_PLAIN = _Letters()
_FOREIGN_WORD = re.compile(r"[^\W_]*[^\W_\x00-\x7f][^\W_]*")


def plain(text: str) -> str:
    """Lower case, compatibility form, without accents and invisible characters; look-alikes in words that also hold
    Latin letters become Latin (pure Cyrillic or Greek words stay what they are)."""
    if text.isascii():
        return text.lower()
    t = text.translate(_PLAIN)
    if t.isascii():
        return t

    def word(m: re.Match) -> str:
        w = m.group()
        return w.translate(LOOKALIKES) if _LATIN.search(w) else w

    return _FOREIGN_WORD.sub(word, t)


def words(text: str | None) -> list[str]:
    """The plain words of a text; punctuation, hyphens and white space separate."""
    return _WORD.findall(plain(text)) if text else []


def words_with_groups(text: str | None) -> tuple[list[str], list[int]]:
    """Plain words, and for each the number of the white-space separated word it stands in."""
    out: list[str] = []
    group: list[int] = []
    for g, chunk in enumerate((text or "").split()):
        for w in words(chunk):
            out.append(w)
            group.append(g)
    return out, group
