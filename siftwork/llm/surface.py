"""Words of a text without regard to its surface."""

from __future__ import annotations

import html
import re
import unicodedata
from functools import lru_cache

# Inline tags vanish without a gap, all other markup is a gap.
INLINE = "a abbr acronym b big cite code del dfn em font i ins kbd mark q s samp small span strike strong sub sup tt u var wbr"
_TAG = re.compile(r"<(?:/?([A-Za-z][A-Za-z0-9]*)(?:\s[^<>]*|/)?|!--[\s\S]*?--|![A-Za-z][^<>]*|\?[^<>]*)>")
_INLINE = frozenset(INLINE.split())
_HYPHEN_END = re.compile(r"(?<=\w)[-‐‑¬][ \t]*(?:\r\n|[\n\r\x0b\x0c\x85\u2028\u2029])\s*(?=\w)")
_SOFT_END = re.compile(r"\xad(?=[ \t]*[\n\r])")
_WIDE = re.compile(r"[^\x00-\x7f]+")
_WORD = re.compile(r"[^\W_]+")
_HYPHENS = "-‐‑¬"
#: Letters without a shape, which are no format characters by category.
_FILLERS = frozenset("\u115f\u1160\u3164\uffa0")
# Letters with a stroke or hook that have no decomposition.
_STROKED = str.maketrans({"ø": "o", "ł": "l", "đ": "d", "ħ": "h", "ŧ": "t", "ı": "i", "æ": "ae", "œ": "oe"})


def _untag(m: re.Match) -> str:
    return "" if m[1] and m[1].lower() in _INLINE else " "


def plain(text: str) -> str:
    """The text without entities, markup, invisible characters, width, accents and letter case."""
    if "<" in text:
        text = _TAG.sub(_untag, text)
    if "&" in text:
        text = html.unescape(text)
        if "&" in text:
            text = html.unescape(text)
        if "<" in text:
            text = _TAG.sub(_untag, text)
    if text.isascii():
        return text.lower()
    if "\xad" in text:
        text = _SOFT_END.sub("-", text)
    return _WIDE.sub(_folded, text.lower())


def _folded(m: re.Match) -> str:
    return _fold(m[0])


@lru_cache(maxsize=50_000)
def _fold(run: str) -> str:
    """A run of characters beyond ASCII: decomposed, without marks and invisible characters, case folded."""
    wide = unicodedata.normalize("NFKD", run.casefold()).casefold()
    return "".join(c for c in wide if c not in _FILLERS and unicodedata.category(c) not in ("Mn", "Me", "Cf")).translate(_STROKED)


def words(text: str | None) -> list[list[str]]:
    """The runs of letters and digits: once with words joined that a hyphen divides at a line end and, if there are
    such, once with them apart. A null or empty text has none."""
    if not text:
        return [[]]
    p = plain(text)
    joined = _HYPHEN_END.sub("", p) if any(h in p for h in _HYPHENS) else p
    out = [_WORD.findall(joined)]
    if len(joined) != len(p):
        out.append(_WORD.findall(p))
    return out
