"""Text column functions."""

from __future__ import annotations

import functools
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

NON_ASCII = r"[^\x00-\x7F]"


def swap_case(x: Column) -> Column:
    """Upper case to lower and back, letter by letter."""
    letter = F.transform(
        F.split(x, ""), lambda c: F.when(F.upper(c) == c, F.lower(c)).otherwise(F.upper(c))
    )
    return F.array_join(letter, "")


def capitalised(x: Column) -> Column:
    """First letter upper case, the rest lower."""
    return F.concat(F.upper(F.substring(x, 1, 1)), F.lower(x.substr(F.lit(2), F.length(x))))


def words(x: Column) -> Column:
    """Whitespace tokens of the whole text."""
    return F.filter(F.split(x, r"\s+"), lambda w: F.length(w) > 0)


# Full-width punctuation and its ASCII form. The opening lenticular
# bracket (U+3010) is kept because it marks the sender's signature.
FULL_WIDTH = "，。！？；：（）［］｛｝“”‘’、《》－～"
HALF_WIDTH = ",.!?;:()[]{}\"\"'',<>-~"


def message_text(x: Column) -> Column:
    """Spaces removed, ends stripped, full-width punctuation folded to ASCII."""
    bare = F.regexp_replace(x, " ", "")
    stripped = F.regexp_replace(bare, r"^\s+|\s+$", "")
    return F.translate(stripped, FULL_WIDTH, HALF_WIDTH)


# Typographic characters that compatibility folding alone would drop.
TYPOGRAPHIC = {
    "‘": "'", "’": "'", "‚": ",", "“": '"', "”": '"', "„": '"',
    "–": "-", "—": "-", "…": "...", "•": "*", "€": "EUR", "ß": "ss",
    "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O",
}


def repair_text(text: str) -> str:
    """Undo UTF-8 that was read as Windows-1252 or Latin-1, then fold Latin letters to ASCII.

    A stretch of characters is only read again where it spells the bytes of one UTF-8
    character; leftover control characters are Windows-1252 bytes. Letters that have no
    ASCII base, such as those of other scripts, stay as they are.
    """
    reread = _MISREAD.sub(_as_utf8, text)
    plain = _SPECIAL.sub(lambda m: _PLAIN[m[0]], reread)
    return _FOREIGN.sub(lambda m: _folded(m[0]), plain)


_FOREIGN = re.compile(r"[^\x00-\x7f]")


@functools.cache
def _folded(character: str) -> str:
    """The ASCII part of a character's decomposition, or the character if it has none."""
    if unicodedata.combining(character) or unicodedata.category(character) in ("Cc", "Cf"):
        return ""  # a mark of the letter before, or nothing to see
    return unicodedata.normalize("NFKD", character).encode("ascii", "ignore").decode("ascii") or character


def _characters(first: int, last: int) -> dict[str, int]:
    """Every character that stands for a byte in the range, in Latin-1 or Windows-1252."""
    out = {chr(b): b for b in range(first, last + 1)}
    for b in range(first, last + 1):
        out.setdefault(bytes([b]).decode("cp1252", "ignore"), b)
    out.pop("", None)
    return out


_FOLLOW = _characters(0x80, 0xBF)
_BYTE = {**_characters(0xC2, 0xF4), **_FOLLOW}
_NEXT = "[" + re.escape("".join(_FOLLOW)) + "]"
_MISREAD = re.compile(f"[\u00c2-\u00df]{_NEXT}|[\u00e0-\u00ef]{_NEXT}{{2}}|[\u00f0-\u00f4]{_NEXT}{{3}}")


def _as_utf8(match: re.Match) -> str:
    try:
        return bytes(_BYTE[c] for c in match[0]).decode("utf-8")
    except UnicodeDecodeError:
        return match[0]


# Control characters U+0080-U+009F by their Windows-1252 meaning, and the folds above.
_CONTROLS = {chr(b): bytes([b]).decode("cp1252", "ignore") for b in range(0x80, 0xA0)}
_PLAIN = {c: TYPOGRAPHIC.get(meant, meant) for c, meant in _CONTROLS.items()} | TYPOGRAPHIC
_SPECIAL = re.compile("[" + re.escape("".join(_PLAIN)) + "]")


@F.pandas_udf(T.StringType())
def _repair(texts: pd.Series) -> pd.Series:
    return texts.map(repair_text, na_action="ignore")


def repaired(x: Column) -> Column:
    """Repaired and folded text; only rows with non-ASCII characters leave the JVM."""
    foreign = x.rlike(NON_ASCII)
    return F.when(foreign, _repair(F.when(foreign, x))).otherwise(x)
