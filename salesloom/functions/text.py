"""Text normalisation as native column expressions.

Everything here takes and returns ``Column``; no Python runs per row.  The
compatibility-decomposition tables are derived once from ``unicodedata`` and
handed to Spark as constants, and they are only consulted for values that hold
a non-ASCII character.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

PAIR_END, PAIR_MIDDLE = "\x01", "\x02"
# Anything but ASCII and the accented Latin-1 letters, none of which becomes several.
UNUSUAL = "[^\\x00-\\x7f\\xc0-\\xff]"
HANGUL = range(0xAC00, 0xD7A4)
SURROGATES = range(0xD800, 0xE000)


@lru_cache(maxsize=1)
def whitespace() -> str:
    """Every character Unicode counts as white space, for two-sided trimming."""
    return "".join(c for c in map(chr, range(0x3001)) if c.isspace())


@lru_cache(maxsize=1)
def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """Compatibility decomposition without combining marks, as translate tables.

    Returns (from, to, wide): ``from``/``to`` feed ``translate`` (combining marks
    sit at the end of ``from`` with no partner, so they are deleted); ``wide``
    holds characters that become several, but for Hangul syllables, whose parts
    follow from their number (:func:`_syllable`).
    """
    narrow_from, narrow_to, dropped, wide = [], [], [], {}
    for cp in range(128, sys.maxunicode + 1):
        if cp in SURROGATES or cp in HANGUL:
            continue
        char = chr(cp)
        if unicodedata.combining(char):
            dropped.append(char)
            continue
        folded = "".join(
            c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c)
        )
        if folded == char:
            continue
        if len(folded) == 1:
            narrow_from.append(char)
            narrow_to.append(folded)
        elif not folded:
            dropped.append(char)
        else:
            wide[char] = folded
    return "".join(narrow_from + dropped), "".join(narrow_to), wide


@lru_cache(maxsize=1)
def _wide_class() -> str:
    """Regex character class of the characters that decompose into several."""
    points = sorted([*map(ord, _fold_tables()[2]), *HANGUL])
    spans, start = [], points[0]
    for here, following in zip(points, points[1:] + [None]):
        if following != here + 1:
            spans.append((start, here))
            start = following
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in spans) + "]"


def _syllable(char: Column) -> Column:
    """The two or three letters of a Hangul syllable, by the rule of their code points."""
    first, vowel, last = ("".join(map(chr, part)) for part in (range(0x1100, 0x1113), range(0x1161, 0x1176), range(0x11A8, 0x11C3)))
    place = F.ascii(char) - HANGUL[0]
    one = lambda letters, at: F.substr(F.lit(letters), at.cast("int"), F.lit(1))
    end = F.when(place % 28 == 0, F.lit("")).otherwise(one(last, place % 28))
    return F.concat(one(first, F.floor(place / 588) + 1), one(vowel, F.floor(place % 588 / 28) + 1), end)


def normalize_value(value: str) -> str:
    """:func:`normalize_text` for one configuration string on the driver."""
    folded = unicodedata.normalize("NFKD", value.strip().lower())
    kept = "".join(c for c in folded if not unicodedata.combining(c))
    return re.sub("[^a-z0-9#()/%]+", " ", kept).strip()


def strip(c: Column) -> Column:
    """Trim Unicode white space on both sides."""
    return F.btrim(c, F.lit(whitespace()))


def fold(c: Column) -> Column:
    """:func:`strip_accents` for characters that decompose into a single one."""
    source, target, _ = _fold_tables()
    return F.when(
        F.octet_length(c) > F.char_length(c), F.translate(c, source, target)
    ).otherwise(c)


def strip_accents(c: Column) -> Column:
    """Compatibility-decompose and drop combining marks."""
    wide = _fold_tables()[2]
    packed = PAIR_END.join(k + PAIR_MIDDLE + v for k, v in wide.items())
    pairs = F.str_to_map(F.lit(packed), F.lit(PAIR_END), F.lit(PAIR_MIDDLE))
    widened = F.array_join(
        F.transform(
            F.split(c, ""),
            lambda ch: F.when(ch.between(chr(HANGUL[0]), chr(HANGUL[-1])), _syllable(ch)).otherwise(F.coalesce(F.try_element_at(pairs, ch), ch)),
        ),
        "",
    )
    spread = F.when(c.rlike(UNUSUAL) & c.rlike(_wide_class()), widened).otherwise(c)
    return fold(spread)


def normalize_text(c: Column) -> Column:
    """Comparable form of a header cell: lower case, no accents, one space between words.

    Only ``a-z 0-9 # ( ) / %`` survive; any other run becomes one space.  Null gives "".
    """
    kept = F.regexp_replace(strip_accents(F.lower(c)), "[^a-z0-9#()/%]+", " ")
    return F.coalesce(F.trim(kept), F.lit(""))


def normalize_scalar_text(c: Column) -> Column:
    """Trimmed, lower case, no accents, single spaces; punctuation stays."""
    folded = strip_accents(F.lower(strip(c)))
    return F.regexp_replace(folded, "[\\s\\p{Z}\\x1c-\\x1f\\x85]+", " ")


def is_effectively_empty(c: Column) -> Column:
    """True for null and for text that normalises to nothing."""
    return normalize_text(c) == ""


def is_numeric_like(normalized: Column) -> Column:
    """True when the whole (normalised) value is digits, points, commas, slashes, dashes."""
    return normalized.rlike("^[0-9.,/-]+\\z")


def label(c: Column) -> Column:
    """Header cell as shown: trimmed text, "" for null."""
    return F.coalesce(strip(c), F.lit(""))


def standardize_string(c: Column) -> Column:
    """Trimmed text; blank stays "", null stays null."""
    return strip(c.cast("string"))
