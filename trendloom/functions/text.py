"""Keyword text functions."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendloom.schemas import GENRES, UNKNOWN

# Whitespace as str.split() sees it: Unicode White_Space plus the four separator controls.
_WS = r"[\s\x1c-\x1f]"


_WS_CHARS = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def strip(c: Column) -> Column:
    """Trim every kind of whitespace; Spark's plain ``trim`` only removes U+0020."""
    return F.btrim(c, F.lit(_WS_CHARS))


def keyword_norm(c: Column) -> Column:
    """Batch form: ``''`` stays ``''`` and only plain spaces are trimmed."""
    return F.lower(F.trim(c))


def stream_keyword_norm(c: Column) -> Column:
    """Stream form: trims all whitespace and turns ``''`` into null."""
    return F.nullif(strip(F.lower(c)), F.lit(""))


# The patterns that clean a keyword.
EXOTIC_SPACES = "[\u00a0\u200b\u3000]+"
LEADING_TAG = r"^\s*\[[^\]]{1,30}\]\s*"
NOTE = r"\s*\([^)]{1,30}\)"
EPISODE_SUFFIX = r"(?iU)\s+(?:tap|ep|episode|phan|part)\s*\d+\s*\z"
LONG_RUN = r"(.)\1{2,}"
CONTROL_OR_BACKSLASH = r"[\x00-\x1f\x7f\\]"


def preprocess_keyword(c: Column) -> Column:
    """Normalise a keyword before lookup: spaces, [tag], (note), episode suffix, long character runs."""
    c = F.regexp_replace(c, EXOTIC_SPACES, " ")
    c = F.trim(F.regexp_replace(c, rf"(?U){_WS}+", " "))
    c = F.regexp_replace(c, LEADING_TAG, "")
    c = F.regexp_replace(c, NOTE, "")
    c = F.regexp_replace(c, EPISODE_SUFFIX, "")
    return F.trim(F.regexp_replace(F.trim(c), LONG_RUN, "$1$1"))


@cache
def _diacritic_tables() -> tuple[str, str, dict[str, str]]:
    """What is left of each character when its canonical decomposition loses its marks, for all of Unicode.

    Derived from the Unicode tables; ``đ`` has no decomposition, so it is not in them. First the
    characters that leave one letter, then all marks: these have no counterpart, which makes
    ``translate`` delete them. The last table has those that leave several letters; Hangul syllables are not
    in it, as theirs follow from a rule.
    """
    accented, bases, marks, several = [], [], [], {}
    for ch in map(chr, range(0x80, sys.maxunicode + 1)):
        if unicodedata.category(ch) == "Mn":
            marks.append(ch)
        elif unicodedata.decomposition(ch)[:1] not in ("", "<"):
            base = "".join(x for x in unicodedata.normalize("NFD", ch) if unicodedata.category(x) != "Mn")
            if len(base) == 1:
                accented.append(ch)
                bases.append(base)
            else:
                several[ch] = base
    return "".join(accented) + "".join(marks), "".join(bases), several


_HANGUL = r"[\x{AC00}-\x{D7A3}]"


def _jamo(ch: Column) -> Column:
    """The two or three letters of a Hangul syllable, by the arithmetic of its code point."""
    letters = lambda first, n: F.array(*[F.lit(chr(first + i)) for i in range(n)])
    place = F.ascii(ch) - 0xAC00
    tails = F.concat(F.array(F.lit("")), letters(0x11A8, 27))
    lead = F.get(letters(0x1100, 19), F.floor(place / 588).cast("int"))
    vowel = F.get(letters(0x1161, 21), F.floor(F.pmod(place, F.lit(588)) / 28).cast("int"))
    return F.concat(lead, vowel, F.get(tails, F.pmod(place, F.lit(28)).cast("int")))


def strip_diacritics(c: Column, fold_d: bool = False) -> Column:
    """Decompose and remove combining marks. ``đ`` is kept unless ``fold_d`` is set.

    Only text with characters that fall into several letters is taken apart letter by letter.
    """
    source, target, several = _diacritic_tables()
    if fold_d:
        source, target = "đĐ" + source, "dD" + target
    plain = F.translate(c, source, target)
    parts = F.create_map(*[F.lit(x) for pair in several.items() for x in pair])
    letter = lambda x: F.when(x.rlike(_HANGUL), _jamo(x)).otherwise(F.coalesce(F.try_element_at(parts, x), x))
    apart = F.array_join(F.transform(F.split(plain, ""), letter), "")
    return F.when(plain.rlike("[" + "".join(several) + _HANGUL[1:]), apart).otherwise(plain)


def sanitize_keyword(c: Column) -> Column:
    """Control characters and backslashes become spaces, then trim."""
    return strip(F.regexp_replace(c, CONTROL_OR_BACKSLASH, " "))


# Other spellings of a genre code.
GENRE_ALIASES = {
    "PHIM_CHINA": "PHIM_TRUNG",
    "PHIM_CHINESE": "PHIM_TRUNG",
    "PHIM_TQ": "PHIM_TRUNG",
    "PHIM_TRUNG_QUOC": "PHIM_TRUNG",
    "PHIM_CHIEU_RAP": "PHIM_AU_MY",
    "PHIM_KOREAN": "PHIM_HAN",
    "PHIM_KOREA": "PHIM_HAN",
    "KDRAMA": "PHIM_HAN",
    "K_DRAMA": "PHIM_HAN",
    "K-DRAMA": "PHIM_HAN",
    "PHIM_JAPAN": "ANIME",
    "PHIM_NHAT": "ANIME",
    "MANGA": "ANIME",
    "CARTOON": "ANIME",
    "HOAT_HINH": "ANIME",
    "KPOP": "NHAC",
    "K_POP": "NHAC",
    "K-POP": "NHAC",
    "VARIETY": "TRUYEN_HINH",
    "SHOW": "TRUYEN_HINH",
    "PHIM_BO": "PHIM_VIET",
    "PHIM_LE": "PHIM_VIET",
}


def normalize_genre(c: Column) -> Column:
    """Canonical genre code; anything outside the domain, null included, is UNKNOWN."""
    code = strip(F.upper(c))
    pairs = [F.lit(x) for alias in GENRE_ALIASES.items() for x in alias]
    code = F.coalesce(F.try_element_at(F.create_map(*pairs), code), code)
    return F.when(code.isin(*GENRES), code).otherwise(F.lit(UNKNOWN))


def tokens(c: Column) -> Column:
    """Distinct whitespace-separated tokens, sorted."""
    parts = F.filter(F.split(c, rf"(?U){_WS}+"), lambda t: t != "")
    return F.sort_array(F.array_distinct(parts))
