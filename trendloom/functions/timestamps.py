"""Repair and parsing of the dirty ``datetime`` text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendloom.functions.text import strip

# Arabic-Indic digits, then Extended Arabic-Indic digits.
_FOREIGN_DIGITS = "٠١٢٣٤٥٦٧٨٩" + "۰۱۲۳۴۵۶۷۸۹"
_ASCII_DIGITS = "0123456789" * 2
# Fixed value: Buddhist-era year seen in the logs, and the common-era year it stands for.
YEAR_FIXES = {"2565": "2022"}

_DAY = r"^(\d{4}-\d{2}-\d{2})"
_TIME = r" \d{2}:\d{2}:\d{2}\."


def clean_datetime(c: Column, year_fixes: Mapping[str, str] = YEAR_FIXES) -> Column:
    """``yyyy-MM-dd HH:mm:ss.f`` text with one to three fraction digits, null if beyond repair.

    Well-formed values, nearly all of them, take one regex test and a substring. The repair of
    the rest is a chain in which each step refers to the one before it once, so the expression
    stays small where Catalyst copies it. ``nullif`` would hold the chain twice; a match out of a list does not.
    """
    s = F.translate(strip(c), _FOREIGN_DIGITS, _ASCII_DIGITS)
    for wrong, right in year_fixes.items():
        s = F.regexp_replace(s, f"^{wrong}", right)
    s = F.regexp_replace(s, _DAY + r"\s+(?=\d:)", "$1 0")
    s = F.regexp_replace(s, _DAY + r"\s+(\d{2}:\d{2}:\d{2})(?!\.\d).*", "$1 $2.000")
    s = F.regexp_replace(s, _DAY + r"\s+", "$1 ")
    repaired = F.get(F.regexp_extract_all(s, F.lit(_DAY + _TIME + r"\d{1,3}"), 0), F.lit(0))
    good = c.rlike(_DAY + _TIME + r"\d{3}")
    for wrong in year_fixes:
        good &= ~c.startswith(wrong)
    return F.when(good, F.left(c, F.lit(23))).otherwise(repaired)


def parse_event_ts(clean: Column) -> Column:
    """Timestamp of cleaned text; impossible dates give null instead of an ANSI error.

    ``clean_datetime`` fixes the layout, so the cast parser is enough; it is much cheaper than
    a pattern formatter.
    """
    return F.try_to_timestamp(clean)


def local_hour(ts: Column, offset_hours: int = 7) -> Column:
    return F.hour(ts + F.make_dt_interval(F.lit(0), F.lit(offset_hours)))


def plausible_year(ts: Column, first_year: int = 2015) -> Column:
    """False or null for corrupt years, so both are dropped by a filter."""
    return F.year(ts) >= first_year


def cross_partition_date(ts: Column, dt: Column) -> Column:
    """Event year differs from the partition's year; null where ``dt`` holds foreign digits."""
    return F.year(ts) != F.substring(dt, 1, 4).try_cast("int")
