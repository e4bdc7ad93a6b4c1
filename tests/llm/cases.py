"""Awkward inputs that every operator must take, and small brute-force helpers."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "the same few words again and again " * 6000

ODD_ROWS = [
    (1, "plain words in a row that say nothing", "en", "a", 1),
    (1, "plain words in a row that say nothing", "en", "a", 1),
    (1, "another text under the same id", "fr", "a", 1),
    (2, None, "en", None, None),
    (3, "", None, "b", 0),
    (4, " \t\n ", "en", "b", 4),
    (None, "a text without an id", None, None, None),
    (None, None, None, None, None),
    (5, LONG, "en", "a", len(LONG)),
    (6, LONG, "en", "a", len(LONG)),
    (7, "İçé \U0001f600 ẞ Kelvin K \x00 tail", "de", "c", 1),
    (-8, "ONE", "en", "c", 3),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("text_key", "id_key", "row", "score", "size", "fingerprint", "spans", "root", "copies", "y", "n", "tokens", "stratum", "words")


def odd_documents(spark: SparkSession) -> DataFrame:
    """Nulls everywhere, repeats, one id twice, long and empty texts, and columns named like those inside the operators."""
    docs = spark.createDataFrame(ODD_ROWS, SCHEMA)
    return docs.withColumns({c: F.lit("x") for c in CLASHING})


def odd_labels(spark: SparkSession) -> DataFrame:
    rows = [(1, 1, 0), (1, 0, 1), (2, None, None), (None, 1, 1), (5, 0, 1), (6, 1, 0), (7, 1, 0), (99, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def documents(spark: SparkSession, texts: list[str | None]) -> DataFrame:
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)
