"""License notices in texts, by DataFrame expressions only.

Fixed phrases are found where their words stand one after the other. Beyond that, every line of a text is held against
the license templates by an exact set-similarity join: a line matches if it has at least ``CONTAINMENT`` of the
distinct tokens of a template.

Tokens are put in one global order, rarest first by the number of lines that have them in the whole corpus. With
``a`` tokens needed out of a template of ``t``, a matching line shares one of the first t - a + 1 tokens of the
template in that order (prefix filter), has at least ``a`` tokens itself (length filter), and what still follows in line
and template after the shared token must suffice (positional filter). Only such pairs are verified. Tokens
outside the templates cannot match and are left out of the lines beforehand.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.llm.common import stage

# Notices are short and differ in a word or a number, such as "affero" or "2"; below this they would be taken for each other.
CONTAINMENT = 0.95
MAX_TEMPLATE_TOKENS = 5000

# The phrases and labels of the base rule.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# License notices as they are commonly worded; several may stand for one label.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-2", "licensed under the gnu general public license version 2"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl-3", "licensed under the gnu affero general public license version 3"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under a creative commons attribution share alike license"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("rights-reserved", "all rights reserved"),
]

_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]"
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Runs of anything but U+0000 to U+007F without digits and letters; capitals are left as they are."""
    return F.filter(F.split(text, _GAP), lambda w: w != "")


def _phrase(phrase: str) -> str:
    return rf"(?i)(?<!{_WORD}){_GAP.join(phrase.split())}(?!{_WORD})"


def base_matches(rows: DataFrame) -> DataFrame:
    """rows with n_words, n_base, first_word, last_word and base_found (array of labels)."""
    others = [c for c in rows.columns if c != "text"]
    n_words = F.size(words_of(F.col("text"))).cast("long")
    found = rows.select(*others, n_words.alias("n_words"), *[
        F.when(F.col("text").rlike(_phrase(p)), F.split("text", _phrase(p))).alias(f"pieces_{i}") for i, p in enumerate(PHRASES)
    ])
    firsts, lasts, places, labels = [], [], F.lit(0).cast("long"), []
    for i, (phrase, label) in enumerate(PHRASES.items()):
        pieces = F.col(f"pieces_{i}")
        firsts.append(F.size(words_of(pieces[0])))
        lasts.append(F.col("n_words") - F.size(words_of(F.element_at(pieces, -1))) - len(phrase.split()))
        places = places + F.coalesce(F.size(pieces) - 1, F.lit(0))
        labels.append(F.when(pieces.isNotNull(), F.lit(label)))
    least = F.array_min(F.array(*[F.when(F.col(f"pieces_{i}").isNotNull(), x) for i, x in enumerate(firsts)]))
    most = F.array_max(F.array(*[F.when(F.col(f"pieces_{i}").isNotNull(), x) for i, x in enumerate(lasts)]))
    return found.select(
        *others, "n_words", places.alias("n_base"), least.cast("long").alias("first_word"), most.cast("long").alias("last_word"),
        F.array_compact(F.array(*labels)).alias("base_found"),
    )


def vocabulary() -> list[str]:
    tokens = sorted({w for _, text in TEMPLATES for w in text.split()})
    if len(tokens) > MAX_TEMPLATE_TOKENS:
        raise ValueError(f"the templates have {len(tokens)} tokens; at most {MAX_TEMPLATE_TOKENS} are held in the plan")
    return tokens


def line_tokens(rows: DataFrame) -> DataFrame:
    """(doc_id, text_key, line, tokens): the distinct template tokens of every line that has some."""
    lines = rows.select("doc_id", "text_key", F.posexplode(F.split("text", "\n")).alias("line", "words"))
    # Template tokens are plain ASCII, so a word with other characters is none of them, whatever its lower case.
    known = F.filter(words_of(F.col("words")), lambda w: F.lower(w).isin(vocabulary()) & (F.octet_length(w) == F.length(w)))
    tokens = F.array_distinct(F.transform(known, F.lower))
    return lines.select("doc_id", "text_key", "line", tokens.alias("tokens")).where(F.size("tokens") > 0)


def token_order(tokens: DataFrame) -> Column:
    """Map from each template token to its place in the global order; tokens in no line come first."""
    counts = tokens.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    seen = {r.token: r.n for r in counts.collect()}
    ranked = sorted(vocabulary(), key=lambda t: (seen.get(t, 0), t))
    return F.map_from_arrays(F.array(*[F.lit(t) for t in ranked]), F.array(*[F.lit(i) for i in range(len(ranked))]))


def template_prefixes(spark: SparkSession, rank: Column, threshold: float) -> DataFrame:
    """(label, template, needed, t_size, t_tokens, token, t_place): the prefix tokens of every template, in global order."""
    rows = [f"('{label}', {i}, '{text}')" for i, (label, text) in enumerate(TEMPLATES)]
    table = spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t(label, template, text)")
    tokens = F.array_distinct(F.split("text", " "))
    needed = F.ceil(F.size("t_tokens") * F.lit(threshold) - F.lit(1e-9)).cast("int")
    table = table.select("label", "template", _in_order(tokens, rank).alias("t_tokens")).withColumn("needed", needed).withColumn("t_size", F.size("t_tokens"))
    return table.select("*", F.posexplode("t_tokens").alias("t_place", "token")).where("t_place <= t_size - needed")


def _in_order(tokens: Column, rank: Column) -> Column:
    ranked = F.sort_array(F.transform(tokens, lambda t: F.struct(F.element_at(rank, t).alias("place"), t.alias("token"))))
    return F.transform(ranked, lambda x: x["token"])


def template_matches(rows: DataFrame, threshold: float = CONTAINMENT) -> DataFrame:
    """(doc_id, text_key, line, label, containment) of every line and template at or above the threshold."""
    tokens = stage(line_tokens(rows), "line-tokens")
    rank = token_order(tokens)
    templates = template_prefixes(rows.sparkSession, rank, threshold)
    lines = tokens.select("doc_id", "text_key", "line", _in_order(F.col("tokens"), rank).alias("tokens"))
    each = lines.select("*", F.size("tokens").alias("size"), F.posexplode("tokens").alias("place", "token"))
    enough = F.least(F.col("t_size") - F.col("t_place"), F.col("size") - F.col("place")) >= F.col("needed")
    pairs = each.join(templates, "token").where((F.col("size") >= F.col("needed")) & enough)
    shared = F.size(F.array_intersect("tokens", "t_tokens"))
    verified = pairs.withColumn("shared", shared).where("shared >= needed")
    return verified.select("doc_id", "text_key", "line", "label", "template", (F.col("shared") / F.col("t_size")).alias("containment")).distinct()


def scanned(docs: DataFrame, threshold: float = CONTAINMENT) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every row.

    score is the largest containment of a template in a line, or 1 where a base phrase stands; 0 without any. Null
    texts count as empty. Repeated rows get equal results, null ids are kept. An empty table gives no rows. Further
    columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    matches = template_matches(rows, threshold)
    by_row = matches.groupBy("doc_id", "text_key").agg(F.collect_set("label").alias("found"), F.max("containment").alias("best"))
    base = base_matches(rows).alias("b")
    on = F.col("b.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("b.text_key") == F.col("m.text_key"))
    both = base.join(by_row.alias("m"), on, "left")
    joined = lambda labels: F.array_join(F.sort_array(F.array_distinct(labels)), ",")
    every = F.concat("base_found", F.coalesce("found", F.array().cast("array<string>")))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0)))
    return both.select(
        "b.doc_id", "n_words", "n_base", "first_word", "last_word", joined(F.col("base_found")).alias("base_labels"), joined(every).alias("labels"), score.alias("score")
    )
