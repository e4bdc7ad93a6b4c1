"""Quality rules whose cutoffs are chosen so that few good texts are lost, by DataFrame expressions only.

Each rule rejects texts whose value of some measure lies above a cutoff. Labelled texts that pass the base rules are the
holdout. In every stratum (language) a cutoff may be used only if an exact binomial test shows, from the good texts of
the holdout, that the rule rejects at most ``RISK / number of rules`` of the good texts there. As the rules' shares add
up, all rules of a stratum together falsely reject at most ``RISK`` of its good texts, with confidence ``1 - DELTA`` for
all strata at once. The tests are corrected for their number: ``DELTA`` is divided by the number of strata and rules
(Bonferroni), and the cutoffs of a rule are tested from the mildest on in a fixed order that ends at the first failure.
The strictest cutoff that passed is used. A stratum without enough good texts to prove anything gets no cutoff.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendloom.llm import common
from trendloom.llm.common import stage

RISK, DELTA = 0.05, 0.05
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

#: Cutoffs of each measure, from the mildest to the strictest; fixed before any label is seen.
CUTOFFS = {
    "symbol_share": (0.5, 0.3, 0.2, 0.15, 0.1, 0.05, 0.03, 0.02),
    "upper_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3),
    "dup_line_share": (0.8, 0.6, 0.5, 0.4, 0.3, 0.2),
    "repeat_share": (0.5, 0.4, 0.3, 0.2, 0.1),
    "word_length": (30.0, 20.0, 15.0, 12.0, 10.0),
}

_BLANK = r"[\x20\x09-\x0D]+"


def _let(value: Column, f) -> Column:
    """f(value), with the value computed once."""
    return F.transform(F.array(value), f)[0]


def _repeat_words(grams: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more: sorted windows bring equal ones together."""
    pairs = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

    def repeated(s: Column) -> Column:
        same = lambda k, other: F.coalesce(F.get(s, k)["g"] == F.get(s, other)["g"], F.lit(False))
        places = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda k: same(k, k - 1) | same(k, k + 1))
        return F.sort_array(F.transform(places, lambda k: s[k]["i"]))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    return _let(_let(pairs, repeated), covered)


def base_measures(docs: DataFrame) -> DataFrame:
    """docs (text and others) with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed.

    Further measures for the rules: n_lines (lines with a word), n_upper (A-Z) and n_letters (A-Z, a-z).
    """
    others = [c for c in docs.columns if c != "text"]
    text = F.coalesce("text", F.lit(""))
    trimmed = F.btrim(text, F.lit(common.SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _BLANK))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(common.SPACES)) != "")
    without = lambda pattern: F.length(text) - F.length(F.regexp_replace(text, pattern, ""))
    first = docs.select(
        *others, words.alias("words"), lines.alias("lines"),
        without(r"[#*$%&|<>]").alias("n_symbols"), without("[A-Z]").alias("n_upper"), without("[A-Za-z]").alias("n_letters"),
    )
    grams = F.when(
        F.size("words") >= 3,
        F.transform(F.sequence(F.lit(0), F.size("words") - 3), lambda i: F.concat_ws(" ", F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))),
    )
    second = first.select(
        *others, "n_symbols", "n_upper", "n_letters", F.size("words").alias("n_words"), F.length(F.array_join("words", "")).alias("word_chars"),
        F.size("lines").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"), grams.alias("grams"),
    )
    repeats = F.size("grams") > F.size(F.array_distinct("grams"))
    n_repeat = F.when(repeats, _repeat_words(F.col("grams"))).otherwise(0)
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_upper", "n_letters")
    third = second.select(*others, *[F.col(c).cast("long").alias(c) for c in counts], n_repeat.cast("long").alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return third.withColumn("base_failed", failed)


def rule_values() -> dict[str, Column]:
    per = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {
        "symbol_share": per("n_symbols", "word_chars"), "upper_share": per("n_upper", "n_letters"),
        "dup_line_share": per("n_dup_lines", "n_lines"), "repeat_share": per("n_repeat_words", "n_words"), "word_length": per("word_chars", "n_words"),
    }


def log_binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """ln P(Bin(n, p) <= k), term by term in logs. For k above n * p, where it exceeds ln 0.5 or so, 0."""
    odds = math.log(p) - math.log1p(-p)
    zero = n * math.log1p(-p)
    start = F.struct(zero.alias("term"), zero.alias("sum"))

    def add(state: Column, j: Column) -> Column:
        term = state["term"] + F.log(n - j + 1) - F.log(j) + odds
        high, low = F.greatest(term, state["sum"]), F.least(term, state["sum"])
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("sum"))

    terms = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<long>"))
    return F.when(k > n * p, F.lit(0.0)).otherwise(F.aggregate(terms, start, add, lambda s: s["sum"]))


def choose_cutoffs(holdout: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(stratum, cutoffs): the chosen cutoff of each rule by name. holdout: stratum, the rules' values; good texts only."""
    strata = max(1, holdout.select("stratum").distinct().count())
    tests = [(rule, step, cut) for rule, cuts in CUTOFFS.items() for step, cut in enumerate(cuts)]
    rejected = [F.count_if(F.col(rule) > cut).alias(f"k_{rule}_{step}") for rule, step, cut in tests]
    counts = holdout.groupBy("stratum").agg(F.count("*").alias("n"), *rejected)
    each = F.explode(F.array([
        F.struct(F.lit(rule).alias("rule"), F.lit(step).alias("step"), F.lit(float(cut)).alias("cut"), F.col(f"k_{rule}_{step}").alias("k"))
        for rule, step, cut in tests
    ]))
    rows = counts.select("stratum", "n", each.alias("t")).select("stratum", "n", "t.*")
    level = math.log(delta / (strata * len(CUTOFFS)))
    passed = log_binomial_cdf(F.col("k"), F.col("n"), risk / len(CUTOFFS)) <= level
    in_order = Window.partitionBy("stratum", "rule").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("usable", F.bool_and(passed).over(in_order)).where("usable")
    chosen = rows.groupBy("stratum", "rule").agg(F.min("cut").alias("cut"))
    return chosen.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cut"))).alias("cutoffs"))


def judged(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and kept of every row.

    Null texts have no word and fail the base rules. Null languages are a stratum of their own. Null labels do not
    count; a document labelled both ways counts as not good. Repeated rows get equal results. An empty table gives no
    rows; without labels only the base rules decide. Further columns are ignored.
    """
    stratum = F.coalesce(F.concat(F.lit("lang "), F.col("lang").cast("string")), F.lit("no lang")).alias("stratum")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), stratum, F.col("text").cast("string").alias("text"))
    measured = stage(base_measures(rows), "quality-measures")
    values = measured.withColumns(rule_values())
    good = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    good = good.agg(F.min("quality").alias("least")).where("least = 1").select("doc_id")
    cutoffs = choose_cutoffs(values.where("NOT base_failed").join(good, "doc_id", "left_semi"), risk, delta)
    joined = values.join(stage(cutoffs, "cutoffs"), "stratum", "left")
    over = [F.coalesce(F.col(rule) > F.col("cutoffs")[rule], F.lit(False)) for rule in CUTOFFS]
    kept = ~F.col("base_failed")
    for rejects in over:
        kept = kept & ~rejects
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"))
