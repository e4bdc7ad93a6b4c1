"""Similarity join of keywords with lookup keys.

The score of a pair compares token sets. With the shared tokens joined to a text of length s, and
the remaining tokens of either side, sorted and joined, to x (length a) and y (length b), it is
the best of

* 100 when the sides share a token and one has none left,
* 100 - 100 * indel(x, y) / (length of both sides),
* 100 - 100 * (1 + a) / (2s + 1 + a), and the same with b, when they share a token.

Comparing all pairs is out of the question. Texts that score 100 are settled first, by a join that tests within its condition whether
one side has all tokens of the other and keeps the first key alone (see ``_covered``). For the rest, candidates come from an equi-join that no pair
reaching the cutoff can escape. A text's keys for it are made within its row, by array functions: some of its tokens (see
``_rare_tokens``) and some of its letter pairs (see ``_join_keys``), rare ones first. How many lookup keys have a token is joined to the
texts' tokens, so the order is exact however many tokens there are. What letter pairs are rare is read off the lookup
once, as counts in ``_BUCKETS`` buckets of hashed pairs: an array of fixed size that travels as a constant. Unlike pairs may
share a bucket, which changes their order alone; any one order that both sides use finds all pairs. Keys that the lookup does
not have, and the letter pairs of texts too long or short for any of its keys, are left out before the join. Few of the
candidates need the indel distance, the one thing Spark has no function for.

The join asks for a merge join. Size estimates know nothing of how many rows ``explode``
makes, so left to them the planner might broadcast a table many times larger than it thinks.
"""

from __future__ import annotations

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.functions.text import tokens
from trendloom.session import stage

# Functions of this module travel with the task, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_EPS = 1e-9
_WORDS = 4
_TOKEN_WORDS = 2
_BUCKETS = 1 << 14


def _indel(x: str, y: str) -> int:
    """Insertions and deletions from x to y: both lengths less twice the longest common subsequence.

    The subsequence length is found with one machine-word style update per character of ``y``;
    zero bits of ``row`` mark its growth.
    """
    where: dict[str, int] = {}
    for i, ch in enumerate(x):
        where[ch] = where.get(ch, 0) | (1 << i)
    full = (1 << len(x)) - 1
    row = full
    for ch in y:
        hit = row & where.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    common = len(x) - row.bit_count()
    return len(x) + len(y) - 2 * common


@F.pandas_udf(T.IntegerType())
def indel_distance(x: pd.Series, y: pd.Series) -> pd.Series:
    return pd.Series(
        [None if a is None or b is None else _indel(a, b) for a, b in zip(x, y)], dtype="Int32"
    )


def _computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns behind a generator.

    A filter on them is then not pushed below it, which would copy their expressions into every
    place the filter mentions them.
    """
    one = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(one)))


def _profile(df: DataFrame, text: str, side: str) -> DataFrame:
    """Sorted distinct tokens of each text, as one space-joined text; texts without a token match nothing."""
    joined = F.array_join(tokens(F.col(text)), " ")
    return _computed(df, **{f"{side}_norm": joined}).where(F.col(f"{side}_norm") != "")


def _token_list(side: str) -> Column:
    return F.split(f"{side}_norm", " ")


def _bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(_BUCKETS)).cast("int")


def _numbered_grams(df: DataFrame, side: str, where: Column | None = None) -> DataFrame:
    """``{side}_grams``: the letter pairs of the space-padded text, repeats told apart by their number. They make no join keys where ``where`` is false.

    Which pairs there are does not depend on token order.
    """
    norm = F.col(f"{side}_norm")
    padded = F.concat(F.lit(" "), norm, F.lit(" "))
    pairs = F.transform(F.sequence(F.lit(1), F.length(norm) + 1), lambda i: F.substring(padded, i, F.lit(2)))
    df = _computed(df, _pairs=F.sort_array(pairs), _near=F.lit(True) if where is None else where)
    number = lambda p, i: (i + 2 - F.array_position("_pairs", p)).cast("string")
    return _computed(df, **{f"{side}_grams": F.transform("_pairs", lambda p, i: F.concat(F.lit("g"), p, number(p, i)))}).drop("_pairs")


def _counts(keys: DataFrame) -> Column:
    """How many letter pairs of the lookup fall into each bucket, as one constant array."""
    found = keys.select(F.explode("k_grams").alias("key")).groupBy(_bucket(F.col("key")).alias("at")).agg(F.count("*").alias("n")).collect()
    counts = [0] * _BUCKETS
    for r in found:
        counts[r["at"]] = r["n"]
    return F.from_json(F.lit(str(counts)), T.ArrayType(T.LongType()))


def _ranked(texts: DataFrame, side: str, counts: DataFrame) -> DataFrame:
    """({side}_norm, _tokens): the tokens of each distinct text with the number of lookup keys that have them, rarest first, and what else ``counts`` tells of them."""
    each = texts.select(f"{side}_norm", F.explode(_token_list(side)).alias("token")).join(counts, "token", "left")
    told = [F.coalesce(name, F.lit(False)).alias(name) for name in counts.columns if name not in ("token", "n")]
    one = F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.concat(F.lit("t"), "token").alias("key"), *told)
    return each.groupBy(f"{side}_norm").agg(F.sort_array(F.collect_list(one)).alias("_tokens"))


def _rarest_first(keys: Column, counts: Column) -> Column:
    ordered = F.sort_array(F.transform(keys, lambda k: F.struct(counts[_bucket(k)].alias("n"), k.alias("key"))))
    return F.transform(ordered, lambda o: o["key"])


def _rare_tokens(ordered: Column, budget: Column) -> Column:
    """The first tokens, up to the first that takes the weight beyond ``budget``.

    A token weighs its length plus one. If none of these tokens were shared, the unshared part
    would outweigh the budget. Their keys are one letter longer than they are.
    """
    spent = lambda i: F.aggregate(F.slice(ordered, F.lit(1), i), F.lit(0), lambda acc, k: acc + F.length(k))
    return F.filter(ordered, lambda k, i: spent(i) <= budget)


def _bits(places: Column, word: int) -> Column:
    """Word ``word`` of a bitmap of all the text's letter pairs, given their places."""
    bit = lambda p: F.call_function("shiftleft", F.lit(1).cast("bigint"), p - 64 * word)
    here = lambda p: F.when(p.between(64 * word, 64 * word + 63), bit(p)).otherwise(F.lit(0).cast("bigint"))
    return F.aggregate(places, F.lit(0).cast("bigint"), lambda acc, p: acc.bitwiseOR(here(p)))


def _hashed(keys: Column, words: int = _WORDS) -> Column:
    """A place in a bitmap for each key."""
    return F.transform(keys, lambda k: F.pmod(F.xxhash64(k), F.lit(64 * words)).cast("int"))


def _with_bits(df: DataFrame, side: str, places: str, words: int = _WORDS) -> DataFrame:
    return _computed(df, **{f"{side}_bits{w}": _bits(F.col(places), w) for w in range(words)})


def _share(delta: float) -> float:
    """How much of a text's length its unshared tokens may weigh in the third form of the score."""
    return 2 * delta / (1 + delta)


def _rare_of(side: str, delta: float) -> Column:
    return _rare_tokens(F.transform("_tokens", lambda t: t["key"]), F.length(f"{side}_norm") * _share(delta) + _EPS)


def _join_keys(df: DataFrame, side: str, counts: Column, delta: float) -> DataFrame:
    """A row for each key of a text that the other side may have: tokens, and the rarest letter pairs with their places.

    Tokens. The third form of the score reaches the cutoff only if the unshared tokens of a side weigh
    at most 2 * delta / (1 + delta) of its length. So one of that side's rarest tokens,
    enough of them to exceed that weight, must be shared; it is among all tokens of the
    other side. Rare tokens of lookup keys meet all tokens of texts, and rare ones of texts, under keys of their own, all tokens of lookup keys: a common word,
    rare to neither, meets nothing.

    Letter pairs. The second form reaches the cutoff only if indel <= delta * (sum of lengths). A text has
    one letter pair more than its length; a deletion loses two of them, an insertion one. So both
    share at least (0.5 - 1.5 * delta) * (sum of lengths) + 1 pairs. With all pairs in one order,
    two such texts share one early on: within a prefix, as many as are needed to meet any partner. Keys of letter pairs hold a step of the
    length as well. Near lengths are on the same step or on neighbouring ones, so lookup keys stand on three and texts on one.
    """
    n = F.length(f"{side}_norm")
    df = _computed(df, _rare=_rare_of(side, delta), _ordered=_rarest_first(F.col(f"{side}_grams"), counts), _places=_hashed(F.col(f"{side}_grams")))
    df = _computed(_with_bits(df, side, "_places"), **{f"{side}_len": n})
    entry = lambda key, place: F.struct(key.alias("key"), place.alias("pos"))
    none = F.lit(None).cast("int")
    is_rare = lambda t: F.array_contains("_rare", t["key"])
    by_key, by_text = (lambda t: t["rare"], lambda t: is_rare(t) & (t["n"] > 0)) if side == "q" else (is_rare, lambda t: F.lit(True))
    entries = F.concat(
        F.transform(F.filter("_tokens", by_key), lambda t: entry(t["key"], none)),
        F.transform(F.filter("_tokens", by_text), lambda t: entry(F.concat(F.lit("r"), t["key"]), none)),
    )
    least_common = F.ceil(n * ((1 - 3 * delta) / (1 + delta)) + 1 - _EPS)
    prefix = F.slice("_ordered", F.lit(1), F.when(F.col("_near"), F.greatest(n + 2 - least_common, F.lit(0))).otherwise(0).cast("int"))
    placed = F.transform(prefix, lambda g, i: entry(g, i))
    placed = F.filter(placed, lambda e: counts[_bucket(e["key"])] > 0)
    step = F.floor(F.log(n.cast("double")) / (math.log((1 + delta) / (1 - delta)) + _EPS) if delta else n).cast("int")
    at = lambda d: F.transform(placed, lambda e: entry(F.concat(e["key"], F.lit(":"), (step + d).cast("string")), e["pos"]))
    entries = F.concat(entries, *[at(d) for d in ((0,) if side == "q" else (-1, 0, 1))])
    rows = df.withColumn("_entry", F.explode(entries)).drop("_tokens", "_ordered", "_places", "_rare", "_near", f"{side}_grams")
    return rows.select("*", *[F.col(f"_entry.{f}").alias(f"{side}_{f}") for f in ("key", "pos")]).drop("_entry")


def _missing(side: str, other: str, words: int = _WORDS) -> Column:
    """Bits of one side the other lacks; each stands for at least one letter pair, or token, it lacks."""
    counts = [
        F.bit_count(F.col(f"{side}_bits{w}").bitwiseAND(F.bitwise_not(f"{other}_bits{w}"))) for w in range(words)
    ]
    return sum(counts[1:], counts[0])


def _candidates(q: DataFrame, k: DataFrame, delta: float) -> DataFrame:
    """Pairs that can reach the cutoff: they share a token that is rare to one side, or are near in letters.

    Every unshared token takes its letter pairs with it, so in the former case the bitmap of all pairs of that side must lack few bits on the other. For
    the latter, a shared letter pair must stand at places that leave enough pairs behind it, lengths must be near,
    and the bitmaps must not differ in more bits than pairs may be missing. All of
    this is part of the join condition, so pairs that fail it are never emitted.
    """
    lengths = k.agg(F.min(F.length("k_norm")).alias("low"), F.max(F.length("k_norm")).alias("high")).first()
    reach, n = (1 + delta) / (1 - delta), F.length("q_norm")
    near_any = n.between((lengths["low"] or 0) / reach - 1, (lengths["high"] or 0) * reach + 1)
    # Texts get the full number of partitions: they are few bytes now, which would let adaptive execution merge them into few tasks, but many rows once taken apart.
    parts = int(q.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    q = q.where(near_any | F.exists("_tokens", lambda t: t["n"] > 0))
    q, k = q.repartition(parts, "q_norm"), k.drop("place", "leads").repartition(parts, "k_norm")
    q, k = _numbered_grams(q, "q", near_any), _numbered_grams(k, "k")
    counts = _counts(k)
    q_keys, k_keys = _join_keys(q, "q", counts, delta), _join_keys(k, "k", counts, delta)
    q_len, k_len = F.col("q_len"), F.col("k_len")
    q_lacks, k_lacks = _missing("q", "k"), _missing("k", "q")
    common = (q_len + k_len) * (0.5 - 1.5 * delta) + 1 - _EPS
    near = F.abs(q_len - k_len) <= (q_len + k_len) * delta + _EPS
    behind = 1 + F.least(q_len - F.col("q_pos"), k_len - F.col("k_pos")) >= common
    by_letters = near & behind & (q_lacks <= q_len + 1 - common) & (k_lacks <= k_len + 1 - common)
    by_tokens = (q_lacks <= q_len * _share(delta) + _EPS) | (k_lacks <= k_len * _share(delta) + _EPS)
    joins = F.when(F.col("q_pos").isNull(), by_tokens).otherwise(by_letters)
    pairs = q_keys.hint("merge").join(k_keys, (F.col("q_key") == F.col("k_key")) & joins)
    # Dealt out by text, the repeats of a pair and the best of a text meet without another shuffle.
    return pairs.select("q_norm", "key", "k_norm", "genre", "ordinal").repartition(parts, "q_norm").dropDuplicates(["q_norm", "k_norm"])


def _covered(q: DataFrame, k: DataFrame, around: bool = True) -> DataFrame:
    """(q_norm, place): the first lookup key whose tokens are contained in the text's, or, if ``around``, contain them.

    A key within a text has its rarest token there, a text within a key its own. So texts bring those of their tokens that are some key's rarest, and, under another key, their
    rarest one alone. A key with an earlier one within it is never the first within a text; only those that lead are looked for there. The condition holds the whole test, bitmaps of tokens first, and each task keeps the first place of a text: pairs
    are neither written nor sent.
    """
    def keyed(df: DataFrame, side: str, inner: Column, outer: Column) -> DataFrame:
        entry = lambda inner: lambda t: F.struct(F.concat(F.lit("k" if inner else "q"), t["key"]).alias("key"), F.lit(inner).alias("inner"))
        df = _computed(df, _places=_hashed(_token_list(side), _TOKEN_WORDS), _entries=F.concat(F.transform(inner, entry(True)), F.transform(F.filter(outer, lambda t: F.lit(around)), entry(False))))
        df = _with_bits(df, side, "_places", _TOKEN_WORDS).withColumn("_entry", F.explode("_entries"))
        rest = [] if side == "q" else ["place"]
        return df.select(f"{side}_norm", *rest, *[f"{side}_bits{w}" for w in range(_TOKEN_WORDS)], *[F.col(f"_entry.{f}").alias(f"{side}_{f}") for f in ("key", "inner")])

    first = F.slice("_tokens", 1, 1)
    q = keyed(q, "q", F.filter("_tokens", lambda t: t["first"]), F.filter(first, lambda t: t["n"] > 0))
    k = keyed(k, "k", F.filter(first, lambda t: F.col("leads")), F.col("_tokens"))
    lacks_none = lambda a, b: (_missing(a, b, _TOKEN_WORDS) == 0) & (F.size(F.array_except(_token_list(a), _token_list(b))) == 0)
    test = F.when(F.col("q_inner"), lacks_none("k", "q")).otherwise(lacks_none("q", "k"))
    found = q.hint("merge").join(k, (F.col("q_key") == F.col("k_key")) & test)
    return found.groupBy("q_norm").agg(F.min("place").alias("place"))


def _with_score(pairs: DataFrame, cutoff: float) -> DataFrame:
    delta = 1 - cutoff / 100
    pairs = _computed(pairs, _q=_token_list("q"), _k=_token_list("k"))
    pairs = _computed(
        pairs,
        _s=F.length(F.array_join(F.array_intersect("_q", "_k"), " ")),
        _x=F.array_join(F.array_except("_q", "_k"), " "),
        _y=F.array_join(F.array_except("_k", "_q"), " "),
    )
    s, a, b = F.col("_s"), F.length("_x"), F.length("_y")
    total = 2 * (s + F.when(s > 0, 1).otherwise(0)) + a + b

    def by_length(rest: Column) -> Column:
        return F.when(s > 0, 100 - 100 * (1 + rest) / (2 * s + 1 + rest)).otherwise(F.lit(0.0))

    covered = (s > 0) & ((a == 0) | (b == 0))
    pairs = _computed(
        pairs,
        _total=total,
        _most=F.floor(total * delta + _EPS).cast("int"),
        _plain=F.when(covered, F.lit(100.0)).otherwise(F.greatest(by_length(a), by_length(b))),
    )
    # Edit distance with substitutions never exceeds the indel distance, so a cheap built-in
    # test spares nearly all candidates the trip to Python.
    edits = F.call_function("levenshtein", F.col("_x"), F.col("_y"), F.col("_most"))
    near = (F.col("_plain") < 100) & (F.abs(F.length("_x") - F.length("_y")) <= F.col("_most"))
    pairs = _computed(pairs, _near=F.when(near, edits >= 0).otherwise(F.lit(False)))
    pairs = pairs.where(F.col("_near") | (F.col("_plain") >= cutoff))
    distance = indel_distance(F.when(F.col("_near"), F.col("_x")), F.when(F.col("_near"), F.col("_y")))
    by_letters = F.coalesce(100 - 100 * F.col("_distance") / F.col("_total"), F.lit(0.0))
    pairs = _computed(pairs.withColumn("_distance", distance), score=F.greatest("_plain", by_letters))
    return pairs.where(F.col("score") >= cutoff)


def _uses(k: DataFrame, delta: float) -> DataFrame:
    """How many lookup keys have a token, whether it is the ``first``, or rarest, of one that leads, and whether it is ``rare`` to one."""
    told = lambda t, i: F.struct(
        F.substr(t["key"], F.lit(2)).alias("token"), ((i == 0) & F.col("leads")).alias("first"), F.array_contains("_rare", t["key"]).alias("rare")
    )
    each = _computed(k, _rare=_rare_of("k", delta)).select(F.inline(F.transform("_tokens", told)))
    return stage(each.groupBy("token").agg(F.count("*").alias("n"), F.max("first").alias("first"), F.max("rare").alias("rare")), "token-uses")


def _sides(keywords: DataFrame, lookup: DataFrame, delta: float = 0.0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kw, q_norm) of all keywords, then both sides of the join with one row per text, written once, as every branch of the join reads them.

    Of lookup keys with the same tokens only the first can be an answer. ``place`` numbers keys in file order, and a key ``leads`` if no earlier one lies within it. Tokens of texts
    tell how lookup keys use them (see ``_uses``).
    """
    named = stage(_profile(keywords.select("kw").distinct(), "kw", "q"), "keywords")
    k = _profile(lookup.select(F.col("keyword").alias("key"), "genre", "ordinal"), "key", "k")
    k = k.groupBy("k_norm").agg(F.min(F.struct("ordinal", "key", "genre")).alias("m")).select("k_norm", "m.*")
    k = stage(k.orderBy("ordinal", "key").withColumn("place", F.monotonically_increasing_id()), "keys")
    counts = stage(k.select(F.explode(_token_list("k")).alias("token")).groupBy("token").agg(F.count("*").alias("n")), "token-counts")
    k = stage(_ranked(k, "k", counts).join(k, "k_norm").withColumn("leads", F.lit(True)), "ranked-keys")
    earliest = _covered(_ranked(k, "k", _uses(k, delta)).withColumnRenamed("k_norm", "q_norm"), k, around=False)
    earliest = earliest.select(F.col("q_norm").alias("k_norm"), F.col("place").alias("_earliest"))
    k = stage(k.join(earliest, "k_norm").withColumn("leads", F.col("place") == F.col("_earliest")).drop("_earliest"), "led-keys")
    q = stage(_ranked(named.select("q_norm").distinct(), "q", _uses(k, delta)), "ranked-keywords")
    return named, q, k


def _first_best(scored: DataFrame) -> DataFrame:
    """Highest score per text, the earliest lookup entry on ties."""
    best = scored.groupBy("q_norm").agg(F.max_by(F.struct("key", "genre", "ordinal", "score"), F.struct("score", -F.col("ordinal"))).alias("m"))
    return best.select("q_norm", "m.*")


def _answers(covered: DataFrame, k: DataFrame) -> DataFrame:
    return covered.join(k.select("place", "key", "genre", "ordinal"), "place").select("q_norm", "key", "genre", "ordinal", F.lit(100.0).alias("score"))


def token_subset_join(keywords: DataFrame, lookup: DataFrame) -> DataFrame:
    """First lookup entry, in file order, whose tokens contain the keyword's or are contained in them."""
    named, q, k = _sides(keywords, lookup)
    covered = stage(_covered(q, k), "covered")
    return named.join(_answers(covered, k), "q_norm").select("kw", "key", "genre", "ordinal", "score")


def fuzzy_join(keywords: DataFrame, lookup: DataFrame, cutoff: float = 85, min_len: int = 4) -> DataFrame:
    """Best lookup entry for each keyword of at least ``min_len`` characters, if it reaches ``cutoff``.

    ``keywords`` has a ``kw`` column; the result is (kw, key, genre, ordinal, score).
    """
    if not 67 <= cutoff <= 100:
        raise ValueError("cutoff must lie between 67 and 100: below that no candidate filter holds")
    delta = 1 - cutoff / 100
    named, q, k = _sides(keywords.where(F.length("kw") >= min_len), lookup, delta)
    covered = stage(_covered(q, k), "covered")
    open_ = stage(q.join(covered, "q_norm", "left_anti"), "open-keywords")
    best = _first_best(_with_score(_candidates(open_, k, delta), cutoff))
    return named.join(best.unionByName(_answers(covered, k)), "q_norm").select("kw", "key", "genre", "ordinal", "score")


def fuzzy_ext_join(keywords: DataFrame, lookup_ext: DataFrame, cutoff: float = 92, min_len: int = 8) -> DataFrame:
    """The stricter join with the large lookup: multi-word keywords and keys only."""
    long_phrase = (F.length("keyword") >= min_len) & F.col("keyword").contains(" ")
    phrases = keywords.where(F.col("kw").contains(" "))
    return fuzzy_join(phrases, lookup_ext.where(long_phrase), cutoff, min_len)
