import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of

from trendloom.operators import similarity as sim


def lcs(x, y):
    row = [0] * (len(y) + 1)
    for a in x:
        prev = row[:]
        for j, b in enumerate(y):
            row[j + 1] = prev[j] + 1 if a == b else max(prev[j + 1], row[j])
    return row[-1]


def token_set_score(q, k):
    """Plain-Python statement of the score, for comparison."""
    a, b = set(q.split()), set(k.split())
    if not a or not b:
        return 0.0
    s = len(" ".join(sorted(a & b)))
    x, y = " ".join(sorted(a - b)), " ".join(sorted(b - a))
    if s and (not x or not y):
        return 100.0
    total = 2 * (s + (s > 0)) + len(x) + len(y)
    best = 100 - 100 * (len(x) + len(y) - 2 * lcs(x, y)) / total
    if s:
        best = max(best, *(100 - 100 * (1 + len(z)) / (2 * s + 1 + len(z)) for z in (x, y)))
    return best


def best_by_brute_force(queries, lookup, cutoff):
    out = {}
    for q in queries:
        scored = [(token_set_score(q, k), -i, k) for i, (k, _) in enumerate(lookup)]
        score, _, key = max(scored)
        if score >= cutoff:
            out[q] = (key, round(score, 6))
    return out


def fixture(seed, alphabet, n_keys=60, n_queries=150):
    """Keys of random words; queries are keys with letters and words changed, so scores spread around the cutoff."""
    rng = random.Random(seed)
    words = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 7))) for _ in range(40)]
    keys = list(dict.fromkeys(" ".join(rng.choice(words) for _ in range(rng.randint(1, 5))) for _ in range(n_keys)))
    queries = set()
    while len(queries) < n_queries:
        q = list(rng.choice(keys))
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(q) + 1)
            kind = rng.random()
            if kind < 0.4 and q:
                q.pop(min(at, len(q) - 1))
            elif kind < 0.8:
                q.insert(at, rng.choice(alphabet + " "))
            else:
                q += [" "] + list(rng.choice(words))
        text = " ".join("".join(q).split())
        if text:
            queries.add(text)
    return sorted(queries), [(k, f"G{i}") for i, k in enumerate(keys)]


def frames(spark, queries, lookup):
    kw = spark.createDataFrame([(q,) for q in queries], "kw string")
    lut = spark.createDataFrame([(k, g, i) for i, (k, g) in enumerate(lookup)], "keyword string, genre string, ordinal long")
    return kw, lut


@pytest.mark.parametrize("seed, alphabet, cutoff", [(1, "abcd", 85), (2, "abcdefghijklmnop", 85), (3, "aăâeêđôơ", 92), (4, "abc", 75), (5, "ab", 92)])
def test_fuzzy_join_finds_exactly_what_brute_force_finds(spark, seed, alphabet, cutoff):
    queries, lookup = fixture(seed, alphabet)
    found = sim.fuzzy_join(*frames(spark, queries, lookup), cutoff=cutoff, min_len=1)
    got = {r.kw: (r.key, round(r.score, 6)) for r in found.collect()}
    assert got == best_by_brute_force(queries, lookup, cutoff)
    assert len(got) > 10


def test_minimum_length_and_phrases(spark):
    lookup = [("the", "UNKNOWN"), ("running man", "TRUYEN_HINH"), ("naruto", "ANIME")]
    kw, lut = frames(spark, ["the batman xyz", "the", "runing man", "narut", "runningman"], lookup)
    got = {r.kw: r.key for r in sim.fuzzy_join(kw, lut).collect()}
    assert got == {"the batman xyz": "the", "runing man": "running man", "narut": "naruto"}
    ext = {r.kw: r.key for r in sim.fuzzy_ext_join(kw, lut).collect()}
    assert ext == {"runing man": "running man"}


def test_subset_join_takes_the_first_entry(spark):
    lookup = [("b c", "1"), ("a", "2"), ("a b c d", "3"), ("z", "4")]
    kw, lut = frames(spark, ["a b c", "c", "y", "d a"], lookup)
    got = {r.kw: r.key for r in sim.token_subset_join(kw, lut).collect()}
    assert got == {"a b c": "b c", "c": "b c", "d a": "a"}


def test_low_cutoffs_are_refused(spark):
    kw, lut = frames(spark, ["a"], [("a", "x")])
    with pytest.raises(ValueError):
        sim.fuzzy_join(kw, lut, cutoff=50)


def test_indel_distance():
    rng = random.Random(6)
    for _ in range(300):
        x, y = ("".join(rng.choice("abđ ") for _ in range(rng.randrange(80))) for _ in range(2))
        assert sim._indel(x, y) == len(x) + len(y) - 2 * lcs(x, y)


def test_few_shuffles_and_no_window(spark):
    queries, lookup = fixture(1, "abcd")
    for join in (sim.fuzzy_join, sim.token_subset_join):
        plan = plan_of(join(*frames(spark, queries, lookup))).partition("(1)")[0]
        assert plan.count("Exchange") <= 8 and "Window" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_keys_are_made_within_the_row(spark):
    df = spark.createDataFrame([("aaa aaa",)], "q_norm string")
    grams = sim._numbered_grams(df, "q").first().q_grams
    assert grams == ["g a1", "g a2", "ga 1", "ga 2", "gaa1", "gaa2", "gaa3", "gaa4"]


def test_long_texts_and_many_repeats(spark):
    words = [f"ab{i}" for i in range(300)]
    lookup = [(" ".join(words), "A"), ("x" * 900, "B")]
    kw, lut = frames(spark, [" ".join([*words[1:], "ab"]), "x" * 880, "y" * 2000], lookup)
    got = {r.kw[:2]: r.genre for r in sim.fuzzy_join(kw, lut).collect()}
    assert got == {"ab": "A", "xx": "B"}


def test_keys_without_a_partner_are_not_made(spark):
    kw, lut = frames(spark, ["naruto", "qqqq wwww", "naruto zz " + "q" * 300], [("naruto", "ANIME"), ("one piece", "ANIME")])
    named, q, k = sim._sides(kw, lut)
    assert [(t.n, t.key) for t in q.where("q_norm = 'qqqq wwww'").first()["_tokens"]] == [(0, "tqqqq"), (0, "twwww")]
    q = sim._numbered_grams(q, "q", F.length("q_norm") < 20)
    k = sim._numbered_grams(k, "k")
    keys = {r.q_norm[:2]: r.n for r in sim._join_keys(q, "q", sim._counts(k), 0.15).groupBy("q_norm").count().withColumnRenamed("count", "n").collect()}
    assert "qq" not in keys and sim._join_keys(q, "q", sim._counts(k), 0.15).where("length(q_norm) > 20").select("q_key").first().q_key == "tnaruto"


def test_equal_token_sets_are_compared_once(spark):
    kw, lut = frames(spark, ["b a", "a b", "a  b"], [("a b", "1"), ("b a", "2")])
    named, q, k = sim._sides(kw, lut)
    assert (named.count(), q.count(), k.count()) == (3, 1, 1)
    assert {r.kw: r.key for r in sim.fuzzy_join(kw, lut, min_len=1).collect()} == dict.fromkeys(["b a", "a b", "a  b"], "a b")


def test_a_word_common_to_both_sides_makes_no_pairs(spark):
    kw, lut = frames(spark, [f"the of q{i}xyz" for i in range(30)], [(f"the of k{i}abcdef", "G") for i in range(40)])
    named, q, k = sim._sides(kw, lut, 0.08)
    q, k = sim._numbered_grams(q, "q"), sim._numbered_grams(k, "k")
    counts = sim._counts(k)
    of = lambda df, side: sim._join_keys(df, side, counts, 0.08).where(f"{side}_pos IS NULL")
    assert of(q, "q").join(of(k, "k"), F.col("q_key") == F.col("k_key")).count() == 0


@pytest.mark.parametrize("seed, alphabet", [(1, "abcd"), (2, "ab"), (3, "aăâeêđôơ")])
def test_covered_texts_are_settled_before_any_pair_is_made(spark, seed, alphabet):
    queries, lookup = fixture(seed, alphabet)
    queries = [*queries, "zz", "zz yy"]
    named, q, k = sim._sides(*frames(spark, queries, lookup))
    covered = sim._covered(q, k)
    got = {r.kw: r.key for r in named.join(covered, "q_norm").join(k, "place").collect()}
    first = {x: next((key for key, _ in lookup if (a := {*x.split()}) <= (b := {*key.split()}) or b <= a), None) for x in queries}
    assert got == {x: key for x, key in first.items() if key} and "zz" not in got
    plan = plan_of(covered).partition("(1)")[0]
    assert covered.count() == len({" ".join(sorted({*x.split()})) for x in got}) and plan.count("HashAggregate") == 2 and "Arrow" not in plan


def test_pairs_that_share_a_rare_word_alone_are_dropped_in_the_join(spark):
    kw, lut = frames(spark, [f"word{i} aaaa bbbb cccc dddd" for i in range(20)], [(f"word{i} pppp rrrr ssss vvvv", "G") for i in range(20)])
    named, q, k = sim._sides(kw, lut, 0.08)
    assert sim._candidates(q, k, 0.08).count() == 0


def test_keys_with_an_earlier_key_within_them_are_not_looked_for(spark):
    kw, lut = frames(spark, ["a b x", "c d y"], [("a x", "1"), ("b a", "2"), ("a b x", "3"), ("d c", "4"), ("c", "5"), ("b a x q", "6")])
    named, q, k = sim._sides(kw, lut)
    assert {r.key for r in k.where("leads").collect()} == {"a x", "b a", "d c", "c"}
    assert {r.kw: r.key for r in sim.token_subset_join(kw, lut).collect()} == {"a b x": "a x", "c d y": "d c"}
