import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import plan_of

from trendloom.operators import skew
from trendloom.operators.sessions import with_repeat_flag


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_rank_matches_the_window(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), rng.choice([None, "x"]), rng.randrange(6), i) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, p string, v bigint, i int")
    window = Window.partitionBy("g", "p").orderBy(F.desc("v"))
    expected = df.withColumn("r", F.rank().over(window).cast("bigint"))
    assert rows_of(skew.rank_desc(df, ["g", "p"], "v", "r")) == rows_of(expected)
    limited = skew.rank_desc(df, ["g", "p"], "v", "r", limit=30)
    assert rows_of(limited) == rows_of(expected.where("r <= 30"))
    assert limited.count() > 0


def test_row_numbers_match_the_window(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(50), f"{i:03d}") for i in range(300)]
    df = spark.createDataFrame(rows, "g string, t int, i string")
    expected = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("t", "i")).cast("bigint"))
    assert rows_of(skew.row_number_in_slices(df, ["g"], ["t", "i"], F.floor(F.col("t") / 7), "n")) == rows_of(expected)


def test_salted_join_matches_the_plain_join(spark):
    rng = random.Random(3)
    facts = spark.createDataFrame(
        [(rng.choice(["hot"] * 8 + ["a", "b", None]), i) for i in range(400)], "k string, i int"
    )
    dim = spark.createDataFrame([("hot", 1, 280), ("a", 2, 40), ("z", 3, 0)], "k string, v int, n bigint")
    expected = facts.join(dim, "k", "left")
    for min_rows in (100, 1, None):
        got = skew.salted_left_join(facts, dim, "k", F.col("i"), dim_rows="n", min_rows=min_rows)
        assert rows_of(got.select(expected.columns)) == rows_of(expected)


def test_any_number_of_hot_keys(spark):
    """All of 1,500 keys are split, as all have as many rows as it takes."""
    facts = spark.range(6000).select((F.col("id") % 1500).cast("string").alias("k"), "id")
    dim = spark.range(1500).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("v"), F.lit(4).cast("long").alias("n"))
    got = skew.salted_left_join(facts, dim, "k", F.col("id"), dim_rows="n", min_rows=2)
    assert got.where("v = 2 * cast(k as long)").count() == 6000


def sessions(spark, seed=4, n=400):
    rng = random.Random(seed)
    rows = [
        (f"{i:04d}", rng.randrange(0, 900), rng.choice(["s1", "s1", "s1", "s2", "s3", None]), rng.choice(["a", "b", None]))
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "event_id string, sec long, search_session_id string, keyword_norm string")
    return rows, df.withColumn("event_ts", F.timestamp_seconds("sec")).withColumn("user_is_authenticated", F.col("search_session_id") == "s2")


def brute_force(rows, isolated=False):
    last, out = {}, {}
    for event, sec, session, keyword in sorted(rows, key=lambda r: (r[1], r[0])):
        key = session if session is not None or not isolated else ("alone", event)
        before = last.get(key)
        out[event] = None if keyword is None or before is None else keyword == before
        if keyword is not None:
            last[key] = keyword
    return out


def test_repeat_flag_with_and_without_shared_sessions(spark):
    rows, df = sessions(spark)
    for shared in (None, F.lit(False), F.lit(True), F.lit(None).cast("boolean")):
        flagged = with_repeat_flag(df, shared=shared)
        assert {r.event_id: r.is_repeat_search for r in flagged.collect()} == brute_force(rows)
        assert "SinglePartition" not in plan_of(flagged) and "approx_top_k" not in plan_of(flagged)
    alone = with_repeat_flag(df, null_sessions="isolated")
    assert {r.event_id: r.is_repeat_search for r in alone.collect()} == brute_force(rows, isolated=True)


def test_repeat_flag_example(spark):
    rows = [(str(i), i, "s", k) for i, k in enumerate(["a", None, "a", "b"])]
    df = spark.createDataFrame(rows, "event_id string, sec long, search_session_id string, keyword_norm string")
    flagged = with_repeat_flag(df.withColumn("event_ts", F.timestamp_seconds("sec")).withColumn("user_is_authenticated", F.lit(True)))
    assert [r.is_repeat_search for r in flagged.orderBy("event_id").collect()] == [None, None, True, False]
