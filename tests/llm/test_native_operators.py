"""Chat formatting, quality rules and license scans: SQL twins, plans and cases the test tables lack."""

import math

import pytest
from pyspark.sql import functions as F
from tests.conftest import plan_of
from tests.llm.cases import documents

from scripts.check_oracles import connect, rows_of
from trendloom.llm import chat_format, licenses, quality_rules
from trendloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", ORACLES)
def test_sql_twin(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert not any(word in plan_of(df) for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
    cursor = connect(sf_dir).execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, cursor.fetchall())


def test_conversations_round_trip(spark):
    nasty = ["</s>", "[INST]", "[/INST][/INST]", "\\", "\\\\[INST", "<s>\\<s>", "a\nb", "", "é\U0001f600", "[", "/INST]", "<\\s>", "$1 \\$"]
    roles = ["user", "assistant", "assistant", "sys[INST]\n", "assistant"]
    rows = [(1, i, roles[i % 5], nasty[i % len(nasty)]) for i in range(700)] + [(2, 0, "assistant", "x"), (3, 5, "user", None)]
    out = chat_format.formatted_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).cache()
    read = out.select("conv_id", chat_format.read_turns(F.col("formatted")).alias("turns"), chat_format.read_learned(F.col("formatted"), F.col("loss_spans")).alias("learned"), "formatted")
    for r in read.collect():
        want = [(role, text or "") for c, _, role, text in rows if c == r.conv_id]
        assert [tuple(t) for t in r.turns] == want
        assert r.learned == "".join(text for role, text in want if role == "assistant")
    assert out.where("conv_id = 2").first().formatted == "<s>[INST]assistant[/INST]x</s>"


def test_binomial_bound(spark):
    cases = [(0, 10), (3, 400), (4, 400), (0, 596), (20, 3000), (5, 100)]
    frame = spark.createDataFrame(cases, "k long, n long").select("k", "n", quality_rules.log_binomial_cdf(F.col("k"), F.col("n"), 0.01).alias("p"))
    for r in frame.collect():
        exact = math.log(sum(math.comb(r.n, j) * 0.01**j * 0.99 ** (r.n - j) for j in range(r.k + 1)))
        assert r.p == pytest.approx(exact if r.k <= 0.01 * r.n else 0.0, abs=1e-9)


def test_cutoffs_keep_the_promise(spark):
    """1 in 500 good texts of stratum a has a symbol share of 0.16, all others 0.01; stratum b is too small for any cutoff."""
    rows = spark.range(20000).selectExpr("'a' AS stratum", "if(id % 500 = 0, 0.16, 0.01) AS symbol_share").unionByName(
        spark.range(300).selectExpr("'b' AS stratum", "0.01D AS symbol_share").withColumn("symbol_share", F.col("symbol_share"))
    )
    values = rows.withColumns({rule: F.lit(0.0) for rule in quality_rules.CUTOFFS if rule != "symbol_share"})
    chosen = {r.stratum: r.cutoffs for r in quality_rules.choose_cutoffs(values).collect()}
    assert set(chosen) == {"a"} and chosen["a"]["symbol_share"] == 0.02
    often = values.withColumn("symbol_share", F.when(F.col("symbol_share") > 0.1, 0.16).otherwise(F.when(F.rand(1) < 0.02, 0.16).otherwise(0.01)))
    chosen = {r.stratum: r.cutoffs for r in quality_rules.choose_cutoffs(often).collect()}
    assert chosen["a"]["symbol_share"] == 0.2


def test_measures(spark):
    text = "A b c a b c a b c\n\nline one\nline one\n \nLine one\n$$ <x> |"
    row = quality_rules.base_measures(documents(spark, [text])).first()
    assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_lines) == (18, 36, 5, 1, 5)
    assert row.n_repeat_words == 8  # "b c a", "c a b" and "b c a b c" overlap in words 2 to 9


def test_license_lines(spark):
    texts = [
        "RELEASED, under the (MIT) license!",  # template words in another order and case
        "license mit the under",  # 4 of 5 tokens
        "mit license",  # too few
        "under the mit\nlicense cc-by-nc",  # base phrases across lines
        "this wor\u212a is licensed under the gnu general public license version 3",  # the Kelvin sign is no k
        "all rights\nreserved", "x" * 50_000 + " all rights reserved",
    ]
    got = {r.doc_id: (r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 4)) for r in licenses.scanned(documents(spark, texts)).collect()}
    assert got[0] == (1, 1, 1, "mit", "mit", 1.0)
    assert got[1] == (0, None, None, "", "", 0.0)
    assert got[2] == (0, None, None, "", "", 0.0)
    assert got[3] == (2, 0, 4, "cc-by-nc,mit", "cc-by-nc,mit", 1.0)
    assert got[4][4:] == ("", 0.0)
    assert got[5][4:] == ("", 0.0) and got[6][4:] == ("rights-reserved", 1.0)
    loose = {r.doc_id: (r.labels, round(r.score, 4)) for r in licenses.scanned(documents(spark, texts), 0.8).collect()}
    assert loose[1] == ("mit", 0.8) and "gpl-3" in loose[4][0] and loose[4][1] == round(11 / 12, 4) and loose[2] == ("", 0.0)
