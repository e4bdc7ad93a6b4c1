import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tests.conftest import plan_of
from tests.llm.cases import LONG, ODD_ROWS, documents, odd_documents

from trendloom.llm import line_dedup
from trendloom.llm.line_dedup import LineRuns
from trendloom.llm.queries import op12_line_dedup


def plain_key(line: str) -> str:
    return "".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\x0b\x0c\r"))


def plain_report(texts: list, least: int = 10, chars: int = 1) -> list:
    lines = [(t or "").split("\n") for t in texts]
    seen = Counter(k for own in lines for k in {plain_key(x) for x in own} if len(k) >= chars)
    out = []
    for own in lines:
        left = [x for x in own if seen[plain_key(x)] < least]
        out.append((len(own), len(own) - len(left), hashlib.sha256("\n".join(left).encode()).hexdigest()))
    return out


def made(seed: int, n: int = 300) -> list:
    """Texts over few lines, so that many stand in about 10 documents, with one in all."""
    rnd = random.Random(seed)
    pool = [f"line {i} é　" for i in range(150)] + ["", " ", " ", "İ", "ÀB"]
    texts = []
    for _ in range(n):
        own = [rnd.choice(pool) for _ in range(rnd.randint(0, 8))] + ["Common to ALL"]
        texts.append("\n".join(rnd.choice(("", " ", "\t", "\r")) + rnd.choice((x, x.upper() if x.isascii() else x)) + rnd.choice(("", "  ")) for x in own))
    return [*texts, None, "", "\n\n", "x" * 5_000_000 + "\n" + LONG]


@pytest.mark.parametrize("batches,fanout", [(8, 4), (7, 2), (1, 4)])
def test_against_brute_force(spark, batches, fanout):
    texts = made(batches)
    out = line_dedup.without_common_lines(documents(spark, texts), batches=batches, fanout=fanout)
    rows = out.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256)).collect()
    assert [tuple(r)[1:] for r in sorted(rows, key=lambda r: r.doc_id)] == plain_report(texts)


def test_other_limits(spark):
    texts = made(3, 60)
    out = line_dedup.without_common_lines(documents(spark, texts), min_documents=3, min_chars=8)
    rows = out.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256)).collect()
    assert [tuple(r)[1:] for r in sorted(rows, key=lambda r: r.doc_id)] == plain_report(texts, 3, 8)


def test_given_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    rows = sorted(op12_line_dedup(spark, sf_dir).collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in rows] == [r.doc_id for r in table]
    assert [tuple(r)[1:] for r in rows] == plain_report([r.text for r in table]) and any(r.n_dropped for r in rows)


def test_runs_are_levelled_and_bucketed(spark):
    """Levels never hold ``fanout`` runs, settled keys are not counted again, and joins with the runs move no rows."""
    runs = LineRuns(spark, 4, min_documents=3, fanout=3)
    joins = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for turn in range(10):
            rows = [(key, -key, 3 if key == 7 else 1) for key in (*range(turn, turn + 4), 7)]
            batch = spark.createDataFrame(rows, "h1 long, h2 long, documents long").groupBy("h1", "h2").agg(F.sum("documents").alias("documents"))
            batch = spark.table(runs.write(batch.repartition(4, "h1", "h2")))
            runs.add(batch)
            assert all(len(level) < 3 for level in runs.levels)
        assert [len(level) for level in runs.levels] == [1, 0, 1]
        assert {r.h1 for r in runs.common().collect()} == set(range(2, 11))
        settled = spark.table(runs.runs()[-1]).where("documents >= 3")
        plan = plan_of(batch.join(settled, ["h1", "h2"], "left_anti"))
        assert "SortMergeJoin LeftAnti" in plan and "Exchange" not in plan
        assert all(r.h1 != 7 for r in spark.table(runs.levels[0][0]).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", joins)
        runs.clear()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("lines_")]


def test_odd_rows(spark):
    docs = odd_documents(spark).withColumns({c: F.lit("x") for c in ("batch", "lines", "kept", "cut", "h1", "documents")})
    rows = line_dedup.line_report(docs).collect()
    want = plain_report([r[1] for r in ODD_ROWS])
    assert sorted(((r.doc_id is None, r.doc_id or 0), tuple(r)[1:]) for r in rows) == sorted(((r[0] is None, r[0] or 0), w) for r, w in zip(ODD_ROWS, want))
    assert line_dedup.line_report(docs.where("false")).count() == 0
    many = documents(spark, ["Same\nrow"] * 12)
    assert {(r.n_lines, r.n_dropped) for r in line_dedup.line_report(many.withColumn("doc_id", F.lit(1))).collect()} == {(2, 2)}


def test_own_batches(spark):
    texts = made(5, 80)
    docs = documents(spark, texts)
    out = line_dedup.without_common_lines(docs, batches=3, batch=F.col("doc_id") % 3).select("row.doc_id", "n_dropped").collect()
    assert [r.n_dropped for r in sorted(out, key=lambda r: r.doc_id)] == [w[1] for w in plain_report(texts)]
