"""Nulls, empty and very long texts, repeated rows, empty tables and clashing columns for every operator."""

import pytest
from tests.llm.cases import ODD_ROWS, odd_documents, odd_labels

import corpus_pipeline
from trendloom.llm import chat_format, decontaminate, language_id, licenses, mixing, quality_gam, quality_rules, simhash_dedup, suffix_dedup, toxicity

PER_DOCUMENT = {
    "language": lambda spark, d: language_id.identified(d),
    "toxicity": lambda spark, d: toxicity.scored(d, odd_labels(spark)),
    "repeats": lambda spark, d: suffix_dedup.removal_report(d),
    "near copies": lambda spark, d: simhash_dedup.near_duplicates(d),
    "rules": lambda spark, d: quality_rules.judged(d, odd_labels(spark)),
    "licenses": lambda spark, d: licenses.scanned(d),
    "quality": lambda spark, d: quality_gam.scored(d, odd_labels(spark)),
    "mix": lambda spark, d: mixing.mixture(d),
}


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_one_row_each(spark, name):
    docs = odd_documents(spark)
    rows = PER_DOCUMENT[name](spark, docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted((r[0] is None, r[0] or 0) for r in ODD_ROWS)
    assert PER_DOCUMENT[name](spark, docs.where("false")).count() == 0


def test_defined_results(spark):
    docs = odd_documents(spark)
    lang = {(r.doc_id, r.lang_pred, r.score) for r in language_id.identified(docs).where("doc_id in (2, 3, 4)").collect()}
    assert lang == {(2, "und", 0.0), (3, "und", 0.0), (4, "und", 0.0)}
    near = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash_dedup.near_duplicates(docs).collect()]
    assert {x for x in near if x[1] == "0" * 16} == {(i, "0" * 16, 2) for i in (2, 3, 4, None)}
    assert {x[2] for x in near if x[0] in (5, 6)} == {5}
    removed = {(r.doc_id, r.n_bytes, r.n_removed) for r in suffix_dedup.removal_report(docs).where("doc_id in (2, 3, 5, 6, 7)").collect()}
    size = len(ODD_ROWS[8][1])
    assert removed == {(2, 0, 0), (3, 0, 0), (5, size, size), (6, size, size), (7, len(ODD_ROWS[10][1].encode()), 0)}
    rules = {r.doc_id: (r.n_words, r.base_failed, r.kept) for r in quality_rules.judged(docs, odd_labels(spark)).where("doc_id in (2, 5)").collect()}
    assert rules == {2: (0, True, False), 5: (42000, True, False)}
    taken = {r.doc_id: (r.size, r.taken) for r in mixing.mixture(docs).where("doc_id in (2, 3, 4)").collect()}
    assert taken == {2: (0, 0), 3: (0, 0), 4: (0, 0)}


def test_contamination(spark):
    items = spark.createDataFrame([(1, "same few words again and again the"), (1, "same few words again and again the"), (2, None), (3, ""), (None, "ONE")], "item_id long, text string")
    docs = odd_documents(spark)
    hits = decontaminate.contamination(docs, items.withColumn("size", items["item_id"])).collect()
    assert sorted((h.doc_id, h.item_id or 0, h.first_word, h.similarity) for h in hits) == [(-8, 0, 0, 1.0), (5, 1, 1, 1.0), (6, 1, 1, 1.0)]
    assert decontaminate.contamination(docs.where("false"), items).count() == 0
    assert decontaminate.contamination(docs, items.where("false")).count() == 0
    left = decontaminate.without_leaks(spark, docs, items)
    assert left.columns == docs.columns and left.count() == len(ODD_ROWS) - 3


def test_conversations(spark):
    rows = [(1, None, "user", "x"), (1, 0, None, None), (None, 1, "assistant", "\\"), (1, 0, None, None), (2, 300, "assistant", ""), (2, -1, "assistant", "a")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = turns.withColumns({c: turns["turn"] for c in ("chunk", "turns", "part", "formatted")})
    got = {r.conv_id: (r.n_turns, r.loss_chars) for r in chat_format.digests(chat_format.formatted_conversations(turns)).collect()}
    assert got == {1: (3, 0), None: (1, 1), 2: (2, 1)}
    assert chat_format.formatted_conversations(turns.where("false")).count() == 0


def test_stages_keep_columns(spark, tmp_path):
    docs = odd_documents(spark)
    odd_labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "no such text anywhere")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, docs, str(tmp_path))
        assert step(spark, docs.where("false"), str(tmp_path)).count() == 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            assert out.count() <= len(ODD_ROWS)
