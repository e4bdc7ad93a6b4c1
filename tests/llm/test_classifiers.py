"""Language, toxicity and quality: exact code lengths, held-out accuracy, and what must not matter."""

from collections import defaultdict
from math import log2

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.cases import LONG

from trendloom.llm import language_id, quality_gam, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    read = lambda t: spark.read.parquet(f"{SF}/{t}.parquet")
    return read("documents"), read("labels")


def plain_code_length(training: list[bytes], text: bytes, least: int = 1) -> float:
    """Bits of a text by prediction by partial matching with escapes by kinds, from a dictionary of contexts."""
    contexts = defaultdict(lambda: defaultdict(int))
    for t in training:
        padded = b"\n\n\n" + t
        for i in range(3, len(padded)):
            for k in range(4):
                contexts[padded[i - k : i]][padded[i]] += 1
    bits, padded = 0.0, b"\n\n\n" + text
    for i in range(3, len(padded)):
        for k in (3, 2, 1, 0):
            seen = contexts.get(padded[i - k : i])
            if seen is None:
                continue
            total = sum(seen.values()) + len(seen)
            kept = {b: n for b, n in seen.items() if n >= least}
            if not kept:
                continue
            if padded[i] in kept:
                bits -= log2(kept[padded[i]] / total)
                break
            bits -= log2(max(1 - sum(kept.values()) / total, 2.0**-40))
        else:
            bits += 8
    return bits


@pytest.mark.parametrize("least", [1, 2, 4])
def test_code_lengths(spark, least):
    """Whole, and without what was seen less than twice or four times."""
    texts = {"en": ["the cat and the hat", "that is the thing"], "xx": ["zzy yzz zyzzy", "übü übü"]}
    rows = [(i, t, lang) for lang, ts in texts.items() for i, t in enumerate(ts * 3)]
    docs = spark.createDataFrame([(i * 2 + (lang == "xx"), t, lang) for i, t, lang in rows], "doc_id long, text string, lang string")
    kept = docs.where(~language_id.held_out(3, 1)).collect()
    model = language_id.languages_of(language_id.train(docs, least), ["en", "xx"])
    for text in ("the zzy", "ü", "unseen words: 123"):
        want = [plain_code_length([r.text.encode() for r in kept if r.lang == name], text.encode(), least) for name in model.names]
        assert np.allclose(model.code_lengths(text.encode()) / language_id.UNIT, want, atol=0.01)


def test_pieces_do_not_change_codes(monkeypatch):
    text = LONG.encode()[:5000]
    want = np.concatenate(list(language_id.grams(text)))
    monkeypatch.setattr(language_id, "_PIECE", 100)
    assert np.array_equal(np.concatenate(list(language_id.grams(text))), want)
    grams = toxicity.gram_hashes(LONG)
    monkeypatch.setattr(toxicity, "_PIECE", 1000)
    assert np.array_equal(toxicity.gram_hashes(LONG), grams)


def test_languages(tables):
    docs, _ = tables
    rows = language_id.identified(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert {r.held_out for r in rows} == {True, False}
    assert sum(r.lang == r.lang_pred for r in rows if r.held_out) >= 0.98 * sum(r.held_out for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_languages_in_several_passes(spark, tables):
    """With room for few entries every language is scored in a pass of its own; nothing else changes."""
    docs, _ = tables
    some = docs.where("doc_id % 9 = 0").unionByName(docs.limit(3)).withColumn("lang", F.expr("if(doc_id % 2 = 0, lang || '-x', lang)"))
    assert language_id.passes({"b": 5, "a": 1, "c": 2, "d": 9}, 6) == [["a", "b"], ["c"], ["d"]] and language_id.passes({}) == []
    key = lambda rows: sorted((r.doc_id, r.held_out, r.lang_pred, round(r.score, 9)) for r in rows)
    one, many = language_id.identified(some).collect(), language_id.identified(some, most_entries=10).collect()
    assert key(one) == key(many) and len({r.lang_pred for r in one}) > 4


@pytest.mark.parametrize("scored, label, least", [(toxicity.scored, "toxic", 0.92), (quality_gam.scored, "quality", 0.95)])
def test_held_out_accuracy(tables, scored, label, least):
    docs, labels = tables
    # Neither the held-out labels nor language, source and id may matter.
    hidden = labels.withColumn(label, F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, 1 - F.col(label)).otherwise(F.col(label)))
    changed = docs.withColumns({"lang": F.lit("x"), "source": F.lit(None).cast("string")})
    rows = {r.doc_id: tuple(r) for r in scored(docs, labels).collect()}
    assert rows == {r.doc_id: tuple(r) for r in scored(changed, hidden).collect()}
    truth = {r.doc_id: r[label] for r in labels.collect()}
    held = [(predicted, truth[i]) for i, held_out, _, predicted in rows.values() if held_out and i in truth]
    assert sum(a == b for a, b in held) >= least * len(held) > 0


def test_one_kind_of_label(spark, tables):
    docs, labels = tables
    some = docs.limit(20)
    assert {r.predicted for r in toxicity.scored(some, labels.withColumn("toxic", F.lit(0))).collect()} == {0}
    assert {r.predicted for r in quality_gam.scored(some, labels.withColumn("quality", F.lit(1))).collect()} == {1}
    assert {r.predicted for r in quality_gam.scored(some, labels.where("false")).collect()} == {0}


def test_trees_find_an_interaction():
    rnd = np.random.default_rng(2)
    x = rnd.random((4000, len(quality_gam.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x, y)
    assert (0, 1) in model.pairs and ((model.scores(x) > 0.5) == y).mean() > 0.9


def plain_grams(text: str) -> set:
    padded = f" {text.lower()} "
    return {padded[i : i + n] for n in (3, 4, 5) for i in range(len(padded) - n + 1)}


def plain_model(texts: list, labels: list) -> tuple:
    """Ratios of all significant n-grams, and the regression on them by Newton steps, from the definition."""
    sets, y = [plain_grams(t) for t in texts], np.array(labels, float)
    pos, neg = int(y.sum()), int((1 - y).sum())
    ratio = {}
    for g in set().union(*sets):
        a, b = sum(g in s for s, v in zip(sets, y) if v), sum(g in s for s, v in zip(sets, y) if not v)
        r = np.log((a + 1) / (pos + 2)) - np.log((b + 1) / (neg + 2))
        if abs(r) / np.sqrt(1 / (a + 1) + 1 / (b + 1)) >= toxicity.LEAST_Z:
            ratio[g] = r
    names = sorted(ratio)
    x = np.array([[ratio[g] * (g in s) for g in names] + [1.0] for s in sets])
    ridge = np.diag([toxicity.RIDGE] * len(names) + [0.0])
    w = np.zeros(len(names) + 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        slope, curve = x.T @ (p - y) / len(y) + ridge @ w, (x * (p * (1 - p))[:, None]).T @ x / len(y) + ridge
        w -= np.linalg.solve(curve + 1e-12 * np.eye(len(w)), slope)
    return names, ratio, w, x @ w


def test_toxicity_against_its_definition(spark):
    """All significant n-grams are features, with ratios from all labelled texts; scores are those of the regression's optimum."""
    rnd = np.random.default_rng(8)
    bad, good = ["vile", "nasty"], [f"w{i}" for i in range(40)]
    texts, marks = [], []
    for i in range(240):
        words = list(rnd.choice(good, 12))
        toxic = i % 4 == 0
        if toxic != (rnd.random() < 0.08):
            words.insert(int(rnd.integers(12)), bad[i % 2])
        texts.append(" ".join(words))
        marks.append(int(toxic))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame(list(enumerate(marks)), "doc_id long, toxic int")
    seen = {r.doc_id for r in labels.where(~toxicity.held_out(toxicity.FOLDS, toxicity.HELD_OUT_FOLD)).collect()}
    names, ratio, w, _ = plain_model([texts[i] for i in sorted(seen)], [marks[i] for i in sorted(seen)])
    model = toxicity.train(docs, labels)
    assert len(model.features) == len(names) > 5
    for text in (*texts[:30], "", "vile and nasty", "nothing of the kind"):
        logit = w[-1] + sum(w[k] * ratio[g] for k, g in enumerate(names) if g in plain_grams(text))
        assert model.score(text) == pytest.approx(1 / (1 + np.exp(-logit)), abs=2e-3)


def test_fit_against_newton_steps(monkeypatch):
    """The solver's point is the optimum, in one block of rows or in many, rows without any feature included."""
    rnd = np.random.default_rng(3)
    rows = [np.flatnonzero(rnd.random(12) < 0.25).astype(np.int32) for _ in range(300)] + [np.zeros(0, np.int32)] * 3
    ratio = rnd.normal(size=12) * 2
    y = np.array([float(rnd.random() < 1 / (1 + np.exp(-ratio[r].sum() / 3 + 0.5))) for r in rows])
    x = np.zeros((len(rows), 13))
    for i, r in enumerate(rows):
        x[i, r], x[i, 12] = ratio[r], 1
    w, ridge = np.zeros(13), np.diag([toxicity.RIDGE] * 12 + [0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x / len(y) + ridge, x.T @ (p - y) / len(y) + ridge @ w)
    for entries in (1 << 20, 10, 1):
        monkeypatch.setattr(toxicity, "_ENTRIES", entries)
        loss = toxicity.Loss(y, rows, ratio)
        assert sum(len(b[0]) for b in loss.blocks) == len(rows) and (entries > 10) == (len(loss.blocks) == 1)
        assert np.allclose(toxicity.least_point(loss, 13), w, atol=1e-4)


def test_toxicity_recall_and_precision(spark):
    """Held-out documents of the larger table; about one toxic label in six has no sign of it in its text."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.scored(docs, labels).where("held_out").join(labels.where("toxic IS NOT NULL"), "doc_id").select("predicted", "toxic").collect()
    hit, found, toxic = sum(r.predicted and r.toxic for r in rows), sum(r.predicted for r in rows), sum(r.toxic for r in rows)
    assert toxic > 50 and hit >= 0.75 * toxic and hit >= 0.85 * found
