import re

import pytest
from pyspark.sql import functions as F
from tests.llm.cases import WORDS, documents
from tests.llm.test_near_copies import plain_kept

import corpus_pipeline
from trendloom.llm import decontaminate, mixing, toxicity


def plain_targets(sizes: dict) -> dict:
    """Share out 150 % by weight; whoever is above twice its size stops there and the rest is shared again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    fixed, open_ = {}, set(names)
    while open_:
        left, total = 1.5 * sum(sizes.values()) - sum(fixed.values()), sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        if not above:
            return fixed | {s: left * weight[s] / total for s in open_}
        fixed |= {s: 2.0 * sizes[s] for s in above}
        open_ -= above
    return fixed


def test_mixture(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("source", F.expr("if(source = 'src3', null, source)"))
    rows = mixing.mixture(docs).collect()
    text = {r.doc_id: r for r in docs.collect()}
    sizes, taken = {}, {}
    for r in rows:
        assert r.size == len(WORDS.findall(text[r.doc_id].text or "")) and 0 <= r.taken <= 2 * r.size
        source = text[r.doc_id].source
        sizes[source] = sizes.get(source, 0) + r.size
        taken[source] = taken.get(source, 0) + r.taken
    want = plain_targets(sizes)
    for r in rows:
        source = text[r.doc_id].source
        assert r.source_size == sizes[source] and r.target == pytest.approx(want[source])
    assert all(abs(taken[s] - want[s]) <= 0.02 * want[s] for s in want)
    again = mixing.mixture(docs.repartition(5)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_one_hot_size(spark, monkeypatch):
    """Very many documents of one size are dealt into parts and still add up to the copies of the size."""
    monkeypatch.setattr(mixing, "PART_ROWS", 50)
    docs = documents(spark, ["one two three"] * 900 + [f"w{i} " * (i + 1) for i in range(60)])
    rows = mixing.mixture(docs).collect()
    target = {(r.source_size, r.target) for r in rows}
    assert abs(sum(r.taken for r in rows) - sum(t for _, t in target)) < 10
    assert all(r.taken in (0, r.size, 2 * r.size) for r in rows)


def test_rates_are_tilted_by_size(spark):
    """A source short of its target gives more copies of long documents, relative to their size, than of short ones."""
    counts = spark.createDataFrame([("a", 10, 100), ("a", 100, 100), ("b", 10, 100)], "source string, size long, n long")
    goals = spark.createDataFrame([("a", 11000, 16000.0), ("b", 1000, 2000.0)], "source string, source_size long, target double")
    tilt = {r.source: r.tilt for r in mixing.solve(counts, goals).collect()}
    rate = lambda size: 2 / (1 + 2.718281828459045 ** (-tilt["a"] * size / 55))
    assert tilt["b"] == float("inf") and tilt["a"] > 0
    assert 100 * (10 * rate(10) + 100 * rate(100)) == pytest.approx(16000, rel=1e-4)


def plain_cut(texts: list[str], words: int = 51, size: int = 400) -> list[str]:
    """The texts without what lies in a run of ``words`` words, A-Z as a-z, or of ``size`` bytes, that stands in them more than once."""
    found, seen = [], {}
    for i, text in enumerate(texts):
        places = [m.span() for m in re.finditer(rb"[^ \t\n\x0b\x0c\r]+", text.encode())]
        lower = [text.encode()[a:b].lower() for a, b in places]
        found.append(places)
        for at in range(len(places) - words + 1):
            seen.setdefault((*lower[at : at + words],), []).append((i, at))
    gone = [bytearray(b) for b in (bytes(len(t.encode())) for t in texts)]
    for places in seen.values():
        for i, at in places if len(places) > 1 else ():
            a, b = found[i][at][0], [*found[i], (len(gone[i]),)][at + words][0]  # with the space up to the next word
            gone[i][a:b] = b"\1" * (b - a)
    starts = {}
    for i, text in enumerate(texts):
        data = text.encode()
        for at in range(len(data) - size + 1):
            starts.setdefault(data[at : at + size], []).append((i, at))
    for places in starts.values():
        for i, at in places if len(places) > 1 else ():
            gone[i][at : at + size] = b"\1" * size
    return [bytes(b for b, g in zip(t.encode(), out) if not g).decode() for t, out in zip(texts, gone)]


def test_pipeline(spark, sf_dir):
    """Each stage against brute force on the rows it was given."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    given = {name: None for name, _ in corpus_pipeline.STAGES}
    for name, step in corpus_pipeline.STAGES:
        given[name] = {r.doc_id: r for r in docs.collect()}
        assert docs.columns == columns
        out = step(spark, docs, sf_dir)
        docs = spark.createDataFrame(out.collect(), out.schema)
    toxic, near, repeats, leaks, mix = given.values()
    labels, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("labels", "benchmark"))
    scores = toxicity.scored(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels).collect()
    assert set(near) == {r.doc_id for r in scores if not r.predicted}
    assert set(repeats) == plain_kept({i: r.text for i, r in near.items()})
    assert [r.text for r in leaks.values()] == plain_cut([repeats[i].text for i in leaks]) and set(leaks) == set(repeats)
    assert all(r.n_chars == len(r.text) for r in leaks.values())
    index = decontaminate.ItemIndex([(r.item_id, r.text) for r in benchmark.collect()])
    assert set(mix) == {i for i, r in leaks.items() if not index.find(r.text.encode(), 0.8)}
    final = docs.collect()
    assert {r.doc_id for r in final} <= set(mix) and all(r.taken == r.copies * r.size > 0 for r in final)
    assert [f.name for f in docs.schema][: len(columns)] == columns
