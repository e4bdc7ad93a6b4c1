import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from tests.llm.cases import WORDS, documents

import corpus_pipeline
from trendloom.llm import suffix_dedup


def brute(texts: list[bytes], length: int):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        mask = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                mask[i : i + length] = b"\1" * length
        runs = sum(1 for i in range(len(mask)) if mask[i] and (i == 0 or not mask[i - 1]))
        kept = bytes(c for c, m in zip(t, mask) if not m)
        out.append((len(t), sum(mask), runs, sha256(kept).hexdigest()))
    return out


def brute_passages(texts: list[str], words: int):
    """Passages of at least so many words that stand in the texts more than once, and their bytes with the space up to the next word."""
    places, seen = [], Counter()
    for t in texts:
        data = t.encode()
        own = [m.span() for m in re.finditer(rb"[^ \t\n\x0b\x0c\r]+", data)]
        lower = [data[a:b].lower() for a, b in own]
        windows = [tuple(lower[i : i + words]) for i in range(len(lower) - words + 1)]
        seen.update(windows)
        places.append((len(data), own, windows))
    out = []
    for size, own, windows in places:
        mask, edges = bytearray(size), [*(a for a, _ in own), size]
        for i, w in enumerate(windows):
            if seen[w] > 1:
                mask[edges[i] : edges[i + words]] = b"\1" * (edges[i + words] - edges[i])
        runs = sum(1 for i in range(size) if mask[i] and (i == 0 or not mask[i - 1]))
        out.append((runs, sum(mask)))
    return out


def planted(seed: int) -> list[str | None]:
    rnd, texts = random.Random(seed), []
    for _ in range(60):
        text = "".join(rnd.choice("ab é") for _ in range(rnd.randint(0, 300)))
        if texts and rnd.random() < 0.5:
            other = rnd.choice(texts)
            a = rnd.randint(0, len(other))
            text = text[:50] + other[a : a + rnd.randint(10, 120)] + text[50:]
        texts.append("a" * rnd.randint(20, 90) if rnd.random() < 0.1 else text)
    return [*texts, *texts[:3], "", None]


@pytest.mark.parametrize("length", [24, 40])
@pytest.mark.parametrize("split_rows", [suffix_dedup.SPLIT_ROWS, 2])
def test_against_brute_force(spark, length, split_rows):
    texts = planted(length)
    got = {r.doc_id: tuple(r)[1:5] for r in suffix_dedup.removal_report(documents(spark, texts), length, split_rows).collect()}
    assert [got[i] for i in range(len(texts))] == brute([(t or "").encode() for t in texts], length)


def test_real_length(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.removal_report(docs).collect()}
    want = brute([(r.text or "").encode() for r in rows], suffix_dedup.LENGTH)
    assert [got[r.doc_id][:4] for r in rows] == want and sum(w[1] for w in want) > 0
    passages = brute_passages([r.text or "" for r in rows], suffix_dedup.PASSAGE_WORDS)
    assert [got[r.doc_id][4:] for r in rows] == passages and sum(w[0] for w in passages) > 0


def test_text_without_repeats(spark):
    passage = "é".join(str(i) for i in range(150))
    docs = documents(spark, [f"start {passage} end", f"other {passage}", "short"])
    left = {r.doc_id: (r.text, r.n_chars) for r in suffix_dedup.without_repeats(docs).collect()}
    assert left == {0: ("start end", 9), 1: ("other", 5), 2: ("short", 5)}


def test_lying_hashes_are_noticed(monkeypatch):
    """If all hashes agreed, the byte comparison would still put the strings in order."""
    strings = [b"xxabcd", b"xxabce", b"yxabcd", b"yxabce", b"yxabce"]
    args = np.full(5, 2), np.full(5, 3), np.zeros(5, np.int64), np.ones(5, np.int64), 3
    want = suffix_dedup.repeated_windows(strings, *args)
    monkeypatch.setattr(suffix_dedup, "substring_hash", lambda prefix, start, length, top: np.zeros(len(start), np.uint64))
    assert suffix_dedup.repeated_windows(strings, *args) == want != []


def test_merge_sort_orders_groups():
    rnd = np.random.default_rng(0)
    group, value = np.sort(rnd.integers(0, 40, 500)), rnd.integers(0, 30, 500)
    order = suffix_dedup.merge_sort(group, lambda i, j: value[i] - value[j])
    assert order.tolist() == np.lexsort((np.arange(500), value, group)).tolist()


def test_passages_of_51_words(spark, sf_dir):
    """The pipeline's stage takes out repeated runs of 51 words, below 400 bytes or in other case and spaces, and no run of 50."""
    rnd = random.Random(4)
    other = lambda n: " ".join(f"x{rnd.randrange(10**6)}" for _ in range(n))
    long, upper, short = ([f"{p}{i}é" for i in range(n)] for p, n in (("a", 51), ("b", 80), ("c", 50)))
    plan = [(7, long, 9), (0, long, 30), (12, upper, 0), (3, [w.upper().replace("É", "é") for w in upper], 4), (5, short, 6), (8, short, 8), (0, long[:30], 0)]
    parts = [(other(a), run, other(b)) for a, run, b in plan]
    texts = [(" " if i != 3 else " \n\t").join([a, *run, b]).strip() for i, (a, run, b) in enumerate(parts)]
    stage = dict(corpus_pipeline.STAGES)["suffix-array dedup"]
    left = {r.doc_id: r for r in stage(spark, documents(spark, [*texts, None, "", " "]), sf_dir).collect()}
    for i, (a, run, b) in enumerate(parts):
        want = texts[i] if i > 3 else f"{a} {b}"
        assert left[i].text.split() == want.split() and left[i].n_chars == len(left[i].text)
    assert [left[i].text for i in (7, 8, 9)] == [None, "", " "] and max(len(" ".join(long).encode()), 0) < 400


def test_word_runs_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r.doc_id: WORDS.findall("".join(c.lower() if c.isascii() else c for c in r.text or "")) for r in docs.collect()}
    seen = Counter(tuple(w[i : i + 51]) for w in rows.values() for i in range(len(w) - 50))
    want = {}
    for doc_id, words in rows.items():
        mask = bytearray(len(words))
        for i in range(len(words) - 50):
            if seen[tuple(words[i : i + 51])] > 1:
                mask[i : i + 51] = b"\1" * 51
        want[doc_id] = [i for i, m in enumerate(mask) if m]
    got = dict.fromkeys(rows, [])
    for r in suffix_dedup.repeated_word_spans(docs).collect():
        got[r.doc_id] = [i for a, b in suffix_dedup.merge_spans(r.spans) for i in range(-(-a // suffix_dedup.CODE), b // suffix_dedup.CODE)]
    assert got == want and any(want.values())


def test_one_python_worker_for_each_task(spark, monkeypatch):
    """No stage of the search for passages has two Python functions, whose workers would stand beside each task at once."""
    plans, staged = [], suffix_dedup.stage
    monkeypatch.setattr(suffix_dedup, "stage", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or staged(df, name))
    texts = [f"{i} " + " ".join(f"w{j}" for j in range(60)) for i in range(3)]
    assert suffix_dedup.repeated_word_spans(documents(spark, texts)).count() == 3
    assert any("MapInArrow" in p for p in plans) and not any("ArrowEvalPython" in p for p in plans)
