import random
from collections import Counter

import numpy as np
from tests.llm.cases import LONG

from trendloom.llm import decontaminate

TOLERANCE = 1e-12


def best_windows(rows, items):
    """(first word, similarity) of the best window of each item in each text, by trying all windows."""
    out = {}
    for doc_id, text in rows:
        words = (text or "").lower().split()
        for item_id, item in items:
            own = (item or "").lower().split()
            width = min(5, len(own))
            count = lambda x: Counter(tuple(x[i : i + width]) for i in range(len(x) - width + 1))  # noqa: B023, E731
            for s in range(len(words) - len(own) + 1) if own else ():
                a, b = count(own), count(words[s : s + len(own)])
                alike = (a & b).total() / (a | b).total()
                if alike >= 0.8 and alike > out.get((doc_id, item_id), (0, 0))[1] + TOLERANCE:
                    out[doc_id, item_id] = (s, alike)
    return out


def test_edited_items(spark, sf_dir):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rnd, rows = random.Random(5), []
    vocabulary = " ".join(t for _, t in items).split()
    for i in range(120):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 120))]
        item = rnd.choice(items)[1].split()
        for _ in range(rnd.randint(0, 3)):
            j = rnd.randrange(len(item))
            item[j : j + rnd.randint(0, 1)] = rnd.choice([[], [rnd.choice(vocabulary)]])
        at = rnd.randint(0, len(words))
        rows.append((i, " ".join(words[:at] + item + words[at:])))
    items += [(1000, "one two"), (1001, ""), (1002, None)]
    rows += [(200, "x One two y one two"), (201, None), (202, "")]
    hits = decontaminate.contamination(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(h.doc_id, h.item_id): (h.first_word, round(h.similarity, 9)) for h in hits.collect()}
    assert got == {k: (s, round(a, 9)) for k, (s, a) in best_windows(rows, items).items()} and len(got) > 20


def test_index_returns_all_within_the_radius():
    rnd = np.random.default_rng(1)
    index = decontaminate.ItemIndex([(i, " ".join(str(rnd.integers(1000)) for _ in range(12))) for i in range(300)])
    flips = [sum(1 << int(b) for b in rnd.choice(64, rnd.integers(0, 25), replace=False)) for _ in range(300)]
    prints = index.prints ^ np.array(flips, np.uint64)
    want = {(w, i) for w in range(300) for i in range(300) if int(prints[w] ^ index.prints[i]).bit_count() <= decontaminate.RADIUS}
    assert {(w, i) for w, i, _ in index.probe(prints, 12)} == want


def test_long_text_in_pieces(monkeypatch):
    text = (LONG + "a b\tC").encode()
    want = decontaminate.word_hashes(text)
    monkeypatch.setattr(decontaminate, "_PIECE", 1000)
    assert np.array_equal(decontaminate.word_hashes(text), want) and len(want) == len(text.split())


def test_many_items_go_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 2)
    items = spark.createDataFrame([(i, f"w{i} x{i} y{i} z{i} v{i} u{i}") for i in range(9)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"a w{i} x{i} y{i} z{i} v{i} u{i} b") for i in range(12)], "doc_id long, text string")
    assert sorted((h.doc_id, h.item_id) for h in decontaminate.contamination(docs, items).collect()) == [(i, i) for i in range(9)]
    assert sorted(r.doc_id for r in decontaminate.without_leaks(spark, docs, items).collect()) == [9, 10, 11]


def test_documents_shorter_than_an_item(spark):
    """Against brute force with the whole document as the window wherever it has fewer words than the item."""
    rnd, items, rows = random.Random(8), [], []
    for i in range(30):
        words = [f"w{rnd.randrange(300)}" for _ in range(rnd.randint(6, 80))]
        items.append((i, " ".join(words)))
        for cut in (1, 3, rnd.randint(1, len(words) // 4 + 1)):
            rows += [(len(rows), " ".join(words[cut:])), (len(rows) + 1, " ".join(words[:-cut]).upper())]
        changed = words[1:]
        changed[rnd.randrange(len(changed))] = "other"
        rows.append((len(rows), " ".join(changed)))
    want = best_windows(rows, items)
    for doc_id, text in rows:
        words = text.lower().split()
        for item_id, item in items:
            own = item.split()
            count = lambda x: Counter(tuple(x[i : i + 5]) for i in range(len(x) - 4))
            if len(words) < len(own) and (alike := (count(own) & count(words)).total() / (count(own) | count(words)).total()) >= 0.8:
                want[doc_id, item_id] = (0, alike)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    hits = decontaminate.contamination(docs, benchmark).collect()
    assert {(h.doc_id, h.item_id): (h.first_word, round(h.similarity, 9)) for h in hits} == {k: (s, round(a, 9)) for k, (s, a) in want.items()}
    assert len(hits) > 80 and all(h.n_words == min(len(rows[h.doc_id][1].split()), len(items[h.item_id][1].split())) for h in hits)
    left = decontaminate.without_leaks(spark, docs, benchmark).collect()
    assert {r.doc_id for r in left} == {i for i, _ in rows} - {h.doc_id for h in hits}
