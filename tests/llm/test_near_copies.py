import random
from itertools import combinations

import numpy as np
from tests.llm.cases import WORDS, documents, odd_documents

import corpus_pipeline
from trendloom.llm import near_copies


def plain_shingles(text: str) -> set:
    words = WORDS.findall("".join(c.lower() if c.isascii() else c for c in text))
    return {" ".join(words[i : i + 5]) for i in range(len(words) - 4)} or {" ".join(words)}


def plain_kept(texts: dict) -> set:
    """The smallest id of each component of texts whose shingles have a Jaccard similarity of 0.8, by all pairs."""
    root, sets = {i: i for i in texts}, {i: plain_shingles(t or "") for i, t in texts.items()}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(sorted(texts), 2):
        if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return {find(i) for i in texts}


def edited(seed: int) -> dict:
    """Groups of texts that differ in a few words, so that many pairs are just above or below 0.8; two of the groups are large."""
    rnd, texts = random.Random(seed), []
    vocabulary = [f"w{i}" for i in range(400)]
    for group in range(60):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randint(3, 200))]
        for _ in range(80 if group < 2 else rnd.randint(1, 4)):
            words = list(base)
            for _ in range(rnd.randint(0, 1 + len(base) // 40)):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            texts.append(" ".join(words))
    return dict(enumerate([*texts, "", None, " \n", "One two", "one  TWO"]))


def test_recall_against_all_pairs(spark):
    texts = edited(7)
    got = {r.doc_id for r in near_copies.one_of_each(documents(spark, list(texts.values()))).collect()}
    assert got == plain_kept(texts) and len(got) < len(texts) - 100


def test_pipeline_stage_drops_near_copies(spark, sf_dir):
    """On the given table some pairs of different texts reach 0.8 whose fingerprints are more than 3 bits apart."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id for r in dict(corpus_pipeline.STAGES)["SimHash near-dedup"](spark, docs, sf_dir).collect()} == plain_kept(texts)


def test_odd_rows(spark):
    rows = near_copies.one_of_each(odd_documents(spark)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == [(False, -8), (False, 1), (False, 1), (False, 2), (False, 5), (False, 7), (True, 0)]


def test_keys_of_pairs_at_the_threshold():
    rnd = np.random.default_rng(2)
    for n in (9, 90, 5000):
        for _ in range(60):
            own = rnd.integers(0, 2**63, n * 10 // 9, dtype=np.uint64)
            a, b = np.unique(own[: n]), np.unique(own[len(own) - n :])
            assert near_copies.similarity(a, b) >= 0.79 and (near_copies.band_keys(a) == near_copies.band_keys(b)).any()


def relatives(n: int, words: int, changed: int, seed: int = 1) -> list:
    """Texts made from one by changing some words each, to words of their own."""
    rnd, base = random.Random(seed), [f"w{i}" for i in range(words)]
    out = []
    for k in range(n):
        own = list(base)
        for j in rnd.sample(range(words), changed):
            own[j] = f"x{k}-{j}"
        out.append(" ".join(own))
    return out


def test_relatives_below_the_threshold_make_few_rows(spark, monkeypatch):
    """800 texts, four words of 120 changed in each: every pair shares keys, none reaches 0.8, few become rows."""
    counted, all_pairs = [], near_copies._all_pairs
    monkeypatch.setattr(near_copies, "_all_pairs", lambda *a: counted.append(all_pairs(*a).count()) or all_pairs(*a))
    texts = relatives(800, 120, 4)
    assert near_copies.one_of_each(documents(spark, texts)).count() == len(plain_kept(dict(enumerate(texts))))
    assert counted[0] < 3 * 800


def test_bitmaps_never_rule_out_a_similar_pair(spark):
    rnd = np.random.default_rng(3)
    rows = []
    for n in (1, 2, 9, 90, 700, 5000):
        for _ in range(60):
            own = rnd.integers(0, 2**63, max(1, n * 10 // 9), dtype=np.uint64)
            a, b = np.unique(own[:n]), np.unique(own[len(own) - n :])
            rows.append((len(a), near_copies.bitmap(a).tolist(), len(b), near_copies.bitmap(b).tolist(), near_copies.similarity(a, b)))
    df = spark.createDataFrame(rows, "n long, bits array<long>, m long, others array<long>, s double")
    df = df.selectExpr("struct(n, bits) AS a", "struct(m AS n, others AS bits) AS b", "s").withColumn("ok", near_copies._can_reach("a", "b", 0.8))
    assert df.where("s >= 0.8 AND NOT ok").count() == 0 and df.where("ok").count() > 100


def test_recall_by_similarity(spark):
    """Pairs planted at each similarity: found from 0.8 on, left alone below."""
    for changed, alike in ((1, True), (2, True), (3, False), (6, False)):
        texts = [t for g in range(60) for t in relatives(2, 200, changed, g) for t in [" ".join(f"g{g}{w}" for w in t.split())]]
        sets = [plain_shingles(t) for t in texts]
        want = sum(len(a & b) >= 0.8 * len(a | b) for a, b in zip(sets[::2], sets[1::2]))
        assert len(texts) - near_copies.one_of_each(documents(spark, texts)).count() == want and (want == 60) == alike


def test_simhash_finds_every_pair_within_its_radius(spark):
    """100 pairs of similar sets under one key of blocks, 3 bits apart, no MinHash keys: each is found, whether or not the key is keyed again."""
    rnd, texts, rows = random.Random(5), [], []
    far = [rnd.getrandbits(31) << 33 for _ in range(100)]
    for i, fingerprint in enumerate(far):
        for text, flips in zip(relatives(2, 200, 1, i), (0, 1 << 33 | 1 << 44 | 1 << 54)):
            text = " ".join(f"p{i}{w}" for w in text.split())
            own = near_copies.shingle_set(text.encode())
            signed = int(np.uint64(fingerprint ^ flips).astype(np.int64))
            rows.append((len(rows), len(own), signed, near_copies.bitmap(own).tolist(), [len(rows)]))
            texts.append((len(texts), text))
    sketches = spark.createDataFrame(rows, "digest long, n long, fingerprint long, bits array<long>, keys array<long>")
    near_copies.ship_package(spark)
    for crowd in (near_copies.CROWD, 20):
        found = near_copies.set_classes(sketches, spark.createDataFrame(texts, "digest long, text string"), crowd=crowd)
        assert {r.digest: r.root for r in found.collect()} == {i: i - i % 2 for i in range(200)}
