import random

import numpy as np
import pytest
import xxhash
from tests.llm.cases import LONG, WORDS, documents

from trendloom.llm import common, simhash_dedup
from trendloom.llm.components import connected_components


def plain_fingerprint(text: str) -> int:
    words = WORDS.findall("".join(c.lower() if c.isascii() else c for c in text))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints: dict, radius: int = 3) -> dict:
    ids, root = sorted(prints), {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    values = np.array([prints[i] for i in ids], np.uint64)
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(values[i] ^ values[i + 1 :]) <= radius):
            a, b = find(ids[i]), find(ids[i + 1 + j])
            root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    prints = {r.doc_id: plain_fingerprint(r.text or "") for r in docs.collect()}
    want = plain_components(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash_dedup.near_duplicates(docs).collect()}
    assert got == {i: (f"{p:016x}", want[i]) for i, p in prints.items()}
    kept = [r.doc_id for r in simhash_dedup.one_of_each(docs.unionByName(docs)).collect()]
    assert sorted(kept) == sorted(set(want.values()))


@pytest.mark.parametrize("crowd", [simhash_dedup.CROWD, 5])
def test_crowded_fingerprints(spark, crowd):
    rnd = random.Random(3)
    base, prints = [rnd.getrandbits(64) for _ in range(4)], set()
    for _ in range(1500):
        x = rnd.choice(base)
        for _ in range(rnd.randint(0, 9)):
            x ^= 1 << rnd.randrange(64)
        prints.add(x)
    signed = {x - (1 << 64) if x >> 63 else x: x for x in prints}
    want = plain_components({s: u for s, u in signed.items()})
    frame = spark.createDataFrame([(s,) for s in signed], "fingerprint long")
    got = {r.fingerprint: r.root for r in simhash_dedup.fingerprint_classes(frame, crowd=crowd).collect()}
    assert {(want[s], got[s]) for s in signed} == {(r, got[r]) for r in set(want.values())}


def test_long_text_in_pieces(monkeypatch):
    text = LONG + "and an end"
    want = plain_fingerprint(text)
    monkeypatch.setattr(common.word_lists, "__defaults__", (1000,))
    assert simhash_dedup.fingerprint(text.encode()) & (2**64 - 1) == want


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(50)] + [(7, 7)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 151)}}


def test_xxhash_agrees_with_spark(spark):
    rows = documents(spark, ["a b c", "é"]).selectExpr("text", "xxhash64(text) AS h").collect()
    assert all(xxhash.xxh64_intdigest(r.text.encode(), seed=42) == r.h & (2**64 - 1) for r in rows)
