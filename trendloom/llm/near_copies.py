"""Near copies by the Jaccard similarity of their word shingles: SimHash blocks first, then MinHash keys, each pair verified exactly.

A text is the set of its 5-word shingles; sets that are equal are one row. Pairs are found in turns, and every
pair at or above the threshold ties two components into one:

1. SimHash, whole: the distinct fingerprints of the sets go to 20 tables of 3 blocks in 6, crowded keys are keyed again, and distances are checked, as in
   ``simhash_dedup``. First the links that hold its components together are candidates, and sets of one fingerprint. Then every
   pair within ``RADIUS`` bits whose sets are still in different components is one, under the conditions of 3.
2. A similarity of 0.8 leaves about 10 of 64 bits apart, which no blocks of useful size can cover. ``BANDS`` keys of ``ROWS`` minima each
   reach those pairs: two sets of similarity 0.8 share a key but for about 3 in a million pairs, and more alike ones more
   surely. Twice every set is held against a few neighbours under its keys, so that large groups grow together in a few comparisons
   for each member.
3. Then, under every key, all sets that are still in different components are joined. Sizes too far apart, or
   bitmaps that differ in more places than shingles may, end a pair inside the join condition, before it becomes a row. Each differing shingle
   flips one place of a bitmap, so no pair at the threshold is lost, and a group of texts that are alike but below the threshold
   makes few rows, however large it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendloom.llm import common
from trendloom.llm.common import row_key, ship_package, slices, stage
from trendloom.llm.components import connected_components
from trendloom.llm.simhash_dedup import CROWD, RADIUS, SEED, bit_counts, bucket_ties, buckets_of, shingle_hashes

WIDTH = 5
SIMILARITY = 0.8
BANDS = 32
ROWS = 5
NEIGHBOURS = 4
SPARSE_ROUNDS = 2
BITS = 512

_CHUNK = 2048
_rnd = np.random.default_rng(20240607)
_FACTORS = _rnd.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
_FLIPS = _rnd.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)[:, None]


def shingle_set(text: bytes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct shingle hashes; a text of fewer words is one shingle, one without a word is the shingle 0."""
    found, carried = [], []
    for words in common.word_lists(text):
        words = carried + words
        if len(words) >= width:
            found.append(np.unique(shingle_hashes(words, width)))
            words = words[len(words) - width + 1 :]
        carried = words
    if not found:
        return np.array([xxhash.xxh64_intdigest(b" ".join(carried), SEED) if carried else 0], np.uint64)
    return np.unique(np.concatenate(found))


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """One key for each band, from the minima of its hash functions."""
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for at in range(0, len(shingles), _CHUNK):
        np.minimum(least, ((shingles[at : at + _CHUNK] ^ _FLIPS) * _FACTORS).min(axis=1), out=least)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(ROWS):
        keys = common.mix(keys ^ least[r::ROWS]) + np.uint64(r)
    return keys.view(np.int64)


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """For each of BITS places, whether an odd number of shingles falls on it."""
    places = (common.mix(shingles) >> np.uint64(40)).astype(np.int64) % BITS
    return np.packbits(np.bincount(places, minlength=BITS).astype(np.uint8) & 1, bitorder="little").view(np.int64)


def _digest(shingles: np.ndarray) -> int:
    return int.from_bytes(blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _fingerprint(shingles: np.ndarray) -> int:
    bits = np.packbits((2 * bit_counts(shingles) > len(shingles)).astype(np.uint8), bitorder="little")
    return int(bits.view(np.int64)[0])


_SKETCH = "digest long, n long, fingerprint long, bits array<long>, keys array<long>"


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in slices(whole)):
        sets = [shingle_set(t) for t in common.texts(batch.column("text"))]
        columns = [batch.column(c) for c in ("id_key", "text_key", "no_id")]
        columns += [pa.array([f(x) for x in sets], pa.int64()) for f in (_digest, len, _fingerprint)]
        columns += [pa.array([f(x) for x in sets], pa.list_(pa.int64())) for f in (bitmap, band_keys)]
        yield pa.RecordBatch.from_arrays(columns, ["id_key", "text_key", "no_id", "digest", "n", "fingerprint", "bits", "keys"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in slices(whole)):
        sets = [shingle_set(t).tobytes() for t in common.texts(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(sets, pa.binary())], ["digest", "shingles"])


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def _verified(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            a, b = (common.texts(batch.column(c)) for c in ("a", "b"))
            same = [similarity(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) >= threshold - 1e-12 for x, y in zip(a, b)]
            yield batch.select(["u", "v"]).filter(pa.array(same, pa.bool_()))

    return run


def _can_reach(a: str, b: str, threshold: float) -> Column:
    """Whether two sets can be as similar as the threshold by their sizes and bitmaps.

    Of sets with n and m shingles at most (n + m) * (1 - t) / (1 + t) may belong to one alone, and the smaller has t times the
    larger at least.
    """
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    apart = reduce(add, (F.bit_count(F.col(f"{a}.bits")[i].bitwiseXOR(F.col(f"{b}.bits")[i])) for i in range(BITS // 64)))
    return (F.least(n, m) >= (threshold - 1e-9) * F.greatest(n, m)) & (apart <= (n + m) * (1 - threshold) / (1 + threshold) + 1e-6)


def _shared_keys(keys: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows (digest, key) of keys under which several components meet, with the root of each."""
    members = keys.join(roots, "digest")
    meeting = members.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key")
    return members.join(meeting, "key")


def _neighbours(members: DataFrame, turn: int) -> DataFrame:
    """(u, v) of different components: each set with up to NEIGHBOURS before it under its key, in an order of the turn's own."""
    order = Window.partitionBy("key").orderBy(F.xxhash64("digest", F.lit(turn)), "digest")
    before = F.array(*[F.lag(F.struct("digest", "root"), k).over(order) for k in range(1, NEIGHBOURS + 1)])
    held = members.select("digest", "root", F.filter(before, lambda o: o.isNotNull()).alias("before"))
    held = held.select("digest", "root", F.explode("before").alias("o")).where("o.root <> root")
    return held.select(F.least("digest", "o.digest").alias("u"), F.greatest("digest", "o.digest").alias("v")).distinct()


def _fingerprint_links(sketches: DataFrame, buckets: DataFrame) -> DataFrame:
    """(u, v): sets of one fingerprint, each with the first of them, and the first sets of the fingerprints that hold a SimHash component together."""
    firsts = sketches.groupBy("fingerprint").agg(F.min("digest").alias("first"))
    alike = sketches.select("digest", "fingerprint").join(firsts, "fingerprint").where("digest <> first").select(F.col("first").alias("u"), F.col("digest").alias("v"))
    ends = [firsts.select(F.col("fingerprint").alias(c), F.col("first").alias(f"first_{c}")) for c in ("u", "v")]
    ties = bucket_ties(buckets, RADIUS, direct=True).distinct().join(ends[0], "u").join(ends[1], "v")
    return alike.union(ties.select(F.least("first_u", "first_v"), F.greatest("first_u", "first_v"))).distinct()


def _fingerprint_keys(sketches: DataFrame, buckets: DataFrame) -> DataFrame:
    """(digest, fingerprint, key): under one key at least meet any two sets whose fingerprints are within ``RADIUS`` bits."""
    alike = sketches.groupBy("fingerprint").agg(F.count("*").alias("n")).where("n > 1")
    keys = buckets.select("fingerprint", F.xxhash64("table", "bits").alias("key"))
    keys = keys.unionByName(alike.select("fingerprint", F.xxhash64(F.lit(-1), F.col("fingerprint")).alias("key")))
    return sketches.select("digest", "fingerprint").join(keys, "fingerprint").select("digest", "fingerprint", "key")


def _all_pairs(rows: DataFrame, threshold: float, radius: int | None = None) -> DataFrame:
    """(u, v) of different components under one key that can reach the threshold, with fingerprints within ``radius`` if given."""
    on = (F.col("a.key") == F.col("b.key")) & (F.col("a.digest") < F.col("b.digest")) & (F.col("a.root") != F.col("b.root"))
    if radius is not None:
        on = on & (F.bit_count(F.col("a.fingerprint").bitwiseXOR(F.col("b.fingerprint"))) <= radius)
    pairs = rows.alias("a").join(rows.alias("b"), on & _can_reach("a", "b", threshold))
    return pairs.select(F.col("a.digest").alias("u"), F.col("b.digest").alias("v")).distinct()


def _drop(*staged: DataFrame) -> None:
    for df in staged:
        common.discard(df.sparkSession, common.folder_of(df))


def _tied(pairs: DataFrame, roots: DataFrame, sets: DataFrame, sketches: DataFrame, threshold: float) -> DataFrame:
    """Roots after the pairs that turn out similar have tied their components."""
    lean = sketches.select("digest", "n", "bits")
    pairs = pairs.join(lean.alias("a"), F.col("u") == F.col("a.digest")).join(lean.alias("b"), F.col("v") == F.col("b.digest"))
    pairs = stage(pairs.where(_can_reach("a", "b", threshold)).select("u", "v"), "near-pairs")
    both = pairs.join(sets.select(F.col("digest").alias("u"), F.col("shingles").alias("a")), "u")
    both = both.join(sets.select(F.col("digest").alias("v"), F.col("shingles").alias("b")), "v")
    ties = stage(both.select("u", "v", "a", "b").mapInArrow(_verified(threshold), "u long, v long"), "near-ties")
    ends = [roots.select(F.col("digest").alias(c), F.col("root").alias(f"root_{c}")) for c in ("u", "v")]
    edges = ties.join(ends[0], "u").join(ends[1], "v").select(F.col("root_u").alias("u"), F.col("root_v").alias("v"))
    components = connected_components(edges)
    merged = components.select(F.col("node").alias("root"), F.col("root").alias("merged"))
    after = stage(roots.join(merged, "root", "left").select("digest", F.coalesce("merged", "root").alias("root")), "near-roots")
    _drop(pairs, ties, components)
    return after


def set_classes(sketches: DataFrame, texts: DataFrame, threshold: float = SIMILARITY, crowd: int = CROWD) -> DataFrame:
    """(digest, root) for distinct sketches; texts has digest and text of each. What the turns staged is deleted after them."""
    buckets = stage(buckets_of(sketches.select("fingerprint").distinct(), RADIUS, crowd), "near-buckets")
    rows = sketches.select("digest", F.explode("keys").alias("key"))
    crowds = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    keys = [stage(df, "near-keys") for df in (_fingerprint_keys(sketches, buckets), rows.join(crowds, "key"))]
    meeting = keys[0].select("digest").union(keys[1].select("digest")).distinct()
    sets = stage(texts.join(meeting, "digest").select("digest", "text").mapInArrow(_sets, "digest long, shingles binary"), "near-sets")
    lean = sketches.select("digest", "n", "bits")

    def turn(pairs: DataFrame, before: DataFrame, *done: DataFrame) -> DataFrame:
        after = _tied(pairs, before, sets, sketches, threshold)
        _drop(*done)
        return after

    def every_pair(keyed: DataFrame, before: DataFrame, radius: int | None = None) -> DataFrame:
        rest = stage(_shared_keys(keyed, before).join(lean, "digest"), "near-rest")
        return turn(_all_pairs(rest, threshold, radius), before, before, rest)

    each = sketches.select("digest", F.col("digest").alias("root"))
    roots = turn(_fingerprint_links(sketches, buckets), each, buckets)
    roots = every_pair(keys[0], roots, RADIUS)
    for k in range(1, SPARSE_ROUNDS + 1):
        roots = turn(_neighbours(_shared_keys(keys[1], roots), k), roots, roots)
    roots = every_pair(keys[1], roots)
    _drop(sets, *keys)
    return roots


def one_of_each(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """docs with one row of each component of texts tied by shingle similarity; all columns kept.

    It is the row with the smallest id, then the smallest text hash; a null id counts as larger than all others. Texts
    without a word, null ones included, are copies of each other.
    """
    ship_package(docs.sparkSession)
    rows = row_key(docs)
    texts = rows.select("id_key", "text_key", F.col("row.doc_id").isNull().alias("no_id"), F.col("row.text").cast("string").alias("text"))
    prints = stage(texts.mapInArrow(_sketches, f"id_key long, text_key long, no_id boolean, {_SKETCH}"), "near-sketches")
    first = F.min(F.struct("no_id", "id_key", "text_key")).alias("first")
    same = [F.any_value(c).alias(c) for c in ("n", "fingerprint", "bits", "keys")]
    distinct = stage(prints.groupBy("digest").agg(first, *same), "near-distinct")
    named = distinct.select("digest", "first.id_key", "first.text_key")
    one_each = texts.join(named, ["id_key", "text_key"]).select("digest", "text").dropDuplicates(["digest"])
    classes = set_classes(distinct, one_each, threshold)
    kept = distinct.join(classes, "digest").groupBy("root").agg(F.min("first").alias("first"))
    kept = stage(kept.select("first.id_key", "first.text_key"), "kept")
    return rows.join(kept, ["id_key", "text_key"]).dropDuplicates(["id_key", "text_key"]).select("row.*")
