"""Near copies by SimHash: fingerprints that differ in few bits share a block of bits.

The 64 bits are cut into 6 blocks. Two fingerprints within 3 bits agree in at least 3 of the blocks, so they
meet in at least one of the 20 tables keyed by 3 blocks each. Only distinct fingerprints go there; copies,
however many, are one row. A key with more than ``CROWD`` distinct fingerprints is keyed again by 5 of 8 parts of the
remaining bits, by the same argument; that leaves about a dozen free bits and so bounds every bucket.
Within a bucket the Hamming distances are checked and each fingerprint is tied to the smallest one it can reach,
so a bucket gives as many rows as it has members, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.llm import common
from trendloom.llm.common import keyed, row_key, ship_package, stage
from trendloom.llm.components import connected_components

RADIUS = 3
BLOCKS = 6
CROWD = 4096
DEEP_BLOCKS = 8
SEED = 42

_ONES = np.uint64(0x0101010101010101)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits set. Eight one-byte counters are added up at a time."""
    counts = np.zeros(64, np.int64)
    padded = np.zeros(-(-len(hashes) // 255) * 255, np.uint64)
    padded[: len(hashes)] = hashes
    for s in range(8):
        lanes = ((padded >> np.uint64(s)) & _ONES).reshape(-1, 255).sum(axis=1, dtype=np.uint64)
        counts[s::8] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts, h = (ends - lengths).tolist(), xxhash.xxh64_intdigest
    return np.fromiter((h(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())), np.uint64)


def fingerprint(text: bytes, width: int = 3) -> int:
    """SimHash of the word shingles of a text as a signed integer; 0 if there is no word."""
    counts, total, carried = np.zeros(64, np.int64), 0, []
    for words in common.word_lists(text):
        words = carried + words
        if len(words) >= width:
            hashes = shingle_hashes(words, width)
            counts += bit_counts(hashes)
            total += len(hashes)
            words = words[len(words) - width + 1 :]
        carried = words
    if not total and carried:
        counts, total = bit_counts(np.array([xxhash.xxh64_intdigest(b" ".join(carried), SEED)], np.uint64)), 1
    bits = np.packbits((2 * counts > total).astype(np.uint8), bitorder="little")
    return int(bits.view(np.int64)[0])


@F.arrow_udf(T.LongType())
def fingerprint_of(text: pa.Array) -> pa.Array:
    return pa.array([fingerprint(t) for t in common.texts(text)], pa.int64())


def masks(bits: list[int], blocks: int, radius: int) -> list[int]:
    """Masks that keep all but ``radius`` of the blocks into which the bits are cut."""
    parts = [sum(1 << int(b) for b in part) for part in np.array_split(bits, blocks)]
    signed = [sum(kept) for kept in combinations(parts, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in signed]


def _keys(kept: list[int]):
    """One (table, bits) for each mask."""
    fp = F.col("fingerprint")
    return F.explode(F.array([F.struct(F.lit(t).alias("table"), fp.bitwiseAND(F.lit(m)).alias("bits")) for t, m in enumerate(kept)]))


def _tied(fps: np.ndarray, radius: int, direct: bool = False) -> Iterator[tuple[int, int]]:
    """Each fingerprint of a bucket with the smallest that it reaches within the bucket, or with one within the radius on the way to it."""
    left = np.sort(fps)
    while len(left) > 1:
        root, left, reached = left[0], left[1:], [left[0]]
        while reached and len(left):
            here = reached.pop()
            near = np.bitwise_count((left ^ here).view(np.uint64)) <= radius
            found, left = left[near], left[~near]
            reached += list(found)
            yield from ((int(x), int(here if direct else root)) for x in found)


def _bucket_edges(radius: int, direct: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key; the last key of a batch may go on in the next."""
        rest = [np.zeros(0, np.int64)] * 3

        def edges(table, bits, fps):
            first = np.flatnonzero(np.r_[True, (np.diff(table) != 0) | (np.diff(bits) != 0)])
            pairs = [e for a, b in zip(first, np.r_[first[1:], len(fps)]) if b - a > 1 for e in _tied(fps[a:b], radius, direct)]
            u, v = zip(*pairs) if pairs else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

        for batch in batches:
            table, bits, fps = (np.r_[old, c.to_numpy(zero_copy_only=False)] for old, c in zip(rest, batch.columns))
            if not len(fps):
                continue
            last = np.flatnonzero((table != table[-1]) | (bits != bits[-1]))
            cut = last[-1] + 1 if len(last) else 0
            rest = [table[cut:], bits[cut:], fps[cut:]]
            if cut:
                yield edges(table[:cut], bits[:cut], fps[:cut])
        if len(rest[2]):
            yield edges(*rest)

    return run


def buckets_of(distinct: DataFrame, radius: int = RADIUS, crowd: int = CROWD) -> DataFrame:
    """(table, bits, fingerprint): buckets in which any two distinct fingerprints within ``radius`` bits meet."""
    first = masks(list(range(64)), BLOCKS, radius)
    tables = distinct.select("fingerprint", _keys(first).alias("k")).select("k.table", "k.bits", "fingerprint")
    sizes = tables.groupBy("table", "bits").agg(F.count("*").alias("n")).where("n > 1")
    shared = stage(tables.join(sizes, ["table", "bits"]), "blocks")
    again = [[m | mask for m in masks([b for b in range(64) if not mask >> b & 1], DEEP_BLOCKS, radius)] for mask in first]
    finer = F.array([F.array([F.lit(m) for m in row]) for row in again])[F.col("table")]
    deep = shared.where(F.col("n") > crowd).select("table", "fingerprint", F.posexplode(finer).alias("t", "mask"))
    deep = deep.select(
        (1000 * (F.col("table") + 1) + F.col("t")).alias("table"), F.col("fingerprint").bitwiseAND(F.col("mask")).alias("bits"), "fingerprint"
    )
    return shared.where(F.col("n") <= crowd).select("table", "bits", "fingerprint").unionByName(deep)


def bucket_ties(buckets: DataFrame, radius: int = RADIUS, direct: bool = False) -> DataFrame:
    """(u, v): ties that connect exactly the fingerprints linked within ``radius`` bits; ``direct`` ones are links themselves."""
    ship_package(buckets.sparkSession)
    dealt = buckets.repartition("table", "bits").sortWithinPartitions("table", "bits")
    return dealt.mapInArrow(_bucket_edges(radius, direct), "u long, v long")


def near_pairs(distinct: DataFrame, radius: int = RADIUS, crowd: int = CROWD) -> DataFrame:
    """(u, v): ties between distinct fingerprints that connect exactly those linked within ``radius`` bits."""
    return bucket_ties(buckets_of(distinct, radius, crowd), radius)


def fingerprint_classes(fingerprints: DataFrame, radius: int = RADIUS, crowd: int = CROWD) -> DataFrame:
    """(fingerprint, root) of every distinct fingerprint; root names its component."""
    distinct = fingerprints.select("fingerprint").distinct()
    ties = connected_components(near_pairs(distinct, radius, crowd))
    joined = distinct.join(ties, distinct["fingerprint"] == ties["node"], "left")
    return joined.select("fingerprint", F.coalesce("root", "fingerprint").alias("root"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, crowd: int = CROWD) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest id of the component) of every row.

    Texts without a word, null ones included, have fingerprint zero and are linked like any other. Null ids
    do not count for component_id; it is null where a component has no other. Repeated rows are linked.
    An empty table gives no rows. Further columns are ignored.
    """
    ship_package(docs.sparkSession)
    rows = stage(keyed(docs).select("doc_id", fingerprint_of("text").alias("fingerprint")), "fingerprints")
    classes = stage(fingerprint_classes(rows, radius, crowd), "classes")
    least = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")).join(classes, "fingerprint")
    smallest = least.groupBy("root").agg(F.min("least").alias("component_id"))
    named = classes.join(smallest, "root").select("fingerprint", "component_id")
    hexed = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return rows.join(named, "fingerprint").select("doc_id", hexed.alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, radius: int = RADIUS, crowd: int = CROWD) -> DataFrame:
    """docs with one row of each component: the smallest id, then the smallest text hash; all columns kept.

    Of rows that agree in id and text one stays. A null id counts as larger than all others.
    """
    ship_package(docs.sparkSession)
    rows = row_key(docs)
    prints = rows.select(
        "id_key", "text_key", F.col("row.doc_id").isNull().alias("no_id"), fingerprint_of(F.col("row.text").cast("string")).alias("fingerprint")
    )
    prints = stage(prints, "fingerprints")
    classes = fingerprint_classes(prints, radius, crowd)
    first = prints.groupBy("fingerprint").agg(F.min(F.struct("no_id", "id_key", "text_key")).alias("first"))
    kept = first.join(classes, "fingerprint").groupBy("root").agg(F.min("first").alias("first"))
    kept = stage(kept.select("first.id_key", "first.text_key"), "kept")
    return rows.join(kept, ["id_key", "text_key"]).dropDuplicates(["id_key", "text_key"]).select("row.*")
