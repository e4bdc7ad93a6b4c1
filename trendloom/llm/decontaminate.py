"""Find benchmark items inside documents, whole or slightly changed.

Every window of a document that has as many words as an item gets a SimHash over its word shingles, as the
items have. A multi-index over the items' fingerprints returns all items within ``RADIUS`` bits: the 64 bits are
cut into 4 blocks, and two fingerprints within 4 * (t + 1) - 1 bits differ by t bits or fewer in some block, so each
item is entered under all values within t bits of its own blocks. What the index returns is verified by the
weighted Jaccard similarity of the shingles themselves.

Windows that share no shingle with any item cannot be similar to one; they are passed over, which loses nothing.
A document with fewer words than an item is the window for that item as a whole; these few are compared without the index.
Items are taken in blocks of bounded size, one pass over the documents for each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.llm import common
from trendloom.llm.common import byte_numbers, byte_prefix_sums, mix, prefix_sums, ship_package

WIDTH = 5
SIMILARITY = 0.8
BLOCK_BITS = 16
BLOCK_RADIUS = 4
RADIUS = (64 // BLOCK_BITS) * (BLOCK_RADIUS + 1) - 1
#: Bounds of one block of items, and so of what is sent to every executor.
BLOCK_ITEMS = 1000
BLOCK_BYTES = 4_000_000

_PIECE = 1 << 20
_STARTS = 4096
_NUMBERS = byte_numbers(lower=True)
_IS_WORD = np.ones(256, bool)
_IS_WORD[list(b" \t\n\x0b\x0c\r")] = False


def word_hashes(text: bytes) -> np.ndarray:
    """A hash for each word, A-Z as a-z; long texts are read in pieces that end between words."""
    found, at, data = [], 0, np.frombuffer(text, np.uint8)
    while at < len(data):
        end = min(len(data), at + _PIECE)
        while end < len(data) and _IS_WORD[data[end]]:
            end += 1
        piece = data[at:end]
        edge = np.flatnonzero(np.diff(np.r_[False, _IS_WORD[piece], False]))
        start, stop = edge[::2], edge[1::2]
        prefix = byte_prefix_sums(_NUMBERS, piece)
        found.append(mix((prefix[stop] - prefix[start]) * _inverse_powers(len(piece))[start]))
        at = end
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


_inverse = np.ones(1, np.uint64)


def _inverse_powers(n: int) -> np.ndarray:
    """Undo the powers of BASE that a place in the text brings into a hash."""
    global _inverse
    if len(_inverse) < n:
        grown = np.full(max(n, 2 * len(_inverse)), pow(int(common.BASE), -1, 1 << 64), np.uint64)
        grown[0] = 1
        _inverse = np.multiply.accumulate(grown)
    return _inverse


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    if len(words) < width:
        return np.zeros(0, np.uint64)
    prefix = prefix_sums(words)
    return mix((prefix[width:] - prefix[:-width]) * _inverse_powers(len(words))[: len(words) - width + 1])


def shingles(words: list[bytes], width: int) -> Counter:
    return Counter(b" ".join(words[i : i + width]) for i in range(len(words) - width + 1))


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard: shared over all shingles, repeats counted."""
    return (a & b).total() / (a | b).total()


def simhash_windows(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of hashes[s : s + size] for each start, from running sums of the bits."""
    low = int(starts[0])
    part = np.ascontiguousarray(hashes[low : int(starts[-1]) + size])
    bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(part) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    ones = sums[starts - low + size] - sums[starts - low]
    return np.packbits((2 * ones > size).astype(np.uint8), axis=1, bitorder="little").view(np.uint64).ravel()


def _near_values() -> np.ndarray:
    flips = [sum(1 << b for b in chosen) for n in range(BLOCK_RADIUS + 1) for chosen in combinations(range(BLOCK_BITS), n)]
    return np.array(flips, np.int64)


@dataclass
class Item:
    item_id: int | None
    size: int
    width: int
    shingles: Counter


class ItemIndex:
    """A block of items: their shingles, and their fingerprints by blocks of bits."""

    def __init__(self, rows: list[tuple[int | None, str | None]]) -> None:
        self.items: list[Item] = []
        prints, owners, hashes, widths = [], [], [], []
        for item_id, text in rows:
            raw = (text or "").encode()
            words = raw.lower().split()
            if not words:
                continue
            width = min(WIDTH, len(words))
            own = shingle_hashes(word_hashes(raw), width)
            prints.append(simhash_windows(own, np.zeros(1, np.int64), len(own))[0])
            owners += [len(self.items)] * len(own)
            hashes.append(own)
            widths += [width] * len(own)
            self.items.append(Item(item_id, len(words), width, shingles(words, width)))
        self.prints = np.array(prints, np.uint64)
        self.sizes = np.array([x.size for x in self.items], np.int64)
        hashes, owners, widths = np.concatenate([*hashes, np.zeros(0, np.uint64)]), np.array(owners, np.int64), np.array(widths, np.int64)
        self.by_width = {}
        for width in np.unique(widths).tolist():
            mine = np.flatnonzero(widths == width)
            mine = mine[np.argsort(hashes[mine], kind="stable")]
            seen = np.zeros(1 << 16, bool)
            seen[hashes[mine] >> np.uint64(48)] = True
            self.by_width[width] = (seen, hashes[mine], owners[mine])
        self.blocks = []
        near = _near_values()
        for b in range(64 // BLOCK_BITS):
            own = ((self.prints >> np.uint64(b * BLOCK_BITS)) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)
            values = (own[:, None] ^ near).ravel()
            order = np.argsort(values, kind="stable")
            begin = np.searchsorted(values[order], np.arange((1 << BLOCK_BITS) + 1))
            self.blocks.append((begin, (order // len(near)).astype(np.int32)))

    def probe(self, prints: np.ndarray, size: int) -> list[tuple[int, int, int]]:
        """(window, item, distance) of the items of that many words within the radius of each fingerprint."""
        windows, items = [], []
        for b, (begin, entries) in enumerate(self.blocks):
            value = ((prints >> np.uint64(b * BLOCK_BITS)) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)
            count = begin[value + 1] - begin[value]
            window = np.repeat(np.arange(len(prints)), count)
            offset = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count)
            windows.append(window)
            items.append(entries[np.repeat(begin[value], count) + offset].astype(np.int64))
        pair = np.unique(np.concatenate(windows) * len(self.items) + np.concatenate(items))
        window, item = pair // len(self.items), pair % len(self.items)
        fits = self.sizes[item] == size
        window, item = window[fits], item[fits]
        distance = np.bitwise_count(prints[window] ^ self.prints[item])
        close = distance <= RADIUS
        return list(zip(window[close].tolist(), item[close].tolist(), distance[close].tolist()))

    def _windows(self, hashes: np.ndarray, width: int, words: int) -> Iterator[tuple[int, np.ndarray]]:
        """(size, starts) of the windows that share a shingle with some item of that size."""
        seen, known, owners = self.by_width[width]
        at = np.flatnonzero(seen[hashes >> np.uint64(48)])
        low, high = np.searchsorted(known, hashes[at]), np.searchsorted(known, hashes[at], "right")
        sizes: dict[int, list[int]] = {}
        for place, a, b in zip(at.tolist(), low.tolist(), high.tolist()):
            for size in {int(self.sizes[o]) for o in owners[a:b]}:
                sizes.setdefault(size, []).append(place)
        for size, places in sizes.items():
            reach = np.arange(width - size, 1)
            starts = np.unique((np.array(places)[:, None] + reach).ravel())
            starts = starts[(starts >= 0) & (starts <= words - size)]
            gaps = np.flatnonzero(np.diff(starts) > size) + 1
            for run in np.split(starts, gaps):
                for some in np.array_split(run, -(-len(run) // _STARTS) or 1):
                    if len(some):
                        yield size, some

    def _larger(self, hashes: np.ndarray, width: int, words: int, threshold: float) -> list[int]:
        """The items with more words than the text that share enough shingles with it to reach the threshold."""
        seen, known, owners = self.by_width[width]
        at = hashes[seen[hashes >> np.uint64(48)]]
        if not len(at) or words >= self.sizes.max():
            return []
        low, high = np.searchsorted(known, at), np.searchsorted(known, at, "right")
        shared = Counter(o for a, b in zip(low.tolist(), high.tolist()) for o in set(owners[a:b].tolist()))
        return [o for o, n in shared.items() if self.sizes[o] > words and n >= threshold * (self.sizes[o] - width + 1) - 1e-9]

    def find(self, text: bytes, threshold: float) -> list[tuple[int | None, int, int, int, float]]:
        """(item_id, first word, words, bits apart, similarity): the best window of each item, the first of equals."""
        numbers, words = word_hashes(text), None
        best: dict[int, tuple] = {}
        for width in self.by_width:
            hashes = shingle_hashes(numbers, width)
            for size, starts in self._windows(hashes, width, len(numbers)):
                for window, item, distance in self.probe(simhash_windows(hashes, starts, size - width + 1), size):
                    if self.items[item].width != width:
                        continue
                    words = text.lower().split() if words is None else words
                    start = int(starts[window])
                    alike = similarity(self.items[item].shingles, shingles(words[start : start + size], width))
                    if alike >= threshold and (item not in best or (-alike, start) < best[item][:2]):
                        best[item] = (-alike, start, size, distance)
            for item in self._larger(hashes, width, len(numbers), threshold):
                words = text.lower().split() if words is None else words
                alike = similarity(self.items[item].shingles, shingles(words, width))
                if alike >= threshold:
                    whole = simhash_windows(hashes, np.zeros(1, np.int64), len(hashes))[0]
                    best[item] = (-alike, 0, len(words), int(np.bitwise_count(whole ^ self.prints[item])))
        by_id: dict[int | None, tuple] = {}
        for item, (alike, start, size, distance) in sorted(best.items(), key=lambda x: x[1]):
            by_id.setdefault(self.items[item].item_id, (start, size, distance, -alike))
        return [(i, *x) for i, x in by_id.items()]


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str | None]]]:
    """The distinct items in blocks small enough to be held everywhere."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    count, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-count // BLOCK_ITEMS), -(-size // BLOCK_BYTES))
    for b in range(blocks):
        yield [tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()]


_HIT = pa.schema([
    ("doc_id", pa.int64()), ("item_id", pa.int64()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("bits", pa.int64()), ("similarity", pa.float64()),
])


def _search(index: Broadcast, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), common.texts(batch.column("text"))):
                rows += [(doc_id, *hit) for hit in index.value.find(text, threshold)]
            columns = list(zip(*rows)) or [[]] * len(_HIT)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _HIT.types)], schema=_HIT)

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """doc_id, item_id, first_word, n_words, bits, similarity: the best window of each item in each document.

    An item that stands in a document several times gives one row: the most similar window, the first of
    equals. A document with fewer words than an item is compared with it as a whole. Items of fewer than five words are one shingle and must stand as they are; items without a word,
    null ones included, are in no document. Null ids are kept. Repeated documents give repeated rows, repeated
    items do not. Empty tables give no rows. Further columns are ignored.
    """
    spark, found = docs.sparkSession, None
    ship_package(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    for block in item_blocks(benchmark):
        index = spark.sparkContext.broadcast(ItemIndex(block))
        part = rows.mapInArrow(
            _search(index, threshold), "doc_id long, item_id long, first_word long, n_words long, bits long, similarity double"
        )
        found = part if found is None else found.unionByName(part)
    return found


def without_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """docs without those that hold a benchmark item; all columns and all other rows stay as they are."""
    ship_package(spark)
    for block in item_blocks(benchmark):
        docs = docs.where(~_leaks(spark.sparkContext.broadcast(ItemIndex(block)), threshold)(F.col("text").cast("string")))
    return docs


def _leaks(index: Broadcast, threshold: float):
    @F.arrow_udf(T.BooleanType())
    def leaks(text: pa.Array) -> pa.Array:
        return pa.array([bool(index.value.find(t, threshold)) for t in common.texts(text)], pa.bool_())

    return leaks
