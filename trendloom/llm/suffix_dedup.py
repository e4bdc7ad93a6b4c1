"""Remove every byte that lies in a long string which occurs more than once in the corpus.

Every window of ``length`` bytes has an anchor: the ``gram`` bytes in it with the smallest hash, the first of
them if they tie. Equal windows have equal anchors at equal places, so windows that can be equal meet
where their anchors do. Windows in a row with one anchor form a segment, about one for every 130 bytes.

1. Segments are read off each document and written to the shared folder, without their text.
2. Anchors that occur once are dropped. Equal segments (anchor, shape and digest) are counted and collapsed,
   so that a group of copies, however large, is one row with a count.
3. The text of the remaining distinct segments is fetched and dealt into buckets by anchor. In each bucket
   the suffixes that start at the anchors are sorted, and so are the prefixes that end there, by a mergesort
   whose comparisons find the common extension of two strings by binary search over prefix hashes.
   The common extensions of neighbours in both orders tell which windows are equal. Neighbours are compared
   byte by byte; if hashes should have lied, the bucket is sorted again by its bytes.
4. Equal windows are mapped back to all occurrences of their segment.

An anchor shared by more than ``split_rows`` distinct segments would overfill a bucket. Its windows are dealt
out one by one instead, by their hash and digest, and counted; the result is the same.

Passages can also be measured in words: every word, A-Z as a-z, then stands as a code of ``CODE`` bytes, and the same
steps run on the codes, whose spans are put back on the bytes of the words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b, sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.llm import common
from trendloom.llm.common import byte_column, byte_prefix_sums, keyed, mix, powers, same_row, ship_package, slices, stage, substring_hash
from trendloom.llm.decontaminate import word_hashes
from trendloom.session import staged_since, staging_path

LENGTH = 400
#: Words of a repeated passage that the pipeline takes out, however few bytes they have.
PASSAGE_WORDS = 51
CODE = 8
SPLIT_ROWS = 16_384
BUCKET_ROWS = 2_048

_BLOCK = 1 << 17
_PLACE = np.uint64((1 << 20) - 1)
_SEGMENT = "doc_id long, text_key long, start long, anchor long, shape int, digest long"


def _digest(data: bytes) -> int:
    return int.from_bytes(blake2b(data, digest_size=8).digest(), "little", signed=True)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while step * 2 <= width:
        x, step = np.minimum(x[:-step], x[step:]), step * 2
    rest = width - step
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def find_segments(data: np.ndarray, offsets: np.ndarray, length: int, gram: int, step: int = 1):
    """Yield (row, start in row, windows, place of the anchor, anchor hash, digest) of the segments of some rows.

    All rows are read as one run of bytes, in blocks; windows across two rows are left out. With a ``step``, of which all lengths are
    multiples, windows and anchors begin at its multiples alone, and the bytes of a step have one number.
    """
    if step > 1:
        units = data.view(np.uint64)
        for row, start, count, at, anchor, digest in _find_segments(units, mix(units) | np.uint64(1), offsets // step, length // step, gram // step):
            yield row, start * step, (count - 1) * step + 1, at * step, anchor, digest
    else:
        yield from _find_segments(data, None, offsets, length, gram)


def _find_segments(data: np.ndarray, numbers: np.ndarray | None, offsets: np.ndarray, length: int, gram: int):
    table, top = common.byte_numbers(), 2 * _BLOCK
    for low in range(0, max(0, len(data) - length + 1), _BLOCK):
        block = data[low : low + _BLOCK + length - 1]
        windows, grams = len(block) - length + 1, len(block) - gram + 1
        prefix = byte_prefix_sums(table, block) if numbers is None else common.prefix_sums(numbers[low : low + len(block)])
        hashes = mix((prefix[gram:] - prefix[:-gram]) * powers(top + 1)[top : top - grams : -1])
        packed = (hashes & ~_PLACE) | np.arange(grams, dtype=np.uint64)
        anchor = (_sliding_min(packed, length - gram + 1) & _PLACE).astype(np.int64)
        edges = np.concatenate([offsets - low, offsets - low - length + 1])
        cuts = np.concatenate([[0, windows], np.flatnonzero(np.diff(anchor)) + 1, edges[(edges > 0) & (edges < windows)]])
        cuts = np.unique(cuts)
        first, count = cuts[:-1], np.diff(cuts)
        row = np.searchsorted(offsets, first + low, "right") - 1
        whole = first + low + length <= offsets[row + 1]
        row, first, count = row[whole], first[whole], count[whole]
        at, view = anchor[first], memoryview(np.ascontiguousarray(block))
        digests = [_digest(view[a : a + n + length - 1]) for a, n in zip(first.tolist(), count.tolist())]
        yield row, first + low - offsets[row], count, at - first, hashes[at].view(np.int64), np.array(digests, np.int64)


Coder = Callable[[bytes], bytes]


def _coded_column(column: pa.Array, code: Coder) -> tuple[np.ndarray, np.ndarray]:
    """byte_column of the codes of the texts."""
    coded = [code(t) for t in common.texts(column)]
    return np.frombuffer(b"".join(coded), np.uint8), np.cumsum([0, *map(len, coded)], dtype=np.int64)


def _segments(length: int, gram: int, code: Coder | None = None, step: int = 1):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            column = batch.column("text")
            data, offsets = _coded_column(column, code) if code else byte_column(column)
            for row, start, count, place, anchor, digest in find_segments(data, offsets, length, gram, step):
                take = pa.array(row)
                columns = [
                    batch.column("doc_id").take(take), batch.column("text_key").take(take), pa.array(start),
                    pa.array(anchor), pa.array(((count << 16) | place).astype(np.int32)), pa.array(digest),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "start", "anchor", "shape", "digest"])

    return run


class Strings:
    """The strings of one bucket around their anchors, compared forwards or backwards through prefix hashes."""

    def __init__(self, strings: list[bytes], anchor: np.ndarray, group: np.ndarray, forward: bool) -> None:
        sizes = np.array([len(x) for x in strings], np.int64)
        self.strings, self.place, self.group, self.forward = strings, anchor, group, forward
        self.data = np.frombuffer(b"".join(strings), np.uint8)
        self.prefix = byte_prefix_sums(common.byte_numbers(), self.data)
        self.at = np.concatenate([[0], np.cumsum(sizes)[:-1]]) + anchor
        self.room = sizes - anchor if forward else anchor

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common extension from the anchors, by binary search."""
        most = np.minimum(self.room[i], self.room[j])
        least, top = np.zeros_like(most), len(self.data)
        while (open_ := least < most).any():
            middle = (least + most + 1) // 2
            a, b = self.at[i], self.at[j]
            if not self.forward:
                a, b = a - middle, b - middle
            equal = substring_hash(self.prefix, a, middle, top) == substring_hash(self.prefix, b, middle, top)
            least = np.where(open_ & equal, middle, least)
            most = np.where(open_ & ~equal, middle - 1, most)
        return least

    def compare(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Negative, zero or positive: which string comes first. A string comes before its extensions."""
        shared = self.common(i, j)

        def following(x: np.ndarray) -> np.ndarray:
            place = self.at[x] + shared if self.forward else self.at[x] - shared - 1
            return np.where(shared < self.room[x], self.data[np.clip(place, 0, len(self.data) - 1)].astype(np.int64), -1)

        return following(i) - following(j)

    def _bytes(self, x: int) -> bytes:
        return self.strings[x][self.place[x] :] if self.forward else self.strings[x][: self.place[x]][::-1]

    def sorted(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows by group and string, and the verified common extension of each with the one before (-1: another group)."""
        order = merge_sort(self.group, self.compare)
        shared = np.full(len(order), -1)
        near = np.flatnonzero(self.group[order[1:]] == self.group[order[:-1]]) + 1
        shared[near] = self.common(order[near - 1], order[near])
        for k in near.tolist():
            a, b, n = self._bytes(order[k - 1]), self._bytes(order[k]), shared[k]
            if a[:n] != b[:n] or (a[n : n + 1] == b[n : n + 1] and min(len(a), len(b)) > n) or a > b:
                return self._sorted_by_bytes()
        return order, shared

    def _sorted_by_bytes(self) -> tuple[np.ndarray, np.ndarray]:
        order = np.array(sorted(range(len(self.strings)), key=lambda x: (self.group[x], self._bytes(x))), np.int64)
        shared = np.full(len(order), -1)
        for k in range(1, len(order)):
            if self.group[order[k]] == self.group[order[k - 1]]:
                a, b = self._bytes(order[k - 1]), self._bytes(order[k])
                shared[k] = next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        return order, shared


def merge_sort(group: np.ndarray, compare) -> np.ndarray:
    """Order of the rows within each group (rows of a group stand together), by merging runs of doubling length.

    Every row of a run finds its place in the neighbouring run by binary search, all rows at once.
    """
    n = len(group)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if n else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[first, n])
    begin, size = np.repeat(first, sizes), np.repeat(sizes, sizes)
    order, run = np.arange(n), 1
    while run < size.max(initial=0):
        at = np.flatnonzero(size > run)
        local = at - begin[at]
        base = local // (2 * run) * (2 * run)
        left = local < base + run
        low = np.minimum(np.where(left, base + run, base), size[at])
        high = np.minimum(np.where(left, base + 2 * run, base + run), size[at])
        start = low.copy()
        mine = order[at]
        while (busy := np.flatnonzero(low < high)).size:
            middle = (low[busy] + high[busy]) // 2
            sign = compare(order[begin[at[busy]] + middle], mine[busy])
            after = (sign < 0) | (~left[busy] & (sign == 0))
            low[busy] = np.where(after, middle + 1, low[busy])
            high[busy] = np.where(after, high[busy], middle)
        merged = order.copy()
        merged[begin[at] + base + (local - np.where(left, base, base + run)) + (low - start)] = mine
        order, run = merged, run * 2
    return order


def repeated_windows(strings: list[bytes], anchor, windows, group, copies, length: int, step: int = 1) -> list[tuple[int, int, int]]:
    """(row, first, last) of the runs of windows that occur more than once among the segments of a bucket, at multiples of ``step``.

    Two segments share the window that starts ``d`` bytes before the anchor if they agree in ``d`` bytes
    before it and in ``length - d`` bytes from it on.
    """
    lone = np.r_[True, group[1:] != group[:-1]] & np.r_[group[1:] != group[:-1], True]
    found = [(int(r), 0, int(windows[r]) - 1) for r in np.flatnonzero(copies > 1)]
    rows = np.flatnonzero(~lone)
    if not len(rows):
        return found
    some = [strings[r] for r in rows]
    anchor, windows, group, copies = anchor[rows], windows[rows], group[rows], copies[rows]
    sides = [Strings(some, anchor, group, forward).sorted() for forward in (True, False)]
    rank = [np.empty(len(rows), np.int64) for _ in sides]
    for (order, _), place in zip(sides, rank):
        place[order] = np.arange(len(rows))
    mask = [np.zeros((w - 1) // step + 1, bool) for w in windows]
    for d in range(int((anchor - windows).min()) + 1, int(anchor.max()) + 1, step):
        active = np.flatnonzero((anchor >= d) & (anchor - d < windows))
        if len(active) < 2:
            continue
        right, left = (np.cumsum(shared < need)[place[active]] for (_, shared), place, need in zip(sides, rank, (length - d, d)))
        _, kind = np.unique(right * (len(rows) + 1) + left, return_inverse=True)
        equal = np.bincount(kind, weights=copies[active])[kind] > 1
        for r in active[equal & (copies[active] == 1)].tolist():
            mask[r][(anchor[r] - d) // step] = True
    for r, m in enumerate(mask):
        if copies[r] == 1 and m.any():
            edge = np.flatnonzero(np.diff(np.r_[False, m, False]))
            found += [(int(rows[r]), int(a) * step, (int(b) - 1) * step) for a, b in zip(edge[::2], edge[1::2])]
    return found


def _bucket(length: int, step: int = 1):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["anchor", "shape", "digest"], ignore_index=True)
        shape = pdf["shape"].to_numpy(np.int64)
        found = repeated_windows(
            pdf["segment"].tolist(), shape & 0xFFFF, shape >> 16, pdf["anchor"].to_numpy(), pdf["copies"].to_numpy(), length, step
        )
        row, first, last = (np.array(x, np.int64) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
        out = pdf.loc[row, ["anchor", "shape", "digest"]].reset_index(drop=True)
        return out.assign(first=first, last=last)

    return run


def _cut(code: Coder | None = None):
    """The text of the segments asked of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            rows = []
            for text, asked in zip(common.texts(batch.column("text")), batch.column("wanted").to_pylist()):
                text = code(text) if code else text
                rows += [x | {"segment": text[x["start"] : x["start"] + x["size"]]} for x in asked]
            yield pa.RecordBatch.from_pylist(rows, _CUT)

    return run


_CUT = pa.schema([("anchor", pa.int64()), ("shape", pa.int32()), ("digest", pa.int64()), ("copies", pa.int64()), ("segment", pa.binary())])


def _explode_windows(length: int, step: int = 1):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.to_pylist():
                text, count = x.pop("segment"), x["shape"] >> 16
                digest = {i: blake2b(text[i : i + length], digest_size=16).digest() for i in range(0, count, step)}
                yield pa.RecordBatch.from_pylist([x | {"first": i, "window": d} for i, d in digest.items()], _WINDOW)

    return run


_WINDOW = pa.schema([
    ("anchor", pa.int64()), ("shape", pa.int32()), ("digest", pa.int64()), ("copies", pa.int64()), ("first", pa.int64()), ("window", pa.binary()),
])


def repeated_spans(docs: DataFrame, length: int = LENGTH, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """(doc_id, text_key, spans): per row of docs with repeats, the byte ranges to remove, unmerged."""
    ship_package(docs.sparkSession)
    return _keyed_spans(keyed(docs), length, split_rows)


def word_codes(text: bytes) -> bytes:
    """``CODE`` ASCII characters for each word, of 6 bits each from the hash of the word."""
    shifts = np.arange(0, 6 * CODE, 6, dtype=np.uint64)
    return (((word_hashes(text)[:, None] >> shifts) & np.uint64(63)) + np.uint64(48)).astype(np.uint8).tobytes()


def word_spans(text: bytes, spans: list[dict]) -> list[dict]:
    """Spans of word codes as spans of the text: whole words, with the space up to the next."""
    is_word = np.ones(len(text) + 2, bool)
    is_word[1:-1] = ~np.isin(np.frombuffer(text, np.uint8), list(b" \t\n\x0b\x0c\r"))
    is_word[[0, -1]] = False
    start = np.flatnonzero(is_word[1:] & ~is_word[:-1])
    edges, out = np.r_[start, len(text)], []
    for x in spans or ():
        first, last = -(-x["low"] // CODE), x["high"] // CODE
        out.append({"low": int(edges[first]), "high": int(edges[last])})
    return out


def repeated_word_spans(docs: DataFrame, words: int = PASSAGE_WORDS, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """As repeated_spans, for runs of at least ``words`` words; the ranges are of word codes."""
    ship_package(docs.sparkSession)
    return _keyed_spans(keyed(docs), CODE * words, split_rows, word_codes, CODE)


def _keyed_spans(docs: DataFrame, length: int, split_rows: int, code: Coder | None = None, step: int = 1) -> DataFrame:
    """repeated_spans of rows that have their keys, or of the codes of their texts, with windows at multiples of ``step``.

    Codes are made by the function that reads them: a column of its own would put two Python workers beside each task.
    """
    spark, gram = docs.sparkSession, max(1, length // step // 3) * step
    segments = stage(docs.mapInArrow(_segments(length, gram, code, step), _SEGMENT), "segments")
    # Written, so that the join deals out both sides by itself and can split an anchor that very many segments share.
    repeated = stage(segments.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "repeated")
    same = ["anchor", "shape", "digest"]
    candidates = stage(segments.join(repeated, "anchor"), "candidates")
    common.discard(spark, common.folder_of(segments))
    distinct = candidates.groupBy(*same).agg(
        F.count("*").alias("copies"), F.min(F.struct("doc_id", "text_key", "start")).alias("example")
    )
    size = F.shiftright("shape", 16) + F.lit(length - 1)
    wanted = (
        distinct.select("example.doc_id", "example.text_key", F.struct(*same, "copies", F.col("example.start").alias("start"), size.alias("size")).alias("one"))
        .groupBy("doc_id", "text_key")
        .agg(F.collect_list("one").alias("wanted"))
    )
    one_each = docs.alias("d").join(wanted.alias("w"), same_row("d", "w")).select("w.doc_id", "w.text_key", "text", "wanted")
    cut = "anchor long, shape int, digest long, copies long, segment binary"
    strings = stage(one_each.select("text", "wanted").mapInArrow(_cut(code), cut).dropDuplicates(same), "strings")

    crowded = strings.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > split_rows).select("anchor")
    crowded = stage(crowded, "crowded")
    buckets = max(1, strings.count() // BUCKET_ROWS)
    usual = strings.join(crowded, "anchor", "left_anti").withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
    found = usual.groupBy("bucket").applyInPandas(_bucket(length, step), "anchor long, shape int, digest long, first long, last long")
    windows = strings.join(crowded, "anchor", "left_semi").mapInArrow(
        _explode_windows(length, step), "anchor long, shape int, digest long, copies long, first long, window binary"
    )
    twice = windows.groupBy("window").agg(F.sum("copies").alias("n")).where("n > 1").select("window")
    found = found.unionByName(windows.join(twice, "window").select(*same, "first", F.col("first").alias("last")))
    found = stage(found, "repeats")
    span = F.struct((F.col("start") + F.col("first")).alias("low"), (F.col("start") + F.col("last") + length).alias("high"))
    return (
        candidates.join(found, same).select("doc_id", "text_key", span.alias("span"))
        .groupBy("doc_id", "text_key").agg(F.collect_set("span").alias("spans"))
    )


def merge_spans(spans: list[dict]) -> list[tuple[int, int]]:
    merged: list[list[int]] = []
    for low, high in sorted((s["low"], s["high"]) for s in spans or ()):
        if merged and low <= merged[-1][1]:
            merged[-1][1] = max(high, merged[-1][1])
        else:
            merged.append([low, high])
    return [(low, high) for low, high in merged]


def kept_bytes(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for span in spans for x in span), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


_RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
    ("n_passages", pa.int64()), ("n_passage_bytes", pa.int64()),
])


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in slices(whole)):
        rows = []
        lists = (batch.column(c).to_pylist() for c in ("doc_id", "spans", "runs"))
        for text, doc_id, spans, runs in zip(common.texts(batch.column("text")), *lists):
            merged = merge_spans(spans)
            kept = kept_bytes(text, merged)
            passages = merge_spans(word_spans(text, runs)) if runs else []
            covered = sum(high - low for low, high in passages)
            rows.append((doc_id, len(text), len(text) - len(kept), len(merged), sha256(kept).hexdigest(), len(passages), covered))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _RESULT.types)], schema=_RESULT) if rows else pa.RecordBatch.from_pylist([], _RESULT)


def _written(spans: DataFrame, name: str) -> DataFrame:
    path = staging_path(spans.sparkSession, name)
    spans.write.parquet(path)
    return spans.sparkSession.read.schema(spans.schema).parquet(path)


def removal_report(docs: DataFrame, length: int = LENGTH, split_rows: int = SPLIT_ROWS, words: int = PASSAGE_WORDS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row, then n_passages and n_passage_bytes.

    The last two tell of passages of at least ``words`` words that occur more than once in the table, whatever their case and
    spaces, most of which are shorter than ``length`` bytes and so are not removed: how many there are in the row, and their bytes with the space up to the next word.

    Null and empty texts lose nothing, nor do those below ``length`` bytes. Repeated rows are repeats of each
    other. Null ids are kept. An empty table gives no rows. Further columns are ignored.
    """
    spark, rows = docs.sparkSession, keyed(docs)
    # What either search stages is deleted before the next one begins.
    with staged_since(spark):
        spans = _written(repeated_spans(docs, length, split_rows), "spans")
    with staged_since(spark):
        runs = _written(repeated_word_spans(docs, words, split_rows).withColumnRenamed("spans", "runs"), "runs")
    joined = rows.alias("d").join(spans.alias("s"), same_row("d", "s"), "left").join(runs.alias("r"), same_row("d", "r"), "left")
    columns = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passages long, n_passage_bytes long"
    return joined.select("d.doc_id", "d.text", "spans", "runs").mapInArrow(_summary, columns)


_SPANS = "array<struct<low: bigint, high: bigint>>"


def without_repeats(docs: DataFrame, length: int = LENGTH, split_rows: int = SPLIT_ROWS, words: int | None = None) -> DataFrame:
    """docs with the repeated bytes taken out of ``text``, and ``n_chars``, if there, counted again.

    With ``words``, repeated runs of that many words go as well, whatever their case and spaces.
    A character of which only some bytes are removed goes. All other columns stay as they are; null texts stay null.
    """

    ship_package(docs.sparkSession)

    @F.arrow_udf("string")
    def cut(text: pa.Array, spans: pa.Array, runs: pa.Array) -> pa.Array:
        out = []
        for raw, asked, run in zip(common.texts(text), spans, runs):
            found = (asked.as_py() or []) + (word_spans(raw, run.as_py()) if run.is_valid else [])
            out.append(kept_bytes(raw, merge_spans(found)).decode("utf-8", "ignore"))
        return pa.array(out, pa.string())

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_key"),
        F.col("text").cast("string").alias("text"), F.struct("*").alias("row"),
    )
    spans = repeated_spans(docs, length, split_rows).withColumn("runs", F.lit(None).cast(_SPANS))
    if words:
        runs = repeated_word_spans(docs, words, split_rows).select("doc_id", "text_key", F.lit(None).cast(_SPANS).alias("spans"), F.col("spans").alias("runs"))
        # A row has at most one of each.
        spans = spans.unionByName(runs).groupBy("doc_id", "text_key").agg(F.max_by("spans", F.col("spans").isNotNull()).alias("spans"), F.max_by("runs", F.col("runs").isNotNull()).alias("runs"))
    joined = rows.alias("d").join(spans.alias("s"), same_row("d", "s"), "left")
    text = F.when(F.col("spans").isNull() & F.col("runs").isNull(), F.col("d.text")).otherwise(cut("d.text", "spans", "runs"))
    changed = {"text": F.col("cut_text"), "n_chars": F.length("cut_text")}
    return joined.select("row", text.alias("cut_text")).select(
        [changed.get(f.name, F.col("row")[f.name]).cast(f.dataType).alias(f.name) for f in docs.schema]
    )
