"""Drop lines that many documents share, with the counts of lines kept in levelled sorted runs.

A line's key is the line without whitespace at both ends, A-Z as a-z; runs hold 128 bits of its hash and the number of
documents that have it.

1. Documents are dealt into batches (or bring their own, such as the day they came). One pass hashes their lines, each
   key once for a document, and adds up equal keys in each task. The counts of all batches are shuffled once and written
   in buckets, sorted by key.
2. Batches are taken one after the other. A key that a run already knows to be common needs no more counting, so the batch
   is merge-anti-joined with the runs; what is left is written as a run of the lowest level. Runs and batches
   share their buckets and order, so these joins move no rows.
3. When a level has ``fanout`` runs they are compacted: merged into one run of the next level, with their counts added.
4. At the end all runs are merged. Keys of documents that are common are looked up among the lines, gathered for each
   document, and the document is written without those lines.

Each document belongs to one batch, so counts over runs add up, and results do not depend on the batches.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.llm import common
from trendloom.llm.common import row_key, ship_package, slices, stage
from trendloom.session import discard, staging_path

MIN_DOCUMENTS = 10
MIN_CHARS = 1
BATCHES = 8
FANOUT = 4

_SPACES = common.SPACES.encode()
#: Counts that a task holds before it passes them on.
_HELD = 200_000


def line_key(line: bytes) -> bytes:
    return line.strip(_SPACES).lower()


def _long_enough(key: bytes, least: int) -> bool:
    """Whether the key has ``least`` code points."""
    if len(key) < least or len(key) >= 4 * least:
        return len(key) >= least
    return sum(b & 0xC0 != 0x80 for b in key) >= least


def line_digests(text: bytes, least: int) -> list[bytes | None]:
    """16 bytes for the key of every line, None for keys that are too short."""
    keys = map(line_key, text.split(b"\n"))
    return [xxhash.xxh3_128_digest(k) if _long_enough(k, least) else None for k in keys]


def _halves(digests: list[bytes]) -> tuple[pa.Array, pa.Array]:
    both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    return pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())


def _counted(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(batch, h1, h2, documents): how many documents have the line, in parts that still have to be added up."""
        held: dict[int, Counter] = {}

        def passed_on() -> Iterator[pa.RecordBatch]:
            for number, counts in held.items():
                n = pa.array(counts.values(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(counts), pa.int32()), *_halves(list(counts)), n], ["batch", "h1", "h2", "documents"])
            held.clear()

        for batch in (part for whole in batches for part in slices(whole)):
            for number, text in zip(batch.column("batch").to_pylist(), common.texts(batch.column("text"))):
                held.setdefault(number, Counter()).update(set(line_digests(text, least)) - {None})
            if sum(map(len, held.values())) > _HELD:
                yield from passed_on()
        yield from passed_on()

    return run


class LineRuns:
    """Runs of (h1, h2, documents), each bucketed and sorted by key, by level; the lowest takes new batches.

    A run is a table of its own in the shared folder. Runs that were compacted are deleted; ``clear`` deletes the rest.
    """

    def __init__(self, spark: SparkSession, buckets: int, min_documents: int = MIN_DOCUMENTS, fanout: int = FANOUT):
        if fanout < 2:
            raise ValueError("fanout must be 2 at least")
        self.spark, self.buckets, self.min_documents, self.fanout = spark, buckets, min_documents, fanout
        self.levels: list[list[str]] = [[]]
        self._paths: dict[str, str] = {}

    def write(self, counts: DataFrame, *partitions: str) -> str:
        """Write rows that are already dealt into the buckets; returns the name of the table."""
        path = staging_path(self.spark, "lines")
        name = path.rpartition("/")[2].replace("-", "_")
        out = counts.write.format("parquet").option("path", path)
        out = out.partitionBy(*partitions) if partitions else out
        out.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").saveAsTable(name)
        self._paths[name] = path
        return name

    def forget(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        discard(self.spark, self._paths.pop(name))

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def add(self, batch: DataFrame) -> None:
        """Add a batch (h1, h2, documents) in the buckets of the runs, one row for each key."""
        for name in self.runs():
            settled = self.spark.table(name).where(F.col("documents") >= self.min_documents)
            batch = batch.join(settled, ["h1", "h2"], "left_anti")
        self.levels[0].append(self.write(batch))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            self._compact(level)
            level += 1

    def merged(self, names: list[str]) -> DataFrame:
        """(h1, h2, documents) of some runs, the documents of a key added."""
        # Read as plain files: Spark 4.1.2 takes a union of bucketed tables for dealt by key, yet does not bring equal buckets together.
        files = [self.spark.read.schema(self.spark.table(name).schema).parquet(self._paths[name]) for name in names]
        dealt = reduce(DataFrame.unionByName, files).repartition(self.buckets, "h1", "h2")
        return dealt.groupBy("h1", "h2").agg(F.sum("documents").alias("documents"))

    def _compact(self, level: int) -> None:
        old = self.levels[level]
        if len(self.levels) == level + 1:
            self.levels.append([])
        self.levels[level + 1].append(self.write(self.merged(old)))
        self.levels[level] = []
        for name in old:
            self.forget(name)

    def common(self) -> DataFrame:
        """(h1, h2) of the keys that ``min_documents`` documents have."""
        return self.merged(self.runs()).where(F.col("documents") >= self.min_documents).select("h1", "h2")

    def clear(self) -> None:
        for name in list(self._paths):
            self.forget(name)
        self.levels = [[]]


def common_lines(
    rows: DataFrame, min_documents: int = MIN_DOCUMENTS, min_chars: int = MIN_CHARS, batches: int = BATCHES, fanout: int = FANOUT
) -> DataFrame:
    """(h1, h2) of the line keys that ``min_documents`` of the rows (batch, text) have, written to the shared folder."""
    spark = rows.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = LineRuns(spark, buckets, min_documents, fanout)
    try:
        parts = rows.mapInArrow(_counted(min_chars), "batch int, h1 long, h2 long, documents long").repartition(buckets, "h1", "h2")
        counted = runs.write(parts.groupBy("batch", "h1", "h2").agg(F.sum("documents").alias("documents")), "batch")
        for number in range(batches):
            runs.add(spark.table(counted).where(F.col("batch") == number).drop("batch"))
        return stage(runs.common(), "common-lines")
    finally:
        runs.clear()


def _lines_of(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id_key, text_key, h1, h2): each key of a row once."""
        for batch in (part for whole in batches for part in slices(whole)):
            found = [list(set(line_digests(t, least)) - {None}) for t in common.texts(batch.column("text"))]
            at = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]), pa.int64())
            h1, h2 = _halves([d for f in found for d in f])
            yield pa.RecordBatch.from_arrays([batch.column("id_key").take(at), batch.column("text_key").take(at), h1, h2], ["id_key", "text_key", "h1", "h2"])

    return run


_CUT = "struct<kept: string, dropped: long>"


def _cut(least: int):
    @F.arrow_udf(_CUT)
    def run(text: pa.Array, lines: pa.Array) -> pa.Array:
        """The text without the lines whose keys are listed, and how many those are; a null list lists nothing."""
        kept, dropped = [], []
        ends = np.concatenate([[0], np.cumsum(np.nan_to_num(lines.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))]).astype(int)
        inside = lines.flatten()
        view = np.stack([inside.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("h1", "h2")], axis=1).tobytes()
        for t, a, b in zip(common.texts(text), ends, ends[1:]):
            listed = {view[16 * i : 16 * i + 16] for i in range(a, b)}
            rows = t.split(b"\n")
            left = [row for row, d in zip(rows, line_digests(t, least)) if d not in listed]
            kept.append(b"\n".join(left))
            dropped.append(len(rows) - len(left))
        return pa.StructArray.from_arrays([pa.array(kept, pa.binary()).cast(pa.string()), pa.array(dropped, pa.int64())], ["kept", "dropped"])

    return run


def without_common_lines(
    docs: DataFrame,
    min_documents: int = MIN_DOCUMENTS,
    min_chars: int = MIN_CHARS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
    batch: Column | None = None,
) -> DataFrame:
    """(row, kept, n_lines, n_dropped): all columns of docs as a struct, its text without common lines, its lines before and those dropped.

    Keys of at least ``min_chars`` code points that stand in at least ``min_documents`` documents lose all their lines
    in every document. Every row is a document of its own, so repeated rows, whether or not ids repeat, count as often as
    they come; a line that a document repeats counts once. Null and empty texts are one empty line. Texts are taken
    whole, however long. ``batch`` numbers the batches from 0 to ``batches`` - 1; by default rows are dealt by
    hash. An empty table gives no rows; columns named like those used here do no harm.
    """
    ship_package(docs.sparkSession)
    rows = row_key(docs)
    text = F.col("row.text").cast("string")
    number = (F.pmod(F.xxhash64("id_key", "text_key"), F.lit(batches)) if batch is None else batch).cast("int")
    given = docs.select(number.alias("batch"), F.col("text").cast("string").alias("text")) if batch is not None else rows.select(number.alias("batch"), text.alias("text"))
    shared = common_lines(given, min_documents, min_chars, batches, fanout)
    lines = rows.select("id_key", "text_key", text.alias("text")).mapInArrow(_lines_of(min_chars), "id_key long, text_key long, h1 long, h2 long")
    hits = lines.join(shared, ["h1", "h2"]).groupBy("id_key", "text_key").agg(F.collect_set(F.struct("h1", "h2")).alias("lines"))
    joined = rows.join(stage(hits, "line-hits"), ["id_key", "text_key"], "left")
    cut = joined.select("row", "lines", _cut(min_chars)(F.when(F.col("lines").isNotNull(), text), F.col("lines")).alias("cut"))
    whole = F.coalesce(text, F.lit(""))
    return cut.select(
        "row",
        F.when(F.col("lines").isNotNull(), F.col("cut.kept")).otherwise(whole).alias("kept"),
        (F.length(whole) - F.length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.when(F.col("lines").isNotNull(), F.col("cut.dropped")).otherwise(F.lit(0)).cast("long").alias("n_dropped"),
    )


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 of every row; see :func:`without_common_lines`."""
    kept = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    return without_common_lines(docs).select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", kept)
