"""Helpers shared by the operators: row keys, staged tables, byte words and polynomial hashes."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.session import ship_package, stage

__all__ = ["stage", "ship_package", "source", "keyed", "free_name", "discard", "same_row", "folder_of"]

#: Whitespace of the word rule: words are runs of anything but space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text_key and text of every row.

    Rows are told apart by id and hash of the text together, so that null or repeated ids do no harm;
    rows that agree in both are copies of each other and share every result.
    """
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def same_row(a: str, b: str) -> Column:
    """Join condition on doc_id and text_key of two aliased frames; null ids match."""
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.text_key") == F.col(f"{b}.text_key"))


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def folder_of(df: DataFrame) -> str:
    """The folder a staged frame was read from."""
    return df.inputFiles()[0].rpartition("/")[0] if df.inputFiles() else ""


def discard(spark: SparkSession, folder: str) -> None:
    """Delete a staged table that nothing reads any more."""
    if folder:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def byte_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and the offsets of its rows; nulls are empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def texts(column: pa.Array) -> Iterable[bytes]:
    """The rows of a string column as bytes, one at a time; nulls are empty."""
    data, offsets = byte_column(column)
    view = memoryview(data)
    for i in range(len(offsets) - 1):
        yield bytes(view[offsets[i] : offsets[i + 1]])


# Polynomial hashes modulo 2^64. Every byte stands for a random odd number, and hash(i, n) of the
# bytes i to i + n is the sum of their numbers times powers of BASE. Taken from prefix sums, the hash
# of any substring costs two reads. Such hashes only propose: what they find equal is verified.
BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(20240131).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_power = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """BASE to the power of 0 to n - 1 at least."""
    global _power
    if len(_power) < n:
        grown = np.full(max(n, 2 * len(_power)), BASE, np.uint64)
        grown[0] = 1
        _power = np.multiply.accumulate(grown)
    return _power


def byte_numbers(lower: bool = False) -> np.ndarray:
    """The number of each byte; with lower, those of A-Z are those of a-z."""
    out = _BYTES.copy()
    if lower:
        out[65:91] = out[97:123]
    return out


def prefix_sums(numbers: np.ndarray) -> np.ndarray:
    out = np.zeros(len(numbers) + 1, np.uint64)
    out[1:] = numbers
    return _summed(out)


def byte_prefix_sums(table: np.ndarray, data: np.ndarray) -> np.ndarray:
    """prefix_sums of the numbers of bytes, without a second array of their size."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.take(table, data, out=out[1:], mode="clip")
    return _summed(out)


def _summed(out: np.ndarray) -> np.ndarray:
    out[1:] *= powers(len(out))[: len(out) - 1]
    return np.cumsum(out, out=out)


def slices(batch: pa.RecordBatch, rows: int = 500) -> Iterable[pa.RecordBatch]:
    """A batch in parts, so that what is made of a part is small whatever size batches have."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def substring_hash(prefix: np.ndarray, start: np.ndarray, length, top: int) -> np.ndarray:
    """Hashes of start to start + length. top: a constant above every start."""
    return (prefix[start + length] - prefix[start]) * powers(top + 1)[top - start]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the hash over all bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def word_lists(text: bytes, size: int = 1 << 20) -> Iterable[list[bytes]]:
    """The words of a text, lower-cased in A-Z, in lists of about ``size`` bytes so that long texts need little memory."""
    at = 0
    while at < len(text):
        end = min(len(text), at + size)
        while end < len(text) and text[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield text[at:end].lower().split()
        at = end


def row_key(docs: DataFrame) -> DataFrame:
    """docs as (id_key, text_key, row): two keys that are never null, and all columns as one struct."""
    text = F.col("text").cast("string")
    null_id = F.col("doc_id").isNull()
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id_key"),
        F.xxhash64(text, null_id).alias("text_key"),
        F.struct("*").alias("row"),
    )


def held_out(folds: int, fold: int) -> Column:
    """Whether crc32 of doc_id as text leaves ``fold`` when divided by ``folds``; false for null ids."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == fold, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, rows: int) -> DataFrame:
    """(text, y): about ``rows`` labelled documents outside the held-out fold, the same ones at every run.

    Ids are drawn by hash; if there are no more than ``rows``, all are taken. Null labels and ids do not count;
    of labels that disagree on an id the larger holds. The drawn ids are bounded by ``rows`` and broadcast, so
    that no text is shuffled.
    """
    ids = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(folds, fold))
    ids = ids.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(F.col(label).cast("int")).alias("y"))
    count = ids.count()
    share = int(min(1.0, rows / max(count, 1)) * (1 << 40))
    drawn = ids.where(F.pmod(F.xxhash64("id"), F.lit(1 << 40)) < share)
    texts_ = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts_.join(F.broadcast(drawn), "id").select("text", "y")
