"""Language of a text by prediction by partial matching.

For each language a context tree over bytes is kept: how often each byte followed each context of up to ``ORDER``
bytes. A byte is coded by its longest known context. If it never followed that context, an escape is coded, whose
probability comes from the number of different bytes seen there, and the next shorter context is tried, down to equal
odds for all bytes. The language whose tree gives a text the shortest code wins. The statistics are frozen after
training, so code lengths add up and are kept exactly, in whole units of 2^-16 bits.

Counts cover every training text, and with ``LEAST_COUNT`` 1 all of them are kept, so what is known grows with the corpus. Where that is more than
executors can hold, a larger count leaves out the bytes seen more rarely in a context; their counts add to the escape.

Trees are sent to the executors for as many languages at a time as ``MOST_ENTRIES`` allows. Further languages are scored in passes
of their own, and each text takes the best of all passes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.llm import common
from trendloom.llm.common import held_out, ship_package, stage

FOLDS, HELD_OUT_FOLD = 3, 1
ORDER = 3
LEAST_COUNT = 1
#: Entries of all trees of one pass, about 25 bytes each.
MOST_ENTRIES = 8_000_000
UNKNOWN = "und"
UNIT = 1 << 16

_PIECE = 1 << 20
_FLUSH = 1 << 22


def grams(text: bytes) -> Iterator[np.ndarray]:
    """For each byte the number made of it and the ORDER bytes before it; before the text stand line feeds."""
    for at in range(0, len(text), _PIECE):
        piece = text[max(0, at - ORDER) : at + _PIECE]
        piece = b"\n" * (ORDER - min(at, ORDER)) + piece
        data = np.frombuffer(piece, np.uint8).astype(np.uint32)
        code = np.zeros(len(data) - ORDER, np.uint32)
        for k in range(ORDER + 1):
            code = (code << np.uint32(8)) | data[k : len(data) - ORDER + k]
        yield code


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of the texts of a partition, given out whenever much has been gathered."""
    held: dict[str, list[np.ndarray]] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            gram, n = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram)), pa.array(gram.astype(np.int64)), pa.array(n)], ["lang", "gram", "n"])
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), common.texts(batch.column("text"))):
            for part in grams(text):
                held.setdefault(lang, []).append(part)
                size += len(part)
                if size > _FLUSH:
                    yield from flush()
                    size = 0
    yield from flush()


def context_counts(training: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """(lang, order, gram, n, context_n, context_kinds) of the entries that stay in the trees, written to the shared folder."""
    longest = training.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    longest = stage(longest, "grams")
    orders = F.explode(F.array([F.struct(F.lit(k).alias("order"), F.col("gram").bitwiseAND((1 << 8 * (k + 1)) - 1).alias("gram")) for k in range(ORDER + 1)]))
    entries = longest.select("lang", orders.alias("e"), "n").groupBy("lang", F.col("e.order").alias("order"), F.col("e.gram").alias("gram")).agg(F.sum("n").alias("n"))
    context = F.shiftright("gram", 8)
    contexts = entries.groupBy("lang", "order", context.alias("context")).agg(F.sum("n").alias("context_n"), F.count("*").alias("context_kinds"))
    kept = entries.where(F.col("n") >= least_count).withColumn("context", context)
    table = kept.join(contexts, ["lang", "order", "context"]).select("lang", "order", "gram", "n", "context_n", "context_kinds")
    return stage(table, "contexts")


class Tree:
    """The frozen context tree of one language."""

    def __init__(self, order: np.ndarray, gram: np.ndarray, n: np.ndarray, context_n: np.ndarray, kinds: np.ndarray) -> None:
        self.levels = []
        for k in range(ORDER + 1):
            mine = np.flatnonzero(order == k)
            mine = mine[np.argsort(gram[mine], kind="stable")]
            key, chance = gram[mine], n[mine] / (context_n[mine] + kinds[mine])
            context, first = np.unique(key >> 8, return_index=True)
            rest = 1 - np.add.reduceat(chance, first) if len(first) else chance
            self.levels.append((key, _units(chance), context, _units(np.maximum(rest, 2.0**-40))))

    def lengths(self, codes: np.ndarray) -> np.ndarray:
        """Code length of the last byte of each gram given the bytes before it."""
        out = np.zeros(len(codes), np.int64)
        open_ = np.arange(len(codes))
        for k in range(ORDER, -1, -1):
            key, cost, context, escape = self.levels[k]
            if not len(key):
                continue
            gram = codes[open_] & ((1 << 8 * (k + 1)) - 1)
            at = np.minimum(np.searchsorted(key, gram), len(key) - 1)
            hit = key[at] == gram
            out[open_[hit]] += cost[at[hit]]
            miss = gram[~hit] >> 8
            open_ = open_[~hit]
            at = np.minimum(np.searchsorted(context, miss), len(context) - 1)
            known = context[at] == miss
            out[open_[known]] += escape[at[known]]
        out[open_] += 8 * UNIT
        return out


def _units(chance: np.ndarray) -> np.ndarray:
    return np.rint(-np.log2(chance) * UNIT).astype(np.int64)


class Languages:
    def __init__(self, names: list[str], trees: list[Tree]) -> None:
        self.names, self.trees = names, trees

    def code_lengths(self, text: bytes) -> np.ndarray:
        """Of the text under each language, in units of 2^-16 bits."""
        total = np.zeros(len(self.trees), np.int64)
        for part in grams(text):
            codes, times = np.unique(part, return_counts=True)
            codes = codes.astype(np.int64)
            total += [int((tree.lengths(codes) * times).sum()) for tree in self.trees]
        return total

    def predict(self, text: bytes) -> tuple[str, int, float]:
        """The language of the shortest code, the first by name of equals; its length; and the odds of all languages here against it."""
        lengths = self.code_lengths(text)
        best = int(lengths.argmin())
        return self.names[best], int(lengths[best]), float(np.exp2(np.maximum((lengths[best] - lengths) / UNIT, -1000)).sum())


def passes(sizes: dict[str, int], most: int = MOST_ENTRIES) -> list[list[str]]:
    """The languages by name, as many together as have at most ``most`` entries; a larger one stands alone."""
    out, held = [], 0
    for name in sorted(sizes):
        if not out or held + sizes[name] > most:
            out.append([])
            held = 0
        out[-1].append(name)
        held += sizes[name]
    return out


def train(docs: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """The tables of all languages of the texts outside the held-out fold. Null languages and texts do not count."""
    ship_package(docs.sparkSession)
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(FOLDS, HELD_OUT_FOLD))
    return context_counts(known.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")), least_count)


def languages_of(table: DataFrame, names: list[str]) -> Languages:
    """The trees of some languages."""
    got = table.where(F.col("lang").isin(names)).toArrow()
    lang = np.array(got.column("lang").to_pylist(), object)
    columns = [got.column(c).to_numpy() for c in ("order", "gram", "n", "context_n", "context_kinds")]
    return Languages(names, [Tree(*(c[lang == name] for c in columns)) for name in names])


def language_column(text: Column, languages: Broadcast) -> Column:
    """struct(lang, length, odds) of a text column; see :meth:`Languages.predict`."""

    @F.arrow_udf("struct<lang: string, length: bigint, odds: double>")
    def predict(text: pa.Array) -> pa.Array:
        found = [languages.value.predict(t) for t in common.texts(text)]
        names, lengths, odds = zip(*found) if found else ((), (), ())
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(lengths, pa.int64()), pa.array(odds, pa.float64())], ["lang", "length", "odds"])

    return predict(text)


def _best_of_passes(rows: DataFrame, table: DataFrame, groups: list[list[str]]) -> DataFrame:
    """(id_key, text_key, found) of distinct rows: every pass writes what it finds, then the shortest code over all is taken."""
    spark, parts = rows.sparkSession, []
    for names in groups:
        languages = spark.sparkContext.broadcast(languages_of(table, names))
        parts.append(stage(rows.select("id_key", "text_key", language_column(F.col("text"), languages).alias("f")), "pass"))
        languages.destroy()
    each = reduce(DataFrame.unionByName, parts)
    least = F.min(F.struct("f.length", "f.lang")).alias("m")
    best = each.groupBy("id_key", "text_key").agg(least, F.collect_set("f").alias("all"))
    against = F.aggregate("all", F.lit(0.0), lambda acc, f: acc + f["odds"] * F.pow(F.lit(2.0), F.greatest((F.col("m.length") - f["length"]) / UNIT, F.lit(-1000.0))))
    return best.select("id_key", "text_key", F.struct(F.col("m.lang").alias("lang"), F.col("m.length").alias("length"), against.alias("odds")).alias("found"))


def identified(docs: DataFrame, least_count: int = LEAST_COUNT, most_entries: int = MOST_ENTRIES) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row.

    ``und`` with score 0 for null texts and those without a letter, and where no language was learned. Of languages
    with equal codes the first by name wins. Texts count whole, however long. Repeated rows get equal results, null ids count as not held out. An
    empty table gives no rows. Further columns are ignored.
    """
    table = train(docs, least_count)
    groups = passes({r.lang: r["count"] for r in table.groupBy("lang").count().collect()}, most_entries)
    text = F.col("text").cast("string")
    basic = [held_out(FOLDS, HELD_OUT_FOLD).alias("held_out"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letters")]
    if len(groups) <= 1:
        none = F.lit(None).cast("struct<lang: string, length: bigint, odds: double>")
        found = language_column(text, docs.sparkSession.sparkContext.broadcast(languages_of(table, groups[0]))) if groups else none
        rows = docs.select("doc_id", *basic, found.alias("found"))
    else:
        keyed = common.row_key(docs).select("id_key", "text_key", F.col("row.doc_id").alias("doc_id"), F.col("row.text").cast("string").alias("text"))
        best = stage(_best_of_passes(keyed.select("id_key", "text_key", "text"), table, groups), "languages")
        rows = keyed.select("id_key", "text_key", "doc_id", *basic).join(best, ["id_key", "text_key"])
    told = F.col("letters") & F.col("found").isNotNull()
    return rows.select(
        "doc_id", "held_out", F.when(told, F.col("found.lang")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(told, 1 / F.col("found.odds")).otherwise(0.0).alias("score"),
    )
