"""What a stream has learned about keywords: small batch folders, merged into numbered versions, with an age."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.schemas import UNKNOWN
from trendloom.sources.sinks import delete, names_in, prune_versions, publish_version, resolve_version

LABEL = "keyword_norm string, derived_genre string, n bigint, source string, lookup string, asked_at timestamp"
RULES, PROVIDER = "rules", "provider"

MERGE_EVERY = 20
ASK_AGAIN = timedelta(days=1)


def lookup_mark(*lookups: DataFrame | None) -> str:
    """A mark of the lookups' contents; it changes with any entry, not with the order of rows or files."""
    parts = []
    for lut in lookups:
        if lut is None:
            parts.append("none")
        else:
            mark = lut.agg(F.count("*"), F.bit_xor(F.xxhash64("keyword", "genre", "ordinal"))).first()
            parts.append(f"{mark[0]}:{mark[1]}")
    return "/".join(parts)


class LabelStore:
    """Labels by keyword under ``root``. One writer at a time, such as the one query that owns the store.

    Each batch has a folder of its own, which a batch run again overwrites. Once there are ``merge_every`` of them they are merged with the
    newest version into a new one and deleted, so that reading takes at most that many folders and a version, however long
    the stream runs. A merge that breaks off leaves its folders; keywords then stand twice until the next one, and the newest label counts.
    """

    def __init__(self, spark: SparkSession, root: str, merge_every: int = MERGE_EVERY, ask_again: timedelta = ASK_AGAIN):
        self.spark, self.root, self.merge_every, self.ask_again = spark, root, merge_every, ask_again

    def _batches(self) -> list[str]:
        return [n for n in names_in(self.spark, f"{self.root}/batches") if n.startswith("batch_id=")]

    def folders(self) -> list[str]:
        """What a read opens."""
        version = resolve_version(self.spark, f"{self.root}/merged")
        return ([version] if version else []) + [f"{self.root}/batches/{n}" for n in self._batches()]

    def read(self, before: int | None = None) -> DataFrame:
        """The newest label of each keyword, of those learned before batch ``before``."""
        names = [n for n in self._batches() if before is None or int(n.partition("=")[2]) < before]
        version = resolve_version(self.spark, f"{self.root}/merged")
        paths = ([version] if version else []) + [f"{self.root}/batches/{n}" for n in names]
        rows = self.spark.read.schema(LABEL).parquet(*paths) if paths else self.spark.createDataFrame([], LABEL)
        label = F.struct("derived_genre", "n", "source", "lookup", "asked_at")
        return rows.groupBy("keyword_norm").agg(F.max_by(label, F.struct("asked_at", "source")).alias("l")).select("keyword_norm", "l.*")

    def settled(self, mark: str, now: datetime) -> Column:
        """Whether a stored label stands: made with the present lookups, and not an UNKNOWN that has been asked long ago."""
        recent = F.col("asked_at") > F.lit(now - self.ask_again)
        return (F.col("lookup") == mark) & ((F.col("derived_genre") != UNKNOWN) | recent)

    def add(self, labels: DataFrame, batch_id: int) -> DataFrame:
        """Keep what a batch has learned; returns it as kept."""
        path = f"{self.root}/batches/batch_id={batch_id}"
        labels.select(*[f.partition(" ")[0] for f in LABEL.split(", ")]).write.mode("overwrite").parquet(path)
        return self.spark.read.schema(LABEL).parquet(path)

    def merge(self, upto: int) -> bool:
        """Merge the folders of batches before ``upto`` if there are ``merge_every``; those are committed and don't come again."""
        names = [n for n in self._batches() if int(n.partition("=")[2]) < upto]
        if len(names) < self.merge_every:
            return False
        publish_version(self.read(before=upto), f"{self.root}/merged")
        for name in names:
            delete(self.spark, f"{self.root}/batches/{name}")
        prune_versions(self.spark, f"{self.root}/merged", keep=2)
        return True
