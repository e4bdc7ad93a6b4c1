"""Writers. All are safe to repeat: running one again for the same input leaves the same table."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _hadoop(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _hadoop(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _hadoop(spark, path)
    fs.delete(where, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, as the file system has them; none if there is no folder."""
    fs, where = _hadoop(spark, path)
    return [x.getPath().getName() for x in fs.listStatus(where)] if fs.exists(where) else []


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder, or raise."""
    fs, where = _hadoop(spark, source)
    _move(fs, where, _hadoop(spark, target)[1])


def _child(spark: SparkSession, folder: str, name: str):
    """Path(parent, child) takes the name literally, whatever characters were escaped in it."""
    return spark._jvm.org.apache.hadoop.fs.Path(_hadoop(spark, folder)[1], name)


def _move(fs, source, target) -> None:
    """Rename or raise: Hadoop only returns false, and it moves into a target that is a folder already."""
    if fs.exists(target) or not fs.rename(source, target):
        raise OSError(f"could not move {source} to {target}")


def recover_days(spark: SparkSession, path: str) -> list[str]:
    """Put back days that a writer which died had moved away without a new folder in their place, and clear its leftovers.

    Returns the days put back. Writers call it first; a table has one writer at a time.
    """
    fs, back = _hadoop(spark, path)[0], []
    for left in names_in(spark, path):
        if left.startswith("_old-"):
            for name in names_in(spark, f"{path}/{left}"):
                if not fs.exists(_child(spark, path, name)):
                    _move(fs, _child(spark, f"{path}/{left}", name), _child(spark, path, name))
                    back.append(name)
    for left in names_in(spark, path):
        if left.startswith(("_old-", "_fresh-")):
            fs.delete(_hadoop(spark, f"{path}/{left}")[1], True)
    return back


def _replace_days(df: DataFrame, path: str, day: str, genre: str) -> None:
    """Write ``df`` partitioned by (day, genre) and put its days in the place of those in the table.

    Everything is first written to a folder beside the table's days, which readers pass over. Only then each day's
    folder is swapped, by the name it got in the write: the old one is moved away, the new one moved in. If the second move
    fails, the old day is put back at once; if the job dies in between, the next writer does so. Old days are deleted
    when all are swapped. So a job that fails loses no day, a rewritten
    day keeps no stale genre, and days not in ``df`` stay. The rebalance hint splits a (day, genre) with many rows
    over as many writers as its size asks for.
    """
    spark, run = df.sparkSession, uuid.uuid4().hex
    fresh, old = f"{path}/_fresh-{run}", f"{path}/_old-{run}"
    fs, _ = _hadoop(spark, path)
    recover_days(spark, path)
    try:
        df.hint("rebalance", day, genre).write.option("compression", "snappy").partitionBy(day, genre).parquet(fresh)
        for name in names_in(spark, fresh):
            if name.startswith(f"{day}="):
                new, there, gone = (_child(spark, root, name) for root in (fresh, path, old))
                if fs.exists(there):
                    fs.mkdirs(_hadoop(spark, old)[1])
                    _move(fs, there, gone)
                try:
                    _move(fs, new, there)
                except Exception:
                    if fs.exists(gone) and not fs.exists(there):
                        _move(fs, gone, there)
                    raise
    except Exception:
        recover_days(spark, path)
        raise
    for folder in (fresh, old):
        fs.delete(_hadoop(spark, folder)[1], True)


def write_curated(df: DataFrame, path: str) -> None:
    """Replace every day present in ``df``, partitioned by (dt, derived_genre)."""
    _replace_days(df, path, "dt", "derived_genre")


def write_gold(df: DataFrame, path: str, split_date: str | None = None, side: str = "both") -> None:
    """Replace every day present in ``df``; ``side`` picks rows up to (or without a day) or after ``split_date``."""
    if split_date and side != "both":
        late = F.coalesce(F.col("trend_date") > split_date, F.lit(False))
        df = df.where(~late) if side == "upto" else df.where(late)
    _replace_days(df, path, "trend_date", "derived_genre")


def register_partitions(spark: SparkSession, table: str) -> None:
    spark.sql(f"MSCK REPAIR TABLE {table}")


def upsert_baseline(old: DataFrame, new: DataFrame) -> DataFrame:
    """Last write per ``genre_hour`` wins; on equal times the new row does."""
    both = old.select("*", F.lit(0).alias("_gen")).unionByName(new.select("*", F.lit(1).alias("_gen")))
    row = F.struct(*[c for c in old.columns if c != "genre_hour"])
    return (
        both.groupBy("genre_hour")
        .agg(F.max_by(row, F.struct("updated_at", "_gen")).alias("r"))
        .select(*["genre_hour" if c == "genre_hour" else f"r.{c}" for c in old.columns])
    )


def write_baseline(df: DataFrame, root: str) -> str:
    """Publish a new baseline version, so readers never see a half-written table."""
    return publish_version(df, root)


def update_baseline(new: DataFrame, root: str) -> str:
    """Upsert ``new`` into the newest baseline under ``root``; updates of other writers at the same time are kept."""
    spark = new.sparkSession
    return update_version(spark, root, lambda path: upsert_baseline(spark.read.schema(new.schema).parquet(path), new) if path else new)


#: The day of an anomaly in its table, from when it was scored, and for how many days its rows live.
ANOMALY_DAY = "score_day"
KEEP_DAYS = 30


def append_anomalies(df: DataFrame, path: str, keep_days: int = KEEP_DAYS) -> None:
    """Append the rows whose ``anomaly_id`` the table does not hold yet, laid out by the day they were scored.

    What was scored before may be scored again on a later day. Rows live ``keep_days``, so only that many days around those
    of the new rows are read, however old the table is. Writers that append the same rows at the same time may both find them
    new; :func:`read_anomalies` gives each once.
    """
    spark = df.sparkSession
    rows = df.withColumn(ANOMALY_DAY, F.to_date(F.try_to_timestamp(F.col("score_ts").cast("string")))).dropDuplicates(["anomaly_id"])
    first, last = rows.agg(F.min(ANOMALY_DAY), F.max(ANOMALY_DAY)).first()
    if exists(spark, path):
        near = F.col(ANOMALY_DAY).isNull()
        if first is not None:
            kept = timedelta(days=keep_days)
            near = near | F.col(ANOMALY_DAY).between(F.lit(first - kept), F.lit(last + kept))
        held = spark.read.schema(rows.schema).parquet(path).where(near)
        rows = rows.join(held.select("anomaly_id"), "anomaly_id", "left_anti").select(*rows.columns)
    rows.write.mode("append").partitionBy(ANOMALY_DAY).parquet(path)


def read_anomalies(spark: SparkSession, path: str, schema: T.StructType, since: date | None = None) -> DataFrame:
    """Each anomaly once, those scored from the day ``since`` on."""
    table = spark.read.schema(T.StructType([*schema.fields, T.StructField(ANOMALY_DAY, T.DateType())])).parquet(path)
    if since is not None:
        table = table.where(F.col(ANOMALY_DAY) >= F.lit(since))
    return table.dropDuplicates(["anomaly_id"]).select(*schema.names)


def expire_anomalies(spark: SparkSession, path: str, now: datetime, keep_days: int = KEEP_DAYS) -> list[date]:
    """Delete the folders of days whose rows have all expired at ``now``; returns those days.

    A row expires ``keep_days`` after it was scored, so a day goes when its end is that old. What has expired of the day after it
    is for :func:`trendloom.operators.anomalies.ttl_filter`. Rows without a time stay.
    """
    fs, gone = _hadoop(spark, path)[0], []
    for name in names_in(spark, path):
        key, _, value = name.partition("=")
        if key == ANOMALY_DAY and value[:1].isdigit():
            day = date.fromisoformat(value)
            if datetime(day.year, day.month, day.day) + timedelta(days=keep_days + 1) <= now:
                fs.delete(_child(spark, path, name), True)
                gone.append(day)
    return sorted(gone)


def write_report(df: DataFrame, path: str, volume: str = "search_count") -> None:
    """CSV with a header, largest volume first."""
    df.orderBy(F.desc(volume), F.asc(df.columns[0])).write.mode("overwrite").option("header", "true").csv(path)


class VersionTaken(Exception):
    """Another writer published a version meanwhile."""


_MARKERS = "_current"
#: Seconds after which a marker without content counts as left by a writer that died.
_MARKER_PATIENCE = 10.0


def _markers(spark: SparkSession, root: str) -> dict[int, str]:
    """Folder of each version by its number; empty where a marker has no content (yet)."""
    fs, out = _hadoop(spark, root)[0], {}
    for name in names_in(spark, f"{root}/{_MARKERS}"):
        if name.startswith("v-"):
            stream = fs.open(_child(spark, f"{root}/{_MARKERS}", name))
            out[int(name[2:])] = stream.readLine() or ""
            stream.close()
    return out


def _settled_markers(spark: SparkSession, root: str) -> dict[int, str]:
    """The markers, once the last one has content or has had time enough to get it."""
    until = time.monotonic() + _MARKER_PATIENCE
    while True:
        markers = _markers(spark, root)
        if not markers or markers[max(markers)] or time.monotonic() > until:
            return markers
        time.sleep(0.2)


def publish_version(df: DataFrame, root: str, after: str | None = "") -> str:
    """Write ``df`` to a fresh folder under ``root`` and make it the current version; returns its path.

    Versions are numbered. A version counts once its marker names its folder, so readers never see a half-written one. A marker is a file
    made with overwriting off, so of two writers that reach for a number one gets it. ``after`` names
    the version that ``df`` was made from, None for none: if another was published meanwhile, :class:`VersionTaken` is raised and nothing
    is changed. Without ``after`` the next free number is taken. The file system must make files exclusively, as HDFS
    does; on an object store without that, one writer at a time.
    """
    spark = df.sparkSession
    fs, _ = _hadoop(spark, root)
    name = f"data-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{name}")
    while True:
        markers = _settled_markers(spark, root)
        number = max(markers, default=0) + 1
        taken = after != "" and after != _newest(root, markers)
        if not taken:
            try:
                stream = fs.create(_child(spark, f"{root}/{_MARKERS}", f"v-{number:012d}"), False)
            except Exception:
                if not fs.exists(_child(spark, f"{root}/{_MARKERS}", f"v-{number:012d}")):
                    raise
                continue
            stream.writeBytes(name)
            stream.close()
            return f"{root}/{name}"
        fs.delete(_hadoop(spark, f"{root}/{name}")[1], True)
        raise VersionTaken(f"{root} has a version after {after}")


def _newest(root: str, markers: dict[int, str]) -> str | None:
    full = [n for n, folder in markers.items() if folder]
    return f"{root}/{markers[max(full)]}" if full else None


def resolve_version(spark: SparkSession, root: str) -> str | None:
    """Path of the newest version under ``root``, None without any."""
    return _newest(root, _markers(spark, root))


def update_version(spark: SparkSession, root: str, change: Callable[[str | None], DataFrame], tries: int = 20) -> str:
    """Publish ``change(current version)``, made anew from the newest version as long as others publish meanwhile.

    So an update is never lost to another one: each is made from all before it.
    """
    for _ in range(tries):
        current = resolve_version(spark, root)
        try:
            return publish_version(change(current), root, after=current)
        except VersionTaken as taken:
            last = taken
    raise last


def prune_versions(spark: SparkSession, root: str, keep: int = 3) -> int:
    """Delete all but the newest ``keep`` versions; returns how many went. Readers of older ones must be done."""
    fs, markers = _hadoop(spark, root)[0], _markers(spark, root)
    old = sorted(n for n, folder in markers.items() if folder)[: -max(keep, 1)]
    for number in old:
        fs.delete(_child(spark, root, markers[number]), True)
        fs.delete(_child(spark, f"{root}/{_MARKERS}", f"v-{number:012d}"), False)
    return len(old)
