"""Session set-up and the shared staging folder."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# What a session made here starts with; a session made elsewhere keeps its own settings.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "trendloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def utc(spark: SparkSession) -> SparkSession:
    """The session itself if its clock is UTC, else one beside it that shares everything but its settings."""
    if spark.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        return spark
    settings = {k: v for k, v in spark.conf.getAll.items() if spark.conf.isModifiable(k)}
    beside = spark.newSession()
    for key, value in {**settings, "spark.sql.session.timeZone": "UTC"}.items():
        beside.conf.set(key, value)
    return beside


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, for operators whose Python code runs in tasks; once per application.

    Where the package is not in a folder of its own, it was installed or sent already.
    """
    package = Path(__file__).parent
    application = spark.sparkContext.applicationId
    if application in _shipped or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="spark-trendloom-")) / "trendloom.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*")):
            if file.suffix in (".py", ".json"):
                out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``. Where it is unset, a local session gets a temporary one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="spark-trendloom-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def passing_path(spark: SparkSession, name: str) -> str:
    """A staging path that goes with what the enclosing :func:`staged_since` stages."""
    path = staging_path(spark, name)
    for held in _held:
        held.append(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several branches read the same intermediate. It cuts the lineage, survives the
    loss of executors, and gives Catalyst true sizes for its join choices.
    """
    path = passing_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_held: list[list[str]] = []


@contextmanager
def staged_since(spark: SparkSession) -> Iterator[None]:
    """Delete at the end whatever the enclosed lines staged; for work whose results are written elsewhere by then."""
    paths: list[str] = []
    _held.append(paths)
    try:
        yield
    finally:
        _held.remove(paths)
        for path in paths:
            discard(spark, path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
