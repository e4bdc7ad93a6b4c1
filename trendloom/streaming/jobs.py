"""Streaming counterparts of the batch operators.

Every sink is a ``foreachBatch`` that overwrites the folder of its own batch id, so a batch run again after a
failure replaces what it wrote before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from trendloom.functions.devices import platform_group
from trendloom.functions.text import stream_keyword_norm
from trendloom.functions.timestamps import clean_datetime
from trendloom.operators import anomalies
from trendloom.operators.classification import classify_keywords, distinct_keywords, with_genre
from trendloom.operators.labelling import Provider, label_residual
from trendloom.schemas import RAW_PARTITIONS, STREAM_EVENT, UNKNOWN
from trendloom.session import stage, staged_since
from trendloom.sources.raw_events import decode_json_records
from trendloom.sources.sinks import delete, exists, move, names_in, resolve_version
from trendloom.streaming.bisect import MOST_DEAD, TRIES, bisected
from trendloom.streaming.label_store import ASK_AGAIN, MERGE_EVERY, PROVIDER, RULES, LabelStore, lookup_mark

ENRICHED_SCHEMA = STREAM_EVENT
SINK_SCHEMA = T.StructType(
    [f for f in STREAM_EVENT.fields if f.name not in RAW_PARTITIONS.names] + RAW_PARTITIONS.fields
)
SCORED_SCHEMA = T.StructType(
    [
        T.StructField("derived_genre", T.StringType()),
        T.StructField("hour_of_day_vn", T.IntegerType()),
        T.StructField("observed_count", T.LongType()),
        T.StructField("rolling_mean", T.DoubleType()),
        T.StructField("rolling_std", T.DoubleType()),
        T.StructField("z_score", T.DoubleType()),
        T.StructField("is_anomaly", T.BooleanType()),
        T.StructField("anomaly_type", T.StringType()),
    ]
)


def follow(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    files_per_batch: int | None = None,
    bytes_per_batch: str | None = None,
) -> DataFrame:
    """Stream of the Parquet files in ``path``; admission is limited by files, or by bytes such as ``64m``."""
    if files_per_batch and bytes_per_batch:
        raise ValueError("limit a micro-batch by files or by bytes")
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.parquet(path)


def _start(writer, checkpoint: str, available_now: bool, every: str) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return writer.trigger(**trigger).start()


def run_to_end(*queries: StreamingQuery) -> None:
    for q in queries:
        q.awaitTermination()


def start_raw_sink(
    stream: DataFrame,
    out: str,
    available_now: bool = False,
    every: str = "60 seconds",
    keys: Sequence[str] = tuple(RAW_PARTITIONS.names),
) -> StreamingQuery:
    """Decode base64 JSON records into the raw table ``out/data``, partitioned by batch and ``keys``.

    ``dt`` and ``hour`` are cut from the unrepaired text, as the raw layer keeps what it got.
    Records that do not decode go to ``out/dead``. The rebalance hint gathers the rows of a partition before the
    write, to avoid many tiny files, and splits a partition with many rows over several writers.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        good, dead = decode_json_records(batch, "data")
        keyed = good.withColumns({"dt": F.left("datetime", F.lit(10)), "hour": F.substring("datetime", 12, 2)})
        dead.write.mode("overwrite").parquet(f"{out}/dead/batch_id={batch_id}")
        keyed.hint("rebalance", *keys).write.mode("overwrite").partitionBy(*keys).parquet(f"{out}/data/batch_id={batch_id}")

    return _start(stream.writeStream.foreachBatch(write), f"{out}/_checkpoint", available_now, every)


_MERGED = "_merged-"


def merge_batches(
    spark: SparkSession, data: str, schema: T.StructType, before: int, least: int = 10, keys: Sequence[str] = tuple(RAW_PARTITIONS.names)
) -> int:
    """Merge the folders of batches before ``before`` into that of the last of them, if they are ``least`` at least; returns how many were merged.

    For a table that :func:`start_raw_sink` wrote, whose many small files are one lot for each batch and partition; afterwards
    there is one lot for each partition. Those batches must be committed, so that none comes again. The merged rows are first written aside. From then on the
    merge is only carried forward: a job that dies while it swaps folders is finished by the next call, and until then readers see rows missing but
    none twice.
    """
    finish_merges(spark, data)
    numbers = sorted(n for n in map(_batch_number, names_in(spark, data)) if n is not None and n < before)
    if len(numbers) < max(least, 2):
        return 0
    folders = [f"{data}/batch_id={n}" for n in numbers]
    rows = spark.read.schema(schema).option("basePath", data).parquet(*folders).drop("batch_id")
    aside = f"{data}/{_MERGED}{numbers[0]}-{numbers[-1]}"
    rows.hint("rebalance", *keys).write.mode("overwrite").partitionBy(*keys).parquet(aside)
    finish_merges(spark, data)
    return len(numbers)


def _batch_number(name: str) -> int | None:
    key, _, number = name.partition("=")
    return int(number) if key == "batch_id" else None


def finish_merges(spark: SparkSession, data: str) -> None:
    """Put merged folders that are whole in the place of what they were made from; drop those that are not."""
    for name in names_in(spark, data):
        if name.startswith(_MERGED):
            if exists(spark, f"{data}/{name}/_SUCCESS"):
                low, high = map(int, name.removeprefix(_MERGED).split("-"))
                for other in names_in(spark, data):
                    number = _batch_number(other)
                    if number is not None and low <= number <= high:
                        delete(spark, f"{data}/{other}")
                move(spark, f"{data}/{name}", f"{data}/batch_id={high}")
            else:
                delete(spark, f"{data}/{name}")


def enrich_rows(raw: DataFrame, labels: DataFrame) -> DataFrame:
    """Raw rows with the four columns that travel with a stream event; ``labels`` covers their keywords."""
    return with_genre(_stream_columns(raw), labels, id_col="eventid").select(*STREAM_EVENT.names)


def _stream_columns(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "datetime_clean": clean_datetime(F.col("datetime")),
            "keyword_norm": stream_keyword_norm(F.col("keyword")),
            "platform_group": platform_group(F.col("platform")),
        }
    ).drop("derived_genre")


Decode = Callable[[DataFrame], DataFrame]


def start_decode(
    stream: DataFrame,
    decode: Decode,
    out: str,
    tries: int = TRIES,
    most_dead: int = MOST_DEAD,
    available_now: bool = False,
    every: str = "60 seconds",
) -> StreamingQuery:
    """Process the records of each micro-batch with ``decode`` into ``out/data``, whatever single records do to it.

    A batch that fails is halved until the bad records stand alone; after ``tries`` tries each goes to ``out/dead`` with its error.
    More than ``most_dead`` of them in a batch stop the stream, with nothing lost, as the fault is then hardly theirs. What
    aggregates over event time follows ``out/data`` as a stream of its own, so that no bad record reaches its state.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        with staged_since(stream.sparkSession):
            good = _decoded(batch, decode, out, batch_id, tries, most_dead)
            good.write.mode("overwrite").parquet(f"{out}/data/batch_id={batch_id}")

    return _start(stream.writeStream.foreachBatch(write), f"{out}/_checkpoint", available_now, every)


def _decoded(batch: DataFrame, decode: Decode, out: str, batch_id: int, tries: int = TRIES, most_dead: int = MOST_DEAD) -> DataFrame:
    """The good records of a batch; the others go to ``out/dead`` in the batch's folder."""
    split = bisected(batch, decode, tries, most_dead)
    split.dead.write.mode("overwrite").parquet(f"{out}/dead/batch_id={batch_id}")
    return split.good


Lookup = DataFrame | Callable[[], DataFrame]


def start_enrich(
    stream: DataFrame,
    lut: Lookup,
    out: str,
    lut_ext: Lookup | None = None,
    label_provider: Provider | None = None,
    available_now: bool = False,
    every: str = "60 seconds",
    ask_again: timedelta = ASK_AGAIN,
    merge_every: int = MERGE_EVERY,
) -> StreamingQuery:
    """Enrich each micro-batch.

    Every keyword is classified once for all batches: what a batch learned is kept in a :class:`LabelStore` under ``out/_labels``, and later
    batches only classify what they see for the first time. Keywords that stay UNKNOWN are put to ``label_provider``, and
    again when they come after ``ask_again``. Lookups may be functions, called for every batch; once
    their contents change, keywords are classified anew when they come. Answers of the provider are kept and not asked for again.
    """
    spark = stream.sparkSession
    store = LabelStore(spark, f"{out}/_labels", merge_every, ask_again)

    def write(batch: DataFrame, batch_id: int) -> None:
        with staged_since(spark):
            enrich(batch, batch_id)

    def enrich(batch: DataFrame, batch_id: int) -> None:
        store.merge(batch_id)
        now = datetime.now(UTC)
        lookups = [x() if callable(x) else x for x in (lut, lut_ext)]
        mark = lookup_mark(*lookups)
        counted = stage(distinct_keywords(_stream_columns(batch)), "batch-keywords")
        stored = stage(counted.select("keyword_norm").join(store.read(before=batch_id), "keyword_norm"), "batch-stored")
        known = stored.where(store.settled(mark, now))
        fresh = counted.join(known, "keyword_norm", "left_anti")
        labels = classify_keywords(fresh, *lookups).select("keyword_norm", "derived_genre", "n")
        answered = stored.where((F.col("source") == PROVIDER) & (F.col("derived_genre") != UNKNOWN))
        answers = answered.select("keyword_norm", F.col("derived_genre").alias("answer"))
        if label_provider:
            labels = stage(labels, "batch-labels")
            open_ = labels.where(F.col("derived_genre") == UNKNOWN).join(answers, "keyword_norm", "left_anti")
            new = stage(label_residual(open_, label_provider), "answers")
            answers = answers.unionByName(new.select("keyword_norm", F.col("genre").alias("answer")))
        told = (F.col("derived_genre") == UNKNOWN) & F.col("answer").isNotNull()
        learned = labels.join(answers, "keyword_norm", "left").select(
            "keyword_norm",
            F.when(told, F.col("answer")).otherwise(F.col("derived_genre")).alias("derived_genre"),
            "n",
            F.when(told, PROVIDER).otherwise(RULES).alias("source"),
            F.lit(mark).alias("lookup"),
            F.lit(now).alias("asked_at"),
        )
        learned = store.add(learned, batch_id)
        genres = known.unionByName(learned, allowMissingColumns=True).select("keyword_norm", "derived_genre")
        here = counted.join(genres, "keyword_norm")
        enrich_rows(batch, here).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return _start(stream.writeStream.foreachBatch(write), f"{out}/_checkpoint", available_now, every)


def start_anomaly(
    stream: DataFrame,
    baseline_root: str,
    out: str,
    scope: str = "window",
    watermark: str = "1 hour",
    available_now: bool = False,
    every: str = "60 seconds",
    decode: Decode | None = None,
    silence: bool = False,
) -> StreamingQuery:
    """Score enter events against the baseline, read anew for every micro-batch.

    With ``silence``, which goes with ``scope="window"``, slots of the baseline that had no event in an hour are scored with a
    count of zero when the hour is closed. An hour that no event of any kind followed yet is not closed.

    With ``decode``, which goes with ``scope="batch"``, micro-batches hold undecoded records; those that can't be decoded go
    to ``dead`` and the others are scored together (see :func:`start_decode`, which comes before a window).

    ``scope="batch"`` scores the counts within each micro-batch. ``scope="window"`` scores event-time
    hours, which is what the baseline describes; the watermark bounds the state, and an hour is scored once
    it is over, so that no alert goes out for half an hour's events.
    Writes ``scored``, ``anomalies``, ``alerts`` and ``metrics`` under ``out``.
    """
    if scope not in ("batch", "window"):
        raise ValueError(f"unknown scope {scope!r}")
    if silence and scope != "window":
        raise ValueError("silence is told by hours, with scope='window'")
    if decode and scope != "batch":
        raise ValueError("decode before the window with start_decode, and follow its output")
    spark = stream.sparkSession
    windowed = scope == "window"

    def write(batch: DataFrame, batch_id: int) -> None:
        with staged_since(spark):
            score(_decoded(batch, decode, out, batch_id) if decode else batch, batch_id)

    def score(batch: DataFrame, batch_id: int) -> None:
        base = spark.read.parquet(resolve_version(spark, baseline_root))
        if silence:
            closed = stage(batch, "closed-hours")
            marks = [n for n in names_in(spark, f"{out}/closed") if int(n.partition("=")[2]) < batch_id]
            last = max(marks, key=lambda n: int(n.partition("=")[2]), default=None)
            after = spark.read.schema("last timestamp").parquet(f"{out}/closed/{last}").first() if last else None
            batch = closed.unionByName(anomalies.silent_buckets(closed, base, after and after["last"]).select(*closed.columns))
            upto = closed.agg(F.max("window_start").alias("last"))
            upto = upto.select(F.coalesce("last", F.lit(after and after["last"]).cast("timestamp")).alias("last"))
            upto.write.mode("overwrite").parquet(f"{out}/closed/batch_id={batch_id}")
            for name in marks:
                if name != last:
                    delete(spark, f"{out}/closed/{name}")
        scored = anomalies.score_buckets(batch, base) if windowed else anomalies.score(batch, base)
        here = {name: f"{out}/{name}/batch_id={batch_id}" for name in ("scored", "anomalies", "alerts", "metrics")}
        scored.write.mode("overwrite").parquet(here["scored"])
        scored = spark.read.schema(scored.schema).parquet(here["scored"])
        # A batch number comes again with a new checkpoint, but under another query id.
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        unit = F.col("window_start") if windowed else F.lit(f"{query_id}/{batch_id}")
        rows = anomalies.anomaly_rows(scored, unit, F.current_timestamp())
        rows.write.mode("overwrite").parquet(here["anomalies"])
        anomalies.alert_events(rows).write.mode("overwrite").parquet(here["alerts"])
        anomalies.score_metrics(scored).write.mode("overwrite").parquet(here["metrics"])

    if windowed:
        hour = F.window("event_ts", "1 hour").alias("w")
        stream = anomalies.enter_buckets(stream.withWatermark("event_ts", watermark), [hour])
        stream = stream.withColumn("window_start", F.col("w.start")).drop("w")
    writer = stream.writeStream.foreachBatch(write)
    if windowed:
        writer = writer.outputMode("append")
    return _start(writer, f"{out}/_checkpoint", available_now, every)


def _minutes(stream: DataFrame, watermark: str) -> DataFrame:
    minute = F.window("event_ts", "1 minute").alias("w")
    return anomalies.throughput_counts(stream.withWatermark("event_ts", watermark), [minute]).select(
        F.col("w.start").alias("window_start"),
        "derived_genre",
        "platform_group",
        F.col("SearchEnterEventsPerMinute").alias("enter_events"),
        F.col("SearchQuitEventsPerMinute").alias("quit_events"),
    )


def start_throughput(
    stream: DataFrame,
    out: str,
    watermark: str = "10 minutes",
    available_now: bool = False,
    every: str = "60 seconds",
) -> StreamingQuery:
    """Enter and quit events per minute, genre and platform, as far as they are known after each micro-batch.

    Minutes come again in ``out/counts`` as they grow; :func:`start_closed_minutes` beside it keeps what has to be read small.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/counts/batch_id={batch_id}")

    writer = _minutes(stream, watermark).writeStream.outputMode("update").foreachBatch(write)
    return _start(writer, f"{out}/_checkpoint", available_now, every)


def start_closed_minutes(
    stream: DataFrame,
    out: str,
    watermark: str = "10 minutes",
    available_now: bool = False,
    every: str = "60 seconds",
) -> StreamingQuery:
    """Each minute once, in ``out/closed``, when the watermark has passed it and nothing can be added.

    Goes with :func:`start_throughput` over the same stream and ``out``. What that has written of closed minutes alone is deleted.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/closed/batch_id={batch_id}")
        drop_closed_counts(spark, out)

    writer = _minutes(stream, watermark).writeStream.outputMode("append").foreachBatch(write)
    return _start(writer, f"{out}/_checkpoint-closed", available_now, every)


_MINUTES = "window_start TIMESTAMP, derived_genre STRING, platform_group STRING, enter_events BIGINT, quit_events BIGINT"


def _closed_upto(spark: SparkSession, out: str) -> datetime | None:
    if not exists(spark, f"{out}/closed"):
        return None
    return spark.read.schema(f"{_MINUTES}, batch_id BIGINT").parquet(f"{out}/closed").agg(F.max("window_start")).first()[0]


def drop_closed_counts(spark: SparkSession, out: str) -> int:
    """Delete the folders of counts all of whose minutes are closed, but for the newest folder; returns how many went."""
    last, names = _closed_upto(spark, out), names_in(spark, f"{out}/counts")
    if last is None or not names:
        return 0
    counts = spark.read.schema(f"{_MINUTES}, batch_id BIGINT").parquet(f"{out}/counts")
    open_ = {r.batch_id for r in counts.where(F.col("window_start") > F.lit(last)).select("batch_id").distinct().collect()}
    numbers = sorted(int(n.partition("=")[2]) for n in names if n.startswith("batch_id="))
    gone = [n for n in numbers[:-1] if n not in open_]
    for number in gone:
        delete(spark, f"{out}/counts/batch_id={number}")
    return len(gone)


def latest_throughput(spark: SparkSession, out: str) -> DataFrame:
    """The newest counts of every minute: closed ones as they are, later ones from the newest micro-batch that has them."""
    schema = T.StructType.fromDDL(_MINUTES)
    counts = spark.read.schema(f"{_MINUTES}, batch_id BIGINT").parquet(f"{out}/counts")
    last = _closed_upto(spark, out)
    if last is not None:
        counts = counts.where(F.col("window_start") > F.lit(last))
    keys = ["window_start", "derived_genre", "platform_group"]
    values = F.struct(*[n for n in schema.names if n not in keys])
    live = counts.groupBy(*keys).agg(F.max_by(values, "batch_id").alias("v")).select(*keys, "v.*")
    if last is None:
        return live
    return spark.read.schema(schema).parquet(f"{out}/closed").select(*schema.names).unionByName(live)
