"""Replaying stored events in order, in batches, with optional injected spikes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.operators.skew import row_number_in_slices


_SAMPLE = 4096


def _id_bounds(ids: DataFrame) -> list[str]:
    """Ids that cut all ids into about as many ranges as there are shuffle partitions.

    They come from a sample of at most ``_SAMPLE`` ids, those of the smallest hashes.
    """
    rows = ids.where("id IS NOT NULL").orderBy(F.xxhash64("id"), "id").limit(_SAMPLE).collect()
    sample = sorted(r.id for r in rows)
    step = max(1, len(sample) // int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return sorted(set(sample[step::step]))


def replay_order(
    events: DataFrame,
    file_col: str = "source_file",
    ts: str = "event_ts",
    id_col: str = "event_id",
    batch: int = 500,
    slice_seconds: int = 60,
) -> DataFrame:
    """Add ``rn`` and ``batch_id``: the place of each event in its file by time.

    Events without a time come first; ties are broken by id. A file may hold most of the
    rows, so it is numbered minute by minute; its timeless rows, which all share one minute, by
    ranges of ids between those of a sample.
    """
    micros = F.coalesce(F.unix_micros(ts), F.lit(0))
    bounds = _id_bounds(events.where(micros == 0).select(F.col(id_col).cast("string").alias("id")))
    below = F.size(F.filter(F.array(*map(F.lit, bounds)).cast("array<string>"), lambda b: b <= F.col(id_col)))
    part = F.when(micros == 0, below).otherwise(0)
    sliced = F.struct(
        F.signum(micros).alias("side"), F.floor(micros / (slice_seconds * 1_000_000)).alias("minute"), part.alias("part")
    )
    numbered = row_number_in_slices(
        events.withColumn("_us", micros), [file_col], ["_us", id_col], sliced, "rn"
    ).drop("_us")
    return numbered.withColumn("batch_id", F.floor((F.col("rn") - 1) / batch))


def salted_partition_key(genre: Column, rn: Column, batch: int = 500, salts: int = 100) -> Column:
    """``GENRE_i`` with i the place in the batch modulo ``salts``: spreads a genre over many shards."""
    place = F.pmod(F.pmod(rn - 1, F.lit(batch)), F.lit(salts))
    return F.concat_ws("_", F.coalesce(genre, F.lit("UNKNOWN")), place.cast("string"))


def inject_anomaly(
    events: DataFrame, genre: str = "THE_THAO", hour: int = 20, multiplier: int = 10
) -> DataFrame:
    """Append ``multiplier - 1`` copies of the rows of one genre and hour."""
    if multiplier < 2:
        return events
    picked = events.where((F.col("derived_genre") == genre) & (F.col("hour_of_day_vn") == hour))
    copies = picked.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(multiplier - 1)))).drop("_copy")
    return events.unionAll(copies)
