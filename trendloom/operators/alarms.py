"""Metric alarms evaluated over a complete line of periods."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class AlarmRule:
    """``stat`` of ``metric`` per period compared with ``threshold``.

    With ``ratio_to`` the value is metric / max(metric, ratio_to). ``missing_breaches`` decides
    about periods without data.
    """

    name: str
    metric: str
    stat: str
    period_seconds: int
    comparison: str
    threshold: float
    missing_breaches: bool = False
    ratio_to: str | None = None


# The four health alarms.
DEFAULT_RULES = (
    AlarmRule("anomaly-score-breach", "AnomalyScore", "max", 5 * 60, ">", 3.0),
    AlarmRule("daily-run-missing", "DailyPipelineSuccess", "sum", 26 * 3600, "<", 1.0, missing_breaches=True),
    AlarmRule("error-rate", "Errors", "sum", 15 * 60, ">", 0.05, ratio_to="Invocations"),
    AlarmRule("iterator-age", "GetRecords.IteratorAgeMilliseconds", "max", 5 * 60, ">", 60_000.0),
)
COMPOSITE = "health"


def _rule_table(rules: Sequence[AlarmRule]) -> Column:
    """The rules as an array of structs."""
    return F.array(*[
        F.struct(
            F.lit(r.name).alias("alarm"), F.lit(r.metric).alias("metric"), F.lit(r.ratio_to).cast("string").alias("ratio_to"),
            F.lit(r.stat).alias("stat"), F.lit(r.period_seconds).cast("bigint").alias("period"), F.lit(r.comparison).alias("comparison"),
            F.lit(float(r.threshold)).alias("threshold"), F.lit(r.missing_breaches).alias("missing_breaches"),
        )
        for r in rules
    ])


def _epoch(moment: Column | datetime) -> Column:
    return F.unix_seconds(moment if isinstance(moment, Column) else F.lit(moment).cast("timestamp"))


def alarm_timeline(
    metrics: DataFrame, start: Column | datetime, as_of: Column | datetime, rules: Sequence[AlarmRule] = DEFAULT_RULES
) -> DataFrame:
    """State of every alarm in every period from ``start`` to ``as_of``, whether it has data or not.

    (alarm, period_start, value, breaching). The line of periods comes from the arguments alone, so silence, or no
    metric at all, shows; periods without data are judged by the rule's missing-data policy. The metrics are read
    once: a point goes to its period of each rule that looks at it.
    """
    spark = metrics.sparkSession
    first, last = _epoch(start), _epoch(as_of)
    begin = lambda moment, period: F.floor(moment / period) * period
    spine = spark.range(1).select(F.explode(_rule_table(rules)).alias("rule")).select("rule.*")
    spine = spine.select("*", F.explode(F.sequence(begin(first, F.col("period")), begin(last, F.col("period")), F.col("period"))).alias("period_start"))
    named = F.filter(_rule_table(rules), lambda r: (r["metric"] == F.col("metric_name")) | r["ratio_to"].eqNullSafe(F.col("metric_name")))
    points = metrics.where((F.unix_seconds("ts") >= first) & (F.unix_seconds("ts") <= last)).select("metric_name", "ts", "value", F.explode(named).alias("r"))
    own, other = (F.when(F.col("metric_name") == F.col(f"r.{c}"), F.col("value")) for c in ("metric", "ratio_to"))
    sums = points.groupBy(F.col("r.alarm").alias("alarm"), begin(F.unix_seconds("ts"), F.col("r.period")).alias("period_start")).agg(
        F.sum(own).alias("own_sum"), F.max(own).alias("own_max"), F.sum(other).alias("other_sum"), F.max(other).alias("other_max")
    )
    joined = _judged(spine.join(sums, ["alarm", "period_start"], "left"))
    return joined.select("alarm", "period_start", "value", "breaching")


def _judged(rows: DataFrame) -> DataFrame:
    """value and breaching of rows with the columns of a rule and its aggregates."""
    top, bottom = (F.when(F.col("stat") == "max", F.col(f"{c}_max")).otherwise(F.col(f"{c}_sum")) for c in ("own", "other"))
    ratio = F.try_divide(top, F.greatest(top, bottom))
    rows = rows.withColumn("value", F.when(F.col("ratio_to").isNull(), top).otherwise(ratio))
    breach = F.when(F.col("comparison") == ">", F.col("value") > F.col("threshold")).otherwise(F.col("value") < F.col("threshold"))
    return rows.withColumn("breaching", F.coalesce(breach, F.col("missing_breaches")))


def alarm_states(
    metrics: DataFrame,
    start: Column | datetime,
    as_of: Column | datetime,
    every_seconds: int = 60,
    rules: Sequence[AlarmRule] = DEFAULT_RULES,
) -> DataFrame:
    """(alarm, at, value, breaching): every alarm judged every ``every_seconds`` from ``start`` to ``as_of``.

    What is judged at a moment are the points of the rule's period that ends there, after its begin and up to the moment itself. So an alarm
    does not forget, at the begin of a period, what came right before it. The moments come from the arguments alone, so silence shows. Points are added up by the step they
    fall into, on the cluster; the windows then slide over steps, of which there are as many as moments. Periods
    must be whole numbers of steps.
    """
    if any(r.period_seconds % every_seconds for r in rules):
        raise ValueError("the period of each rule must be a whole number of steps")
    spark, step = metrics.sparkSession, F.lit(every_seconds)
    first, last = _epoch(start), _epoch(as_of)
    rule = spark.range(1).select(F.explode(_rule_table(rules)).alias("rule")).select("rule.*")
    # Steps are numbered backwards from as_of, which is 0; step n ends at as_of - n * step.
    spine = rule.select("*", F.explode(F.sequence(F.floor((first - F.col("period") - last) / step), F.lit(0).cast("bigint"))).alias("n"))
    named = F.filter(_rule_table(rules), lambda r: (r["metric"] == F.col("metric_name")) | r["ratio_to"].eqNullSafe(F.col("metric_name")))
    points = metrics.where((F.col("ts") <= F.timestamp_seconds(last))).select("metric_name", "ts", "value", F.explode(named).alias("r"))
    points = points.where(F.col("ts") > F.timestamp_seconds(first - F.col("r.period")))
    at = F.ceil((F.unix_micros("ts") / 1_000_000 - last) / step)
    own, other = (F.when(F.col("metric_name") == F.col(f"r.{c}"), F.col("value")) for c in ("metric", "ratio_to"))
    sums = points.groupBy(F.col("r.alarm").alias("alarm"), at.alias("n")).agg(
        F.sum(own).alias("own_sum"), F.max(own).alias("own_max"), F.sum(other).alias("other_sum"), F.max(other).alias("other_max")
    )
    steps = spine.join(sums, ["alarm", "n"], "left")
    slid = []
    for r in rules:
        over = Window.partitionBy("alarm").orderBy("n").rangeBetween(1 - r.period_seconds // every_seconds, 0)
        mine = steps.where(F.col("alarm") == r.name)
        slid.append(mine.withColumns({c: getattr(F, c[-3:])(c).over(over) for c in ("own_sum", "own_max", "other_sum", "other_max")}))
    moment = F.timestamp_seconds(last + F.col("n") * step)
    states = _judged(reduce(DataFrame.unionByName, slid)).withColumn("at", moment)
    return states.where(F.col("at") >= F.timestamp_seconds(first)).select("alarm", "at", "value", "breaching")


def with_composite(states: DataFrame) -> DataFrame:
    """States with those of all alarms together: breaching where any is."""
    together = states.groupBy("at").agg(F.bool_or("breaching").alias("breaching"))
    return states.unionByName(together.select(F.lit(COMPOSITE).alias("alarm"), "at", F.lit(None).cast("double").alias("value"), "breaching"))


def alarm_episodes(states: DataFrame) -> DataFrame:
    """(alarm, state, since, until, moments): stretches of moments in one state, OK or ALARM.

    ``until`` is the first moment of the next stretch, null for the one that still lasts.
    """
    line = Window.partitionBy("alarm").orderBy("at")
    changed = F.coalesce((F.col("breaching") != F.lag("breaching").over(line)).cast("int"), F.lit(0))
    islands = states.withColumn("changed", changed).withColumn("island", F.sum("changed").over(line))
    found = islands.groupBy("alarm", "island").agg(
        F.any_value("breaching").alias("breaching"), F.min("at").alias("since"), F.count("*").alias("moments")
    )
    until = F.lead("since").over(Window.partitionBy("alarm").orderBy("since"))
    return found.select("alarm", F.when(F.col("breaching"), "ALARM").otherwise("OK").alias("state"), "since", until.alias("until"), "moments")


def evaluate_alarms(metrics: DataFrame, as_of: Column | datetime, rules: Sequence[AlarmRule] = DEFAULT_RULES) -> DataFrame:
    """State of each alarm at ``as_of``, over the period that ends then, and of all of them together.

    Every rule has a row, data or not; ``period_start`` is in seconds.
    """
    moment = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    # One step as long as the greatest length that all periods are multiples of: only the moment itself is judged.
    states = alarm_states(metrics, moment, moment, reduce(gcd, (r.period_seconds for r in rules)), rules)
    periods = F.create_map(*[F.lit(x) for r in rules for x in (r.name, r.period_seconds)])
    latest = states.select("alarm", (F.unix_seconds("at") - periods[F.col("alarm")]).alias("period_start"), "value", "breaching")
    together = latest.agg(
        F.lit(COMPOSITE).alias("alarm"),
        F.max("period_start").alias("period_start"),
        F.lit(None).cast("double").alias("value"),
        F.bool_or("breaching").alias("breaching"),
    )
    return latest.unionByName(together)
