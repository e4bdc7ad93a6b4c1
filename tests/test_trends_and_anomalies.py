from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from trendloom.operators import alarms, anomalies, evaluation, governance, replay, trends
from trendloom.sources import sinks
from trendloom.sources.raw_events import DateWindow

CURATED = (
    "event_id string, dt string, derived_genre string, hour_of_day_vn int, session_action string, is_cross_partition_date boolean, "
    "platform_group string, network_type_norm string, isp_segment string, keyword_norm string, user_id_hashed string, "
    "is_repeat_search boolean, has_premium boolean"
)


def curated(spark, *rows):
    """Rows of (dt, genre, hour, action, keyword)."""
    full = [
        (str(i), dt, g, h, a, False, "Web", "WiFi", None, k, "u", None, True) for i, (dt, g, h, a, k) in enumerate(rows)
    ]
    return spark.createDataFrame(full, CURATED)


def test_baseline_uses_days_present_and_population_deviation(spark):
    rows = [("2024-01-29", "NHAC", 5, "enter", "k")] + [("2024-01-28", "NHAC", 5, "enter", "k")] * 2 + [("2024-01-24", "NHAC", 5, "enter", "k")] * 4
    rows += [("2024-01-31", "NHAC", 5, "enter", "k")] * 9 + [("2024-01-23", "NHAC", 5, "enter", "k")] * 9 + [("2024-01-29", "NHAC", 5, "quit", "k")] * 9
    row = anomalies.baseline(curated(spark, *rows), date(2024, 1, 31)).first()
    assert (str(row.rolling_mean), str(row.rolling_std), row.sample_days, row.genre_hour) == ("2.3333", "1.2472", 3, "NHAC#5")


def scored(spark, n, mean, std):
    buckets = spark.createDataFrame([("A", 1, n)], "derived_genre string, hour_of_day_vn int, observed_count long")
    base = spark.createDataFrame([] if mean is None else [("A", 1, mean, std)], "derived_genre string, hour_of_day_vn int, rolling_mean double, rolling_std double")
    return anomalies.score_buckets(buckets, base)


@pytest.mark.parametrize("n, mean, std, z, kind", [(10, None, None, 10.0, "SPIKE"), (2, 20.0, 0.5, -18.0, "DROP"), (26, 20.0, 2.0, 3.0, None), (5, 4.0, 2.0, 0.5, None)])
def test_z_scores(spark, n, mean, std, z, kind):
    row = scored(spark, n, mean, std).first()
    assert (row.z_score, row.anomaly_type, row.is_anomaly) == (z, kind, kind is not None)


def test_anomaly_ids_repeat_and_rows_expire(spark):
    at = F.lit("2024-01-31 00:00:00").cast("timestamp")
    first, again, other = (anomalies.anomaly_rows(scored(spark, 10, None, None), F.lit(s), at).first() for s in ("b1", "b1", "b2"))
    assert first == again and first.anomaly_id != other.anomaly_id
    assert (str(first.z_score), first.score_ts) == ("10.0000", "2024-01-31T00:00:00Z")
    rows = anomalies.anomaly_rows(scored(spark, 10, None, None), F.lit("b1"), at)
    assert anomalies.ttl_filter(rows, at + F.expr("INTERVAL 29 DAYS")).count() == 1
    assert anomalies.ttl_filter(rows, at + F.expr("INTERVAL 30 DAYS")).count() == 0


def test_injected_spike_flags_exactly_its_bucket(spark):
    rows = [(f"2024-01-{d}", g, h, "enter", "k") for d in range(24, 31) for g in ("THE_THAO", "NHAC") for h in (19, 20) for _ in range(5)]
    df = curated(spark, *rows)
    base = anomalies.baseline(df, date(2024, 1, 31))
    today = replay.inject_anomaly(df.where("dt = '2024-01-30'"), multiplier=4)
    assert today.count() == 20 + 3 * 5
    hits = anomalies.score(today, base).where("is_anomaly").collect()
    assert [(r.derived_genre, r.hour_of_day_vn, r.anomaly_type, r.z_score) for r in hits] == [("THE_THAO", 20, "SPIKE", 15.0)]


def test_baseline_upsert_last_write_wins(spark):
    def rows(*r):
        return spark.createDataFrame(list(r), "genre_hour string, rolling_mean double, updated_at string")

    merged = sinks.upsert_baseline(rows(("a", 1.0, "1"), ("b", 1.0, "5")), rows(("a", 2.0, "1"), ("b", 2.0, "3"), ("c", 2.0, "1")))
    assert sorted(map(tuple, merged.collect())) == [("a", 2.0, "1"), ("b", 1.0, "5"), ("c", 2.0, "1")]


def test_ranks_history_and_ties(spark):
    rows = [("2024-01-30", "NHAC", 1, "enter", k) for k in "aaabbccd"] + [("2024-01-25", "NHAC", 1, "enter", k) for k in "ccb"]
    rows += [("2024-01-30", "NHAC", 1, "quit", "q")]
    gold = trends.keyword_trends(curated(spark, *rows), date(2024, 1, 31), DateWindow(start="2024-01-30"), top_k=2)
    got = {r.keyword_norm: (r.rank_today, r.rank_7d_ago, r.rank_delta) for r in gold.collect()}
    assert got == {"a": (1, 9999, 9998), "b": (2, 2, 0), "c": (2, 1, -1)}
    assert gold.where("keyword_norm = 'a'").first().abandonment_rate == 0.0


def test_invalid_rows_do_not_reach_gold(spark):
    df = curated(spark, ("2024-01-30", "NHAC", 1, "enter", "a"), ("2024-01-30", "NHAC", 1, "enter", None))
    flagged = df.withColumn("is_cross_partition_date", F.when(F.col("keyword_norm") == "a", F.lit(None).cast("boolean")).otherwise(False))
    assert trends.valid_rows(flagged).count() == 0 and trends.valid_rows(df).count() == 1


def test_replay_puts_unparseable_first_and_batches(spark):
    rows = [("f", "9", None), ("f", "1", 50), ("f", "2", 50), ("f", "0", 3), ("g", "0", 1), ("f", "10", None)]
    df = spark.createDataFrame(rows, "source_file string, event_id string, s long").withColumn("event_ts", F.timestamp_seconds("s"))
    got = replay.replay_order(df, batch=2).where("source_file = 'f'").orderBy("rn").collect()
    assert [(r.event_id, r.batch_id) for r in got] == [("10", 0), ("9", 0), ("0", 1), ("1", 1), ("2", 2)]
    key = replay.salted_partition_key(F.lit("X"), F.lit(501))
    assert spark.range(1).select(key.alias("k")).first().k == "X_0"


def test_alarm_missing_data_policies(spark):
    rows = [("AnomalyScore", 0, 4.0), ("AnomalyScore", 900, 3.0), ("Errors", 0, 1.0), ("Invocations", 0, 30.0), ("Errors", 901, 2.0)]
    metrics = spark.createDataFrame(rows, "metric_name string, s long, value double").withColumn("ts", F.timestamp_seconds("s"))
    line = {(r.alarm, r.period_start): (r.value, r.breaching) for r in alarms.alarm_timeline(metrics, datetime(1970, 1, 1), datetime(1970, 1, 1, 0, 15, 1)).collect()}
    assert [line["anomaly-score-breach", p] for p in (0, 300, 600, 900)] == [(4.0, True), (None, False), (None, False), (3.0, False)]
    assert line["error-rate", 0][1] is False and line["error-rate", 900] == (1.0, True)
    assert line["daily-run-missing", 0] == (None, True)
    states = {r.alarm: r.breaching for r in alarms.evaluate_alarms(metrics, datetime(1970, 1, 1, 0, 15, 1)).collect()}
    assert states == {"anomaly-score-breach": False, "daily-run-missing": True, "error-rate": True, "iterator-age": False, "health": True}


def test_alarms_notice_silence(spark):
    success = spark.createDataFrame([("DailyPipelineSuccess", 0, 1.0)], "metric_name string, s long, value double").withColumn("ts", F.timestamp_seconds("s"))
    for metrics in (success, success.where("false")):
        states = {r.alarm: r.breaching for r in alarms.evaluate_alarms(metrics, datetime(1970, 2, 1)).collect()}
        assert states == {"anomaly-score-breach": False, "daily-run-missing": True, "error-rate": False, "iterator-age": False, "health": True}
    assert alarms.alarm_timeline(success, datetime(1970, 1, 1), datetime(1970, 2, 1))._jdf.queryExecution().toString().count("LogicalRDD") <= 3


def test_roles(spark):
    gold = spark.createDataFrame([("a", 1, 2)], "keyword_norm string, search_count long, unique_users long")
    assert governance.role_view(gold, "gold", "marketing").columns == ["keyword_norm", "search_count"]
    assert governance.role_view(gold, "gold", "analyst").columns == gold.columns
    for layer, role, columns in (("gold", "marketing", ["unique_users"]), ("curated", "marketing", None), ("raw", "analyst", None), ("gold", "nobody", None)):
        with pytest.raises(PermissionError):
            governance.role_view(gold, layer, role, columns)
    assert governance.register_role_views(spark, {"gold": gold, "raw": gold}, "marketing") == ["marketing_gold"]
    assert spark.table("marketing_gold").columns == ["keyword_norm", "search_count"]


def test_pii_scan_counts_rows_and_matches(spark):
    rows = [("call 0912345678 or +84912345678", 1, ["x", "0900000000"]), ("none", 2, None), (None, 3, [])]
    df = spark.createDataFrame(rows, "t string, n int, a array<string>")
    assert [tuple(r) for r in governance.pii_scan(df).collect()] == [
        ("vn_phone", "t", 3, 1, 2, "+84912345678"), ("vn_phone", "a", 3, 1, 1, "0900000000")
    ]


def test_metrics_on_a_small_comparison(spark):
    rows = [("a", "NHAC", "NHAC", True, 10), ("b", "NHAC", "ANIME", False, 5), ("c", "UNKNOWN", "UNKNOWN", True, 1)]
    compared = spark.createDataFrame(rows, "keyword_norm string, rules_genre string, oracle_genre string, agree boolean, search_count long")
    prf = {r.genre: r for r in evaluation.genre_prf(compared).collect()}
    assert (prf["NHAC"].precision, prf["NHAC"].recall, prf["NHAC"].support) == (0.5, 1.0, 1)
    assert (prf["ANIME"].precision, prf["ANIME"].recall, prf["ANIME"].fn_volume) == (0.0, 0.0, 5)
    assert prf["PHIM_HAN"].f1 == 0.0 and len(prf) == 9
    macro = evaluation.macro_scores(evaluation.genre_prf(compared)).first()
    assert macro.macro_f1 == pytest.approx((2 / 3 + 1) / 9) and macro.macro_precision_volume == pytest.approx((10 / 15 + 1) / 9)
    assert evaluation.confusion_matrix(compared).count() == 81
    top = evaluation.top_misclassified(compared, n=30).collect()
    assert [(r.keyword_norm, r.keywords, r.search_count) for r in top] == [("b", 1, 5), (None, 0, 0)]


def test_alarms_look_back_from_the_moment(spark):
    """The success came an hour ago, and by the floor of 26 hours a period has begun a minute ago."""
    boundary = 26 * 3600 * 700
    stamp = lambda seconds: F.timestamp_seconds(F.lit(seconds))
    metrics = spark.range(1).select(F.lit("DailyPipelineSuccess").alias("metric_name"), stamp(boundary - 3600).alias("ts"), F.lit(1.0).alias("value"))
    for later, missing in ((60, False), (25 * 3600 - 1, False), (25 * 3600, True)):
        states = {r.alarm: r.breaching for r in alarms.evaluate_alarms(metrics, stamp(boundary + later)).collect()}
        assert states["daily-run-missing"] == states["health"] == missing


def test_alarm_states_equal_brute_force(spark):
    import random

    rnd = random.Random(3)
    names = ("AnomalyScore", "DailyPipelineSuccess", "Errors", "Invocations", "GetRecords.IteratorAgeMilliseconds", "Other")
    points = [(rnd.choice(names), rnd.uniform(0, 7200), rnd.choice((0.0, 1.0, 2.0, 4.0, 90_000.0))) for _ in range(120)] + [("AnomalyScore", 600.0, 9.0)]
    metrics = spark.createDataFrame(points, "metric_name string, s double, value double").withColumn("ts", F.timestamp_micros((F.col("s") * 1_000_000).cast("long")))
    states = alarms.with_composite(alarms.alarm_states(metrics, datetime(1970, 1, 1), datetime(1970, 1, 1, 2), 300))
    got, want = {(r.alarm, int(r.at.timestamp())): (r.value, r.breaching) for r in states.collect()}, {}
    for at in range(0, 7201, 300):
        for r in alarms.DEFAULT_RULES:
            near = lambda m: [v for n, s, v in points if n == m and at - r.period_seconds < int(s * 1_000_000) / 1_000_000 <= at]  # noqa: E731, B023
            stat = lambda v: (sum(v) if r.stat == "sum" else max(v)) if v else None  # noqa: E731, B023
            value = stat(near(r.metric))
            if r.ratio_to and value is not None:
                value = value / max(value, stat(near(r.ratio_to)) or 0) if max(value, stat(near(r.ratio_to)) or 0) else None
            want[r.name, at] = (value, r.missing_breaches if value is None else value > r.threshold if r.comparison == ">" else value < r.threshold)
        want["health", at] = (None, any(want[r.name, at][1] for r in alarms.DEFAULT_RULES))
    assert got == want
    episodes = alarms.alarm_episodes(states).collect()
    for name in {k for k, _ in want}:
        line = sorted((r for r in episodes if r.alarm == name), key=lambda r: r.since)
        assert sum(r.moments for r in line) == 25 and line[-1].until is None
        assert all(a.until == b.since and a.state != b.state for a, b in zip(line, line[1:]))
        assert all((r.state == "ALARM") == want[name, int(r.since.timestamp())][1] for r in line)
    with pytest.raises(ValueError, match="whole number"):
        alarms.alarm_states(metrics, datetime(1970, 1, 1), datetime(1970, 1, 2), 7)
