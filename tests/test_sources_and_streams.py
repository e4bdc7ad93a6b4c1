import base64
import json
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from tests.conftest import plan_of

from trendloom.functions.text import stream_keyword_norm
from trendloom.operators.classification import classify_keywords, distinct_keywords
from trendloom.schemas import CURATED, RAW_DATA, RAW_EVENTS
from trendloom.session import shared_dir
from trendloom.sources import lookups, raw_events, sinks
from trendloom.streaming import jobs


def raw(spark, *rows):
    """Rows of (id, datetime, keyword, category)."""
    full = [(i, d, "u", k, c, "isp", "web-x", "wifi", "view", ["VIP:1"]) for i, d, k, c in rows]
    return spark.createDataFrame(full, RAW_DATA)


def test_raw_scan_prunes_partitions_and_keeps_string_keys(spark, tmp_path):
    rows = raw(spark, ("1", "2024-01-01 05:00:00.000", "a", "enter"), ("2", "2024-01-02 05:00:00.000", "b", "quit"))
    keyed = rows.withColumns({"dt": F.left("datetime", F.lit(10)), "hour": F.lit("05"), "derived_genre": F.lit("NHAC"), "platform_group": F.lit("Web")})
    keyed.write.partitionBy("dt", "hour", "derived_genre", "platform_group").parquet(str(tmp_path / "raw"))
    got = raw_events.scan_raw_events(spark, str(tmp_path / "raw"), raw_events.DateWindow("2024-01-02", "2024-01-02"))
    assert got.schema.names == RAW_EVENTS.names
    assert [(r.eventid, r.dt, r.hour) for r in got.collect()] == [("2", "2024-01-02", "05")]
    plan = plan_of(got.select("keyword"))
    assert "PartitionFilters: [isnotnull(dt" in plan and "ReadSchema: struct<keyword:string>" in plan


def test_unreadable_files_are_skipped(spark, tmp_path):
    raw(spark, ("1", "x", "a", "enter")).coalesce(1).write.parquet(str(tmp_path / "a" / "b"))
    (tmp_path / "a" / "broken.parquet").write_bytes(b"PAR1 not really")
    (tmp_path / "a" / "notes.txt").write_text("x")
    got = raw_events.scan_source_files(spark, str(tmp_path), RAW_DATA)
    assert [r.eventid for r in got.collect()] == ["1"]


def test_modal_date_ties_and_files_without_dates(spark):
    rows = [("f", "2024-01-02 x"), ("f", "2024-01-01 y"), ("g", None), ("g", "short"), ("h", "2024-01-03 1"), ("h", "2024-01-03 2"), ("h", "2024-01-01 1")]
    df = spark.createDataFrame(rows, "source_file string, datetime string")
    assert sorted(map(tuple, raw_events.file_modal_date(df).collect())) == [("f", "20240101"), ("h", "20240103")]


def encode(obj):
    return base64.b64encode(obj if isinstance(obj, bytes) else json.dumps(obj).encode()).decode()


def test_damaged_records_become_dead_letters(spark):
    data = [encode({"eventid": "1", "keyword": "à"}), "%%%", encode(b"{broken"), encode(b"[1,"), None]
    good, dead = raw_events.decode_json_records(spark.createDataFrame([(d,) for d in data], "data string"))
    assert [(r.eventid, r.keyword) for r in good.collect()] == [("1", "à")]
    assert sorted(r.data or "" for r in dead.collect()) == sorted(["", "%%%", data[2], data[3]])


def curated(spark, *rows):
    blank = {f.name: None for f in CURATED.fields}
    full = [tuple((blank | {"event_id": e, "dt": d, "derived_genre": g}).values()) for e, d, g in rows]
    return spark.createDataFrame(full, CURATED)


def test_curated_write_replaces_whole_days_only(spark, tmp_path):
    path = str(tmp_path / "curated")
    sinks.write_curated(curated(spark, ("1", "d1", "NHAC"), ("2", "d1", "ANIME"), ("3", "d2", "NHAC")), path)
    for _ in range(2):
        sinks.write_curated(curated(spark, ("4", "d1", "NHAC")), path)
        got = spark.read.schema(CURATED).parquet(path)
        assert sorted((r.event_id, r.dt, r.derived_genre) for r in got.collect()) == [("3", "d2", "NHAC"), ("4", "d1", "NHAC")]


def test_days_with_odd_names_are_replaced(spark, tmp_path):
    path, odd = str(tmp_path / "curated"), ["\t2024-01-0", "2024/01/01", "2024-01-0:", "", None, "a=b", "%"]
    for _ in range(2):
        sinks.write_curated(curated(spark, *[(str(i), d, "NHAC") for i, d in enumerate(odd)]), path)
        assert sorted(r.event_id for r in spark.read.schema(CURATED).parquet(path).collect()) == [str(i) for i in range(len(odd))]


def test_a_failing_write_leaves_the_old_day(spark, tmp_path):
    path = str(tmp_path / "curated")
    sinks.write_curated(curated(spark, ("1", "d1", "NHAC")), path)
    broken = curated(spark, ("2", "d1", "NHAC")).withColumn("event_id", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        sinks.write_curated(broken, path)
    assert [r.event_id for r in spark.read.schema(CURATED).parquet(path).collect()] == ["1"]
    assert [p.name for p in (tmp_path / "curated").iterdir() if p.name.startswith("_")] == []


@pytest.mark.parametrize("failing", [1, 2, 3, 4])
def test_a_failing_rename_loses_no_day(spark, tmp_path, monkeypatch, failing):
    """Two days are swapped, in two renames each; one of the renames says no."""
    path = str(tmp_path / "curated")
    sinks.write_curated(curated(spark, ("1", "d1", "NHAC"), ("2", "d2", "NHAC")), path)
    move, calls = sinks._move, []

    def moody(fs, source, target):
        calls.append(target)
        if len(calls) == failing:
            raise OSError("no")
        move(fs, source, target)

    monkeypatch.setattr(sinks, "_move", moody)
    with pytest.raises(OSError, match="no"):
        sinks.write_curated(curated(spark, ("3", "d1", "NHAC"), ("4", "d2", "NHAC")), path)
    got = sorted((r.dt, r.event_id) for r in spark.read.schema(CURATED).parquet(path).collect())
    assert [d for d, _ in got] == ["d1", "d2"] and {e for _, e in got} <= {"1", "2", "3", "4"}
    assert [p.name for p in (tmp_path / "curated").iterdir() if p.name.startswith("_")] == []
    sinks.write_curated(curated(spark, ("3", "d1", "NHAC"), ("4", "d2", "NHAC")), path)
    assert sorted(r.event_id for r in spark.read.schema(CURATED).parquet(path).collect()) == ["3", "4"]


class Refusing:
    """A file system that says no by returning false, as Hadoop's do."""

    def __init__(self, there: bool):
        self.there = there

    def exists(self, path) -> bool:
        return self.there

    def rename(self, source, target) -> bool:
        assert not self.there
        return False


@pytest.mark.parametrize("there", [True, False])
def test_a_rename_that_returns_false_is_an_error(there):
    with pytest.raises(OSError, match="could not move a to b"):
        sinks._move(Refusing(there), "a", "b")


def test_a_writer_that_died_between_renames_is_recovered(spark, tmp_path):
    table = tmp_path / "curated"
    sinks.write_curated(curated(spark, ("1", "d1", "NHAC"), ("2", "d2", "NHAC")), str(table))
    (table / "_old-x").mkdir(), (table / "_fresh-x").mkdir()
    (table / "dt=d1").rename(table / "_old-x" / "dt=d1")
    sinks.write_curated(curated(spark, ("3", "d2", "NHAC")), str(table))
    assert sorted(r.event_id for r in spark.read.schema(CURATED).parquet(str(table)).collect()) == ["1", "3"]
    assert sorted(p.name for p in table.iterdir()) == ["dt=d1", "dt=d2"]


def test_anomalies_by_day_are_pruned_and_expire(spark, tmp_path):
    path, schema = str(tmp_path / "anomalies"), "anomaly_id string, score_ts string"
    rows = lambda *r: spark.createDataFrame(r, schema)
    for day in range(1, 29, 9):
        sinks.append_anomalies(rows((f"a{day}", f"2024-01-{day:02} 23:59:59"), ("again", f"2024-01-{day:02} 01:00:00")), path)
    sinks.append_anomalies(rows(("a1", "2024-03-01 00:00:00"), ("none", None)), path)
    table = sinks.read_anomalies(spark, path, rows().schema)
    assert sorted(r.anomaly_id for r in table.collect()) == ["a1", "a10", "a19", "a28", "again", "none"]
    assert spark.read.parquet(path).count() == 7  # a1 came again after its row had expired
    since = sinks.read_anomalies(spark, path, rows().schema, since=date(2024, 1, 19))
    assert sorted(r.anomaly_id for r in since.collect()) == ["a1", "a19", "a28"] and "PartitionFilters: [isnotnull(score_day" in plan_of(since)
    assert sinks.expire_anomalies(spark, path, datetime(2024, 2, 10)) == [date(2024, 1, 1), date(2024, 1, 10)]
    assert sinks.expire_anomalies(spark, path, datetime(2024, 2, 10)) == []
    assert sorted(r.anomaly_id for r in sinks.read_anomalies(spark, path, rows().schema).collect()) == ["a1", "a19", "a28", "none"]


def test_writers_at_the_same_time_lose_no_update(spark, tmp_path, monkeypatch):
    """The second writer publishes while the first one is between reading and publishing."""
    root = str(tmp_path / "lut")
    pairs = lambda *r: spark.createDataFrame(r, "keyword string, genre string")
    lookups.update_lookup(pairs(("a", "NHAC")), root)
    publish, others = sinks.publish_version, [pairs(("c", "ANIME"))]

    def late(df, root, after=""):
        if others:
            lookups.update_lookup(others.pop(), root)
        return publish(df, root, after)

    monkeypatch.setattr(sinks, "publish_version", late)
    lookups.update_lookup(pairs(("b", "NHAC")), root)
    assert sorted(r.keyword for r in lookups.load_lookup(spark, root).collect()) == ["a", "b", "c"]
    first = sinks.resolve_version(spark, root)
    publish(spark.range(3), root)
    with pytest.raises(sinks.VersionTaken):
        publish(spark.range(4), root, after=first)
    assert len([p for p in (tmp_path / "lut").iterdir() if p.name.startswith("data-")]) == 4


def test_a_marker_without_content_is_passed_over(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "_MARKER_PATIENCE", 0.5)
    root = tmp_path / "v"
    one = sinks.publish_version(spark.range(1), str(root))
    (root / "_current" / "v-000000000002").touch()
    assert sinks.resolve_version(spark, str(root)) == one
    two = sinks.publish_version(spark.range(2), str(root), after=one)
    assert sinks.resolve_version(spark, str(root)) == two and sinks.prune_versions(spark, str(root), 1) == 1
    assert sinks.resolve_version(spark, str(root)) == two and spark.read.parquet(two).count() == 2


def test_gold_anomalies_and_versions_can_be_repeated(spark, tmp_path):
    gold = lambda *rows: spark.createDataFrame(rows, "keyword_norm string, trend_date date, derived_genre string")
    path, day = str(tmp_path / "gold"), date(2024, 1, 1)
    sinks.write_gold(gold(("a", day, "NHAC"), ("b", day, "ANIME"), ("c", None, "NHAC")), path)
    sinks.write_gold(gold(("d", day, "NHAC"), ("e", None, "NHAC")), path, split_date="2024-01-15", side="upto")
    assert sorted(r.keyword_norm for r in spark.read.parquet(path).collect()) == ["d", "e"]
    found = spark.createDataFrame([("x", "2024-01-01 10:00:00"), ("y", None), ("y", None)], "anomaly_id string, score_ts string")
    for _ in range(2):
        sinks.append_anomalies(found, str(tmp_path / "anomalies"))
    assert spark.read.parquet(str(tmp_path / "anomalies")).count() == 2
    versions = [sinks.publish_version(spark.range(i), str(tmp_path / "v")) for i in range(12)]
    assert sinks.resolve_version(spark, str(tmp_path / "v")) == versions[-1]
    assert sinks.resolve_version(spark, str(tmp_path / "none")) is None


def test_lookup_round_trip_merge_and_missing_file(spark, tmp_path):
    def lut(*rows):
        return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "keyword string, genre string, ordinal long")

    assert lookups.load_lookup(spark, str(tmp_path / "none.json")).count() == 0
    assert lookups.load_lookup(spark, str(tmp_path / "none")).count() == 0
    first = lookups.load_lookup(spark)
    assert first.orderBy("ordinal").first().keyword == "naruto"
    merged = lookups.merge_lookup(lut(("a", "NHAC"), ("b", "ANIME"), ("c", "UNKNOWN")), lut(("a", "ANIME"), ("b", "UNKNOWN"), ("d", "NHAC")))
    assert sorted(map(tuple, merged.collect())) == [("a", "ANIME"), ("d", "NHAC")]
    root = str(tmp_path / "lut")
    lookups.write_lookup(lut(("old", "NHAC")), root)
    lookups.write_lookup(merged, root)
    assert [r.keyword for r in lookups.load_lookup(spark, root).orderBy("ordinal").collect()] == ["a", "d"]


def test_keyword_csv(spark, tmp_path):
    path = tmp_path / "k.csv"
    path.write_text('keyword_norm,n\n"a, b",1\n,2\nknown,3\n" ""q"" ",4\n', encoding="utf-8")
    known = spark.createDataFrame([("known", "NHAC")], "keyword string, genre string")
    got = lookups.read_keyword_csv(spark, str(path), known)
    assert sorted(r.keyword_norm for r in got.collect()) == ["a, b", "q"]
    assert lookups.read_keyword_csv(spark, str(path), limit=1).count() == 1


def test_raw_stream_sink_partitions_by_all_keys(spark, tmp_path):
    good = {"eventid": "1", "datetime": "2024-01-01 05:00:00", "derived_genre": "NHAC", "platform_group": "Web"}
    spark.createDataFrame([(encode(good),), ("%%",)], "data string").write.parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    for _ in range(2):
        stream = spark.readStream.schema("data string").parquet(str(tmp_path / "in"))
        jobs.run_to_end(jobs.start_raw_sink(stream, out, available_now=True))
    assert os.path.isdir(f"{out}/data/batch_id=0/dt=2024-01-01/hour=05/derived_genre=NHAC/platform_group=Web")
    assert spark.read.schema(jobs.SINK_SCHEMA).parquet(f"{out}/data").count() == 1
    assert spark.read.schema("data string").parquet(f"{out}/dead").count() == 1


def test_enriched_stream_equals_batch(spark, tmp_path):
    rows = raw(spark, *[(str(i), "2024-01-01 5:00:00 CH", k, "enter") for i, k in enumerate(["Naruto", "\tbolero ", "zzzz", "", None, "the x"])])
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    lut = lookups.load_lookup(spark)
    stream = jobs.follow(spark, str(tmp_path / "in"), RAW_DATA, files_per_batch=1)
    jobs.run_to_end(jobs.start_enrich(stream, lut, str(tmp_path / "out"), available_now=True))
    streamed = spark.read.schema(jobs.ENRICHED_SCHEMA).parquet(str(tmp_path / "out")).drop("batch_id")
    counted = distinct_keywords(rows.withColumn("keyword_norm", stream_keyword_norm(F.col("keyword"))))
    expected = jobs.enrich_rows(rows, classify_keywords(counted, lut))
    assert sorted(map(tuple, streamed.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)
    assert {r.keyword_norm: r.derived_genre for r in expected.collect()} == {"naruto": "ANIME", "bolero": "NHAC", "zzzz": "UNKNOWN", None: "UNKNOWN", "the x": "UNKNOWN"}


def test_stream_asks_about_each_open_keyword_once(spark, tmp_path):
    for i, words in enumerate((["naruto", "zzzz", "yyyy"], ["zzzz", "xxxx"], ["zzzz", "yyyy", "xxxx"])):
        raw(spark, *[(f"{i}{k}", "2024-01-01 05:00:00", k, "enter") for k in words]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    log = str(tmp_path / "asked")

    def provider(keywords):
        with open(log, "a", encoding="utf-8") as f:
            f.write("".join(k + "\n" for k in keywords))
        return json.dumps({k: "NHAC" for k in keywords if k != "yyyy"})

    stream = jobs.follow(spark, str(tmp_path / "in"), RAW_DATA, files_per_batch=1)
    before = set(os.listdir(shared_dir(spark)))
    jobs.run_to_end(jobs.start_enrich(stream, lookups.load_lookup(spark), str(tmp_path / "out"), label_provider=provider, available_now=True))
    rows = spark.read.schema(jobs.ENRICHED_SCHEMA).parquet(str(tmp_path / "out")).collect()
    assert {r.keyword_norm: r.derived_genre for r in rows} == {"naruto": "ANIME", "zzzz": "NHAC", "xxxx": "NHAC", "yyyy": "UNKNOWN"}
    assert len(rows) == 8 and sorted(open(log, encoding="utf-8").read().split()) == ["xxxx", "yyyy", "zzzz"]
    assert set(os.listdir(shared_dir(spark))) == before


@pytest.mark.parametrize("scope", ["batch", "window"])
def test_anomaly_stream(spark, tmp_path, scope):
    events = spark.createDataFrame([("NHAC", 7, "enter", "2024-01-01 00:10:00")] * 9 + [("NHAC", 7, "quit", "2024-01-01 00:20:00"), ("ANIME", 7, "enter", "2024-01-01 00:30:00")], "derived_genre string, hour_of_day_vn int, session_action string, t string")
    events = events.withColumn("event_ts", F.col("t").cast("timestamp")).drop("t")
    later = events.where("session_action = 'quit'").withColumns({"session_action": F.lit("enter"), "event_ts": F.lit("2024-01-01 09:00:00").cast("timestamp"), "hour_of_day_vn": F.lit(16)})
    (events.unionByName(later) if scope == "window" else events).coalesce(1).write.parquet(str(tmp_path / "in"))
    base = spark.createDataFrame([("NHAC", 7, 2.0, 1.0)], "derived_genre string, hour_of_day_vn int, rolling_mean double, rolling_std double")
    sinks.write_baseline(base, str(tmp_path / "base"))
    stream = jobs.follow(spark, str(tmp_path / "in"), events.schema)
    out = str(tmp_path / "out")
    jobs.run_to_end(jobs.start_anomaly(stream, str(tmp_path / "base"), out, scope=scope, available_now=True))
    rows = spark.read.parquet(f"{out}/anomalies").collect()
    assert [(r.derived_genre, float(r.z_score), r.anomaly_type) for r in rows] == [("NHAC", 7.0, "SPIKE")]
    alert = json.loads(spark.read.parquet(f"{out}/alerts").first().detail)
    assert alert["anomaly_id"] == rows[0].anomaly_id and alert["z_score"] == 7.0
    points = {r.dimensions["Genre"]: r.value for r in spark.read.parquet(f"{out}/metrics").collect()}
    assert points == {"NHAC": 7.0, "ANIME": 1.0}


def test_silent_slots_drop_once_their_hour_is_over(spark, tmp_path):
    """NHAC falls silent for two hours, ANIME never speaks; nothing follows the last hour, so it stays open."""
    at = lambda h: (("NHAC", h + 7, "enter", f"2024-01-01 {h:02}:30:00"),)
    schema, folder, out = "derived_genre string, hour_of_day_vn int, session_action string, t string", str(tmp_path / "in"), str(tmp_path / "out")
    slots = [(g, (h + 7) % 24, 9.0, 1.0) for g in ("NHAC", "ANIME") for h in range(24)]
    sinks.write_baseline(spark.createDataFrame(slots, "derived_genre string, hour_of_day_vn int, rolling_mean double, rolling_std double"), str(tmp_path / "base"))

    def run(*hours):
        rows = spark.createDataFrame([x for h in hours for x in at(h)], schema).withColumn("event_ts", F.col("t").cast("timestamp")).drop("t")
        rows.coalesce(1).write.mode("append").parquet(folder)
        stream = jobs.follow(spark, folder, rows.schema)
        jobs.run_to_end(jobs.start_anomaly(stream, str(tmp_path / "base"), out, silence=True, available_now=True))
        got = spark.read.parquet(f"{out}/scored").collect()
        return {(r.derived_genre, r.window_start.hour): (r.observed_count, r.anomaly_type) for r in got}, len(got)

    quiet = (0, "DROP")
    first, n = run(0, 1, 4)
    assert first == {("NHAC", 0): (1, "DROP"), ("NHAC", 1): (1, "DROP"), ("ANIME", 0): quiet, ("ANIME", 1): quiet} and n == 4
    second, n = run(8)
    more = {("NHAC", h): quiet for h in (2, 3)} | {("NHAC", 4): (1, "DROP")} | {("ANIME", h): quiet for h in (2, 3, 4)}
    assert second == first | more and n == 10
    with pytest.raises(ValueError, match="window"):
        jobs.start_anomaly(spark.readStream.format("rate").load(), "base", out, scope="batch", silence=True)


def test_closed_minutes_are_read_once_and_counts_behind_them_go(spark, tmp_path):
    """Ten micro-batches an hour apart, each with an event of the batch before; one row comes far too late."""
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "derived_genre string, platform_group string, session_action string, event_ts timestamp"
    stamp = lambda h, m: datetime(2024, 1, 1, h, m)
    sent, folders = [], []
    for h in range(10):
        rows = [("NHAC", "Web", "enter", stamp(h, 5)), ("NHAC", "Web", "quit", stamp(h, 5)), ("ANIME", "iOS", "enter", stamp(max(h - 1, 0), 58))]
        late = [("NHAC", "Web", "enter", stamp(0, 5))] if h == 6 else []
        sent += rows
        spark.createDataFrame(rows + late, schema).coalesce(1).write.mode("append").parquet(folder)
        for start in (jobs.start_throughput, jobs.start_closed_minutes):
            jobs.run_to_end(start(jobs.follow(spark, folder, spark.createDataFrame([], schema).schema), out, watermark="10 minutes", available_now=True))
        folders.append(len([p for p in (tmp_path / "out" / "counts").iterdir() if p.is_dir()]))
    got = {(r.window_start, r.derived_genre): (r.enter_events, r.quit_events) for r in jobs.latest_throughput(spark, out).collect()}
    want = {}
    for genre, _, action, at in sent:
        n = want.setdefault((at, genre), [0, 0])
        n[action == "quit"] += 1
    assert got == {k: tuple(v) for k, v in want.items()} and max(folders) <= 4
    assert spark.read.parquet(f"{out}/closed").groupBy("window_start", "derived_genre").count().where("count > 1").count() == 0


def test_admission_by_bytes_and_merged_batches(spark, tmp_path):
    """Small files in many micro-batches; merged, a partition has one file, and a merge that died half way is finished."""
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    record = lambda i: base64.b64encode(json.dumps({"eventid": str(i), "datetime": f"2024-01-01 0{i % 2}:00:00", "derived_genre": "NHAC", "platform_group": "Web"}).encode()).decode()
    for i in range(12):
        spark.createDataFrame([(record(2 * i),), (record(2 * i + 1),)], "data string").coalesce(1).write.mode("append").parquet(folder)
    size = max(os.path.getsize(os.path.join(folder, f)) for f in os.listdir(folder) if f.endswith(".parquet"))
    stream = jobs.follow(spark, folder, spark.createDataFrame([], "data string").schema, bytes_per_batch=str(3 * size))
    jobs.run_to_end(jobs.start_raw_sink(stream, out, available_now=True))
    data, batches = f"{out}/data", len(os.listdir(f"{out}/data"))
    read = lambda: sorted(int(r.eventid) for r in spark.read.schema(jobs.SINK_SCHEMA).parquet(data).collect())
    files = lambda: sum(f.endswith(".parquet") for _, _, names in os.walk(data) for f in names)
    assert batches >= 4 and read() == list(range(24)) and files() >= 2 * batches
    assert jobs.merge_batches(spark, data, jobs.SINK_SCHEMA, before=batches - 1, least=batches) == 0
    assert jobs.merge_batches(spark, data, jobs.SINK_SCHEMA, before=batches - 1, least=2) == batches - 1
    assert sorted(os.listdir(data)) == [f"batch_id={batches - 2}", f"batch_id={batches - 1}"] and read() == list(range(24)) and files() <= 5
    # Died after the first folder was deleted; and before the merged rows were whole.
    spark.read.schema(jobs.SINK_SCHEMA).parquet(data).drop("batch_id").write.partitionBy("dt", "hour", "derived_genre", "platform_group").parquet(f"{data}/_merged-{batches - 2}-{batches - 1}")
    sinks.delete(spark, f"{data}/batch_id={batches - 2}")
    os.mkdir(f"{data}/_merged-90-91")
    jobs.finish_merges(spark, data)
    assert os.listdir(data) == [f"batch_id={batches - 1}"] and read() == list(range(24))
    with pytest.raises(ValueError, match="files or by bytes"):
        jobs.follow(spark, folder, jobs.SINK_SCHEMA, 1, "1m")


def test_arrivals_hold_the_columns_that_streams_read(spark, sf_dir, monkeypatch):
    """The wide columns of the curated table, session and user hashes among them, are not copied for each arrival."""
    from trendloom.registry import queries

    seen, follow = [], queries.jobs.follow
    monkeypatch.setattr(queries.jobs, "follow", lambda spark, path, schema, *a: seen.append(schema.names) or follow(spark, path, schema, *a))
    assert queries.QUERIES["stream_silence"](spark, sf_dir).count() > 0
    assert seen and all(set(names) <= set(queries._ARRIVING) for names in seen)
