from datetime import UTC, datetime, timedelta

from pyspark.sql import functions as F

from trendloom.schemas import RAW_DATA
from trendloom.sources import lookups
from trendloom.streaming import jobs
from trendloom.streaming.label_store import LABEL, RULES, LabelStore, lookup_mark

NOW = datetime(2024, 1, 31, tzinfo=UTC)


def labels(spark, *rows, at=NOW, mark="m"):
    return spark.createDataFrame([(k, g, 1, s, mark, at) for k, g, s in rows], LABEL)


def test_many_batches_stay_few_folders(spark, tmp_path):
    store, most = LabelStore(spark, str(tmp_path), merge_every=4), 0
    for batch in range(30):
        store.merge(batch)
        store.add(labels(spark, (f"k{batch}", "NHAC", RULES), ("again", f"g{batch}", RULES), at=NOW + timedelta(minutes=batch)), batch)
        most = max(most, len(store.folders()))
    assert most <= 1 + 4
    got = {r.keyword_norm: r.derived_genre for r in store.read().collect()}
    assert got == {f"k{i}": "NHAC" for i in range(30)} | {"again": "g29"}
    assert {r.keyword_norm for r in store.read(before=29).collect()} == {f"k{i}" for i in range(29)} | {"again"}
    assert len([p for p in (tmp_path / "merged").iterdir() if p.name.startswith("data-")]) <= 2


def test_a_merge_that_broke_off_does_no_harm(spark, tmp_path):
    """The version is there, and the folders it was made from still are."""
    store = LabelStore(spark, str(tmp_path), merge_every=1)
    store.add(labels(spark, ("a", "NHAC", RULES)), 0)
    assert store.merge(1) and not store.merge(1)
    store.add(labels(spark, ("a", "NHAC", RULES)), 0)
    assert [(r.keyword_norm, r.derived_genre) for r in store.read().collect()] == [("a", "NHAC")]
    assert store.merge(1) and store.read().count() == 1


def test_what_settles_a_label(spark, tmp_path):
    store = LabelStore(spark, str(tmp_path), ask_again=timedelta(days=2))
    old = NOW - timedelta(days=3)
    rows = labels(spark, ("a", "NHAC", RULES), at=old).union(labels(spark, ("b", "UNKNOWN", RULES), at=old))
    rows = rows.union(labels(spark, ("c", "UNKNOWN", RULES))).union(labels(spark, ("d", "NHAC", RULES), mark="other"))
    assert [r.keyword_norm for r in rows.where(store.settled("m", NOW)).orderBy("keyword_norm").collect()] == ["a", "c"]


def test_marks_follow_contents(spark):
    lut = spark.createDataFrame([("a", "NHAC", 0), ("b", "ANIME", 1)], "keyword string, genre string, ordinal long")
    assert lookup_mark(lut, None) == lookup_mark(lut.orderBy(F.desc("keyword")).repartition(3), None)
    assert len({lookup_mark(lut), lookup_mark(lut.limit(1)), lookup_mark(lut.withColumn("genre", F.lit("NHAC"))), lookup_mark(None)}) == 4


def test_a_keyword_learned_later_changes_and_answers_are_kept(spark, tmp_path):
    """Three micro-batches of the same keywords: the lookup grows after the first, the provider answers once."""
    rows = lambda n: spark.createDataFrame(
        [(f"{n}-{i}", f"2024-01-0{n} 05:00:00.000", "u", k, "enter", "isp", "web-x", "wifi", "view", None) for i, k in enumerate(("qqzzxx", "wwyyvv", "hhjjkk"))], RAW_DATA
    )
    folder, root, asked = str(tmp_path / "in"), str(tmp_path / "lut"), str(tmp_path / "asked")
    lookups.update_lookup(spark.createDataFrame([("never seen", "NHAC")], "keyword string, genre string"), root)

    def provider(keywords):
        import json
        import uuid
        from pathlib import Path

        Path(asked).mkdir(exist_ok=True)
        (Path(asked) / uuid.uuid4().hex).write_text(" ".join(sorted(keywords)))
        return json.dumps({k: "ANIME" for k in keywords if k == "wwyyvv"})

    def run(n, **more):
        rows(n).coalesce(1).write.mode("append").parquet(folder)
        stream = jobs.follow(spark, folder, RAW_DATA)
        jobs.run_to_end(jobs.start_enrich(stream, lambda: lookups.load_lookup(spark, root), str(tmp_path / "out"), label_provider=provider, available_now=True, **more))
        got = spark.read.schema(jobs.ENRICHED_SCHEMA).parquet(str(tmp_path / "out")).where(F.col("eventid").startswith(f"{n}-"))
        return {r.keyword: r.derived_genre for r in got.collect()}

    questions = lambda: sorted(p.read_text() for p in (tmp_path / "asked").iterdir())
    assert run(1) == {"qqzzxx": "UNKNOWN", "wwyyvv": "ANIME", "hhjjkk": "UNKNOWN"}
    first = " ".join(questions()).split()
    assert sorted(first) == ["hhjjkk", "qqzzxx", "wwyyvv"]
    assert run(2) == {"qqzzxx": "UNKNOWN", "wwyyvv": "ANIME", "hhjjkk": "UNKNOWN"} and len(" ".join(questions()).split()) == 3
    lookups.update_lookup(spark.createDataFrame([("qqzzxx", "PHIM_HAN")], "keyword string, genre string"), root)
    assert run(3) == {"qqzzxx": "PHIM_HAN", "wwyyvv": "ANIME", "hhjjkk": "UNKNOWN"}
    assert sorted(" ".join(questions()).split()) == ["hhjjkk", "hhjjkk", "qqzzxx", "wwyyvv"]
    assert run(4, ask_again=timedelta(0))["hhjjkk"] == "UNKNOWN" and " ".join(questions()).split().count("hhjjkk") == 3
