import json

from pyspark.sql import functions as F

from trendloom.operators import classification as cl
from trendloom.operators import labelling, similarity


def lookup(spark, entries):
    return spark.createDataFrame([(k, g, i) for i, (k, g) in enumerate(entries)], "keyword string, genre string, ordinal long")


def keywords(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "keyword_norm string")


def test_stages_in_order(spark):
    lut = lookup(spark, [("show hàn quốc", "UNKNOWN"), ("naruto", "ANIME"), ("the", "UNKNOWN"), ("running man", "TRUYEN_HINH")])
    ext = lookup(spark, [("tiểu lý", "PHIM_TRUNG"), ("tiêu ly", "PHIM_VIET"), ("naruto", "NHAC"), ("thanh gươm diệt quỷ", "ANIME")])
    got = cl.classify_keywords(
        keywords(
            spark, "show hàn quốc", "phim hàn quốc", "naruto", "tiểu lý", "tieu ly", "k+", "runing man", "the batman xyz",
            "thanh gươm diet quỷy", "thanh gươm diệt quỹ", "thanh gươm xưa lắm", "", "  ", "xyzzy", "[hd] naruto (2024)",
        ),
        lut, ext, fuzzy_ext=True,
    )
    assert {r.keyword_norm: (r.derived_genre, r.stage) for r in got.collect()} == {
        "show hàn quốc": ("UNKNOWN", "lut"),
        "phim hàn quốc": ("PHIM_HAN", "regex"),
        "naruto": ("ANIME", "lut"),
        "[hd] naruto (2024)": ("ANIME", "lut"),
        "tiểu lý": ("PHIM_TRUNG", "lut_ext"),
        "tieu ly": ("PHIM_VIET", "nodiac"),
        "k+": ("UNKNOWN", "none"),
        "runing man": ("TRUYEN_HINH", "fuzzy"),
        "the batman xyz": ("PHIM_AU_MY", "regex"),
        "thanh gươm diet quỷy": ("ANIME", "fuzzy_ext"),  # 3 edits in 39 letters: 92.3
        "thanh gươm diệt quỹ": ("ANIME", "nodiac"),
        "thanh gươm xưa lắm": ("UNKNOWN", "none"),
        "": ("UNKNOWN", "empty"),
        "  ": ("UNKNOWN", "empty"),
        "xyzzy": ("UNKNOWN", "none"),
    }


def test_model_hook_only_sees_the_rest(spark):
    seen = []

    def model(rest):
        seen.extend(r.kw for r in rest.collect())
        return rest.select("kw", F.when(F.col("kw") == "zxz", "NHAC").otherwise("UNKNOWN").alias("genre"))

    got = cl.classify_keywords(keywords(spark, "zxz", "qaq", "naruto"), lookup(spark, [("naruto", "ANIME")]), model=model)
    assert {r.keyword_norm: r.stage for r in got.collect()} == {"zxz": "model", "qaq": "none", "naruto": "lut"}
    assert sorted(seen) == ["qaq", "zxz"]


def test_unknown_fallback_keeps_other_rows(spark):
    df = spark.createDataFrame([("a", "UNKNOWN"), ("a", "NHAC"), ("b", "UNKNOWN"), (None, "UNKNOWN")], "keyword_norm string, derived_genre string")
    got = cl.lut_unknown_fallback(df, lookup(spark, [("a", "ANIME")]))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [("a", "ANIME"), ("a", "NHAC"), ("b", "UNKNOWN"), (None, "UNKNOWN")], key=repr
    )


def test_label_repair(spark):
    def provider(asked):
        if "boom" in asked:
            raise RuntimeError
        if "fairy tail" in asked:
            return json.dumps({"ANIME": "fairy tail", "NHAC": "bolero"})
        return "```json\n" + json.dumps({"a b": "kdrama", "stranger": "NHAC", "c": "nonsense"}) + "\n```"

    def label(*values):
        frame = keywords(spark, *values).coalesce(1)
        return {r.keyword_norm: r.genre for r in labelling.label_residual(frame, provider).collect()}

    assert label("fairy tail", "bolero") == {"fairy tail": "ANIME", "bolero": "NHAC"}
    assert label("a\\b", "c") == {"a\\b": "PHIM_HAN"}
    assert label("boom", "x") == {}


def test_keywords_put_as_one_all_get_its_label(spark):
    def provider(asked):
        return json.dumps({k: "NHAC" for k in asked})

    frame = keywords(spark, "a\\b", "a\nb", "a b", "c").coalesce(1)
    got = labelling.label_residual(frame, provider).collect()
    assert sorted(r.keyword_norm for r in got) == ["a\nb", "a b", "a\\b", "c"]
    asked = labelling.ask_in_batches(frame, lambda asked: str(asked.count("a b"))).first()
    assert asked.response == "1"


def test_answers_that_are_not_json_give_no_labels(spark):
    frame = keywords(spark, "x").coalesce(1)
    assert labelling.label_residual(frame, lambda asked: "sorry").count() == 0


def test_batches_have_the_asked_size(spark):
    frame = keywords(spark, *[f"k{i}" for i in range(120)]).coalesce(1)
    sizes = [len(r.asked) for r in labelling.ask_in_batches(frame, lambda asked: "{}", batch=50).collect()]
    assert sorted(sizes) == [20, 50, 50]


def test_provider_labels_reach_the_curated_rows(spark):
    from trendloom.plans.enrichment import curate
    from trendloom.schemas import RAW_DATA

    row = {f.name: None for f in RAW_DATA.fields} | {"datetime": "2024-01-02 03:04:05.000", "category": "enter", "user_id": "u"}
    rows = [row | {"eventid": "1", "keyword": "Qwerty"}, row | {"eventid": "2", "keyword": None}, row | {"eventid": "3", "keyword": "naruto"}]
    raw = spark.createDataFrame([tuple(r[n] for n in RAW_DATA.names) for r in rows], RAW_DATA).withColumn("dt", F.lit("2024-01-02"))
    got = curate(raw, lookup(spark, [("naruto", "ANIME")]), label_provider=lambda asked: json.dumps({k: "NHAC" for k in asked}))
    assert {r.event_id: r.derived_genre for r in got.collect()} == {"1": "NHAC", "2": "UNKNOWN", "3": "ANIME"}


def test_curate_parses_each_row_once(spark):
    from tests.conftest import plan_of
    from trendloom.plans.enrichment import curate, repaired
    from trendloom.schemas import RAW_DATA

    times = ["2024-01-02 03:04:05.123", "2565-01-02 03:04:05.6", "0004-01-02 03:04:05.000", "1899-01-02 03:04:05.000", "2024-01-02 3:04:05", "no date", None]
    rows = [{f.name: None for f in RAW_DATA.fields} | {"eventid": str(i), "datetime": at, "platform": " WEB "} for i, at in enumerate(times)]
    raw = spark.createDataFrame([tuple(r[n] for n in RAW_DATA.names) for r in rows], RAW_DATA).withColumn("dt", F.lit("2024-01-02"))
    got = curate(raw, lookup(spark, [("naruto", "ANIME")]))
    assert "datetime" not in plan_of(got)
    expected = {(r.eventid, r.event_ts) for r in repaired(raw).collect()}
    assert {(r.event_id, r.event_ts) for r in got.collect()} == expected and {e for e, _ in expected} == {"0", "1", "4"}
    assert {r.platform_group for r in got.collect()} == {"Web"}


def test_ledger_asks_failed_groups_again_and_no_others(spark, tmp_path):
    """Every third group fails once, one answers nonsense for ever; the second run asks those alone."""
    log = tmp_path / "calls"
    log.mkdir()
    keywords = spark.createDataFrame([(f"kw {i:03}",) for i in range(90)] + [("kw 000",)], "keyword_norm string").coalesce(1)

    def provider(asked):
        import uuid

        first = min(asked)
        seen = sum(p.read_text() == first for p in log.iterdir())
        (log / uuid.uuid4().hex).write_text(first)
        number = sum(p.read_text() == first for p in log.iterdir())
        if "kw 044" in asked:
            return "I would rather not"
        if seen == 0 and number == 1 and len({p.read_text() for p in log.iterdir()}) % 3 == 0:
            raise TimeoutError("away")
        return "Here you are: " + json.dumps({k: "NHAC" for k in asked}) + " Bye."

    ledger = labelling.AnswerLedger(spark, str(tmp_path / "ledger"), batch=10, most_tries=3, stop_after=None)
    ledger.run(keywords, provider)
    calls = lambda: [p.read_text() for p in log.iterdir()]
    assert len(calls()) == 9 and ledger.open_groups().count() in (3, 4) and ledger.read().count() == 9
    failed = ledger.open_groups().count()
    assert all(r.error.startswith(("TimeoutError: away", "no JSON object: I would")) for r in ledger.open_groups().collect())
    second = ledger.run(keywords, provider)
    assert len(calls()) == 9 + failed and second.count() == failed
    assert ledger.labels().count() == 80 and [r.tries for r in ledger.open_groups().collect()] == [2]
    ledger.run(keywords, provider)
    ledger.run(keywords, provider)
    assert len(calls()) == 9 + failed + 1 and ledger.open_groups().count() == 0
    assert sorted(r.tries for r in ledger.read().collect()) == sorted([3] + [2] * (failed - 1) + [1] * (9 - failed))
    ledger.run(keywords.unionByName(spark.createDataFrame([("new",)], "keyword_norm string")), provider)
    assert calls().count("new") == 1 and len(calls()) == 9 + failed + 2


def test_ledger_stops_when_the_provider_is_away(spark, tmp_path):
    keywords = spark.createDataFrame([(f"k{i}",) for i in range(100)], "keyword_norm string").coalesce(1)

    def away(asked):
        raise ConnectionError("no route")

    ledger = labelling.AnswerLedger(spark, str(tmp_path / "ledger"), batch=10, stop_after=2)
    assert ledger.run(keywords, away).count() == 2 and ledger.labels().count() == 0
    assert ledger.run(keywords, lambda asked: json.dumps({k: "ANIME" for k in asked})).count() == 10
    assert ledger.labels().count() == 100


def test_ledger_query_makes_the_pool_once(spark, sf_dir, monkeypatch):
    """Both runs of the ledger read one written pool; none makes the keywords from the tables again."""
    from trendloom.registry import queries

    read, run = [], queries.labelling.AnswerLedger.run
    monkeypatch.setattr(queries.labelling.AnswerLedger, "run", lambda self, keywords, provider: read.append(sorted(keywords.inputFiles())) or run(self, keywords, provider))
    assert queries.QUERIES["label_ledger"](spark, sf_dir).count() > 0
    assert len(read) == 2 and read[0] == read[1] and all("/pool-" in f for f in read[0])


def test_only_keywords_no_lookup_key_covers_are_compared(spark, monkeypatch):
    compared, candidates = [], similarity._candidates

    def watched(q, k, delta):
        compared.append({r.q_norm for r in q.collect()})
        return candidates(q, k, delta)

    monkeypatch.setattr(similarity, "_candidates", watched)
    kw = keywords(spark, "qwx blorptz zzz", "blorpta", "zwq kkw in the box", "zwq kkw in thf box")
    got = cl.classify_keywords(kw, lookup(spark, [("blorptz", "ANIME")]), lookup(spark, [("in the box", "NHAC"), ("zwq kkw in the box two", "THE_THAO")]), fuzzy_ext=True)
    stages = {r.keyword_norm: (r.derived_genre, r.stage) for r in got.collect()}
    assert stages["qwx blorptz zzz"] == ("ANIME", "fuzzy") and stages["blorpta"][1] == "fuzzy" and stages["zwq kkw in the box"] == ("NHAC", "fuzzy_ext")
    assert len(compared) == 2 and "blorptz qwx zzz" not in compared[0] and "box in kkw the zwq" not in compared[1] and "blorpta" in compared[0]
