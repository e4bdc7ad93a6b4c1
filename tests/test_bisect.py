import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from trendloom.streaming import jobs
from trendloom.streaming.bisect import TooManyBadRecords, _Numbered, bad_records, bisected


def codes(spark, n, bad, parts=5):
    bad = F.col("id").isin(list(bad)) if bad else F.lit(False)
    return spark.range(0, n, 1, parts).select("id", F.when(bad, F.lit("x")).otherwise(F.col("id").cast("string")).alias("code"))


def decode(rows):
    number = F.try_to_number("code", F.lit("999999"))
    return rows.select("id", F.when(number.isNull(), F.raise_error(F.lit("bad code"))).otherwise(number).cast("long").alias("n"))


@pytest.mark.parametrize("bad", [[], [0], [999], [500], [3, 4, 998], [0, 1, 2]])
def test_all_but_the_bad_records_get_through(spark, bad):
    split = bisected(codes(spark, 1000, bad), decode)
    assert sorted(r.n for r in split.good.collect()) == sorted({*range(1000)} - {*bad})
    dead = split.dead.collect()
    assert sorted(r.id for r in dead) == bad and all(r.code == "x" and r.tries == 3 and "bad code" in r.error for r in dead)


def test_few_attempts_for_each_bad_record(spark):
    rows, calls = spark.range(1024).withColumnRenamed("id", "_at").withColumn("n", F.col("_at")), []

    def attempt(part):
        ids = [r.n for r in part.collect()]
        calls.append(ids)
        if {77, 900} & set(ids):
            raise ValueError("no")

    assert [(f.at, f.tries, f.error) for f in bad_records(rows, 1024, attempt, tries=2)] == [(77, 2, "no"), (900, 2, "no")]
    assert len(calls) <= 2 * 2 * 10 + 4


def test_an_attempt_reads_the_records_of_its_part_alone(spark, tmp_path):
    parts = _Numbered(codes(spark, 100_000, []), str(tmp_path / "rows"))
    assert parts.count == 100_000
    for low, high in ((0, 1), (19_999, 20_001), (70_000, 70_010)):
        part = parts.part(low, high)
        assert part.count() == high - low and "_row" in plan_of(part).split("PushedFilters")[1] and "PartitionFilters: [is" in plan_of(part)
    assert sorted(r.id for low in range(0, 100_000, 25_000) for r in parts.part(low, low + 25_000).collect()) == [*range(100_000)]


def test_many_bad_records_are_found_side_by_side(spark):
    rows, busy, most = spark.range(256).withColumnRenamed("id", "_at").withColumn("n", F.col("_at")), [0], [0]

    def attempt(part):
        busy[0] += 1
        most[0] = max(most[0], busy[0])
        ids = [r.n for r in part.collect()]
        busy[0] -= 1
        if any(i % 32 == 5 for i in ids):
            raise ValueError("no")

    assert [f.at for f in bad_records(rows, 256, attempt)] == [*range(5, 256, 32)]
    assert most[0] > 1


def test_small_parts_cost_one_attempt_a_level(spark):
    bad, calls = {*range(1000, 50_000, 2500)}, []

    def attempt(part):
        calls.append(part)
        if any(x in bad for x in part):
            raise ValueError("no")

    found = bad_records(range, 50_000, attempt)
    assert [(f.at, f.tries) for f in found] == [(at, 3) for at in sorted(bad)]
    singles = [x[0] for x in calls if len(x) == 1 and x[0] in bad]
    assert sorted(singles) == sorted([*bad] * 3) and len(calls) < 20 * len(bad)


def test_attempts_share_their_compiled_code(spark, tmp_path):
    parts = _Numbered(codes(spark, 1000, []), str(tmp_path / "rows"))
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    code = {decode(parts.part(at, at + 7))._jdf.queryExecution().explainString(mode).split("Generated code")[1] for at in (0, 30, 100)}
    assert len(code) == 1


def test_faults_that_pass_set_nothing_aside(spark):
    left = [2]

    def attempt(part):
        left[0] -= 1
        if left[0] >= 0:
            raise OSError("away")

    assert bad_records(spark.range(8).withColumnRenamed("id", "_at"), 8, attempt) == []


def test_a_fault_of_all_records_is_none_of_theirs(spark):
    with pytest.raises(TooManyBadRecords):
        bisected(codes(spark, 20, range(20)), decode, most=3)
    assert bisected(codes(spark, 0, []), decode).good.count() == 0


def test_stream_with_one_bad_record_and_its_replay(spark, tmp_path):
    folder, out = str(tmp_path / "sent"), str(tmp_path / "out")
    codes(spark, 1000, [417]).write.parquet(folder)
    for turn in range(2):  # a new checkpoint brings the batch again
        jobs.run_to_end(jobs.start_decode(jobs.follow(spark, folder, codes(spark, 1, []).schema), decode, out, available_now=True))
        (tmp_path / "out" / "_checkpoint").rename(tmp_path / f"checkpoint-{turn}")
        assert sorted(r.n for r in spark.read.parquet(f"{out}/data").collect()) == sorted({*range(1000)} - {417})
        assert [(r.id, r.tries) for r in spark.read.parquet(f"{out}/dead").collect()] == [(417, 3)]


def test_window_scoring_wants_decoded_rows(spark):
    with pytest.raises(ValueError, match="start_decode"):
        jobs.start_anomaly(spark.readStream.format("rate").load(), "base", "out", decode=decode)
