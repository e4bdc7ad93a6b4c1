import unicodedata

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from trendloom.functions import devices, genres, text, timestamps


def apply(spark, fn, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in rows.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


CLEAN = {
    "٢٠٢٢-٠٦-٠١ ١٣:٥٧:٤٧.٦٤٧": "2022-06-01 13:57:47.647",
    "۲۰۲۲-۰۶-۱۴ ۱۳:۰۴:۲۱.۶۲۱": "2022-06-14 13:04:21.621",
    "2565-06-01 00:03:06.660": "2022-06-01 00:03:06.660",
    "0004-06-01 02:54:04.793": "0004-06-01 02:54:04.793",
    "2022-06-01 6:39:27.6331 CH": "2022-06-01 06:39:27.633",
    " \t2022-06-01   13:39:27.63 ": "2022-06-01 13:39:27.63",
    "2022-06-01 13:39:27": "2022-06-01 13:39:27.000",
    "2022-06-01 13:39:27 +07:00": "2022-06-01 13:39:27.000",
    "2022-06-01 13:39:27.": "2022-06-01 13:39:27.000",
    "2022-06-01 13:39": None,
    "not a date": None,
    "": None,
    None: None,
}


def test_clean_datetime(spark):
    assert apply(spark, timestamps.clean_datetime, CLEAN) == list(CLEAN.values())


def test_clean_datetime_holds_its_chain_once(spark):
    plan = plan_of(spark.createDataFrame([("x",)], "c string").select(timestamps.clean_datetime(F.col("c")).alias("x")))
    assert plan.count("translate(") == 1


def test_impossible_times_are_null_and_corrupt_years_dropped(spark):
    def kept(c):
        return timestamps.plausible_year(timestamps.parse_event_ts(timestamps.clean_datetime(c)))

    values = ["2022-02-30 10:00:00.000", "2022-06-01 24:00:00.000", "0004-06-01 02:54:04.793", "2015-01-01 00:00:00.000"]
    assert apply(spark, kept, values) == [None, None, False, True]


def test_local_hour_wraps(spark):
    assert apply(spark, lambda c: timestamps.local_hour(c.cast("timestamp")), ["2022-06-01 16:59:59", "2022-06-01 17:00:00"]) == [23, 0]


def test_cross_partition_date(spark):
    rows = spark.createDataFrame([("2022-06-01", "2022-06-01"), ("2022-06-01", "2565-06-01"), ("2022-06-01", "٢٠٢٢-٠٦-٠١")], "t string, dt string")
    flag = timestamps.cross_partition_date(F.col("t").cast("timestamp"), F.col("dt"))
    assert [r.x for r in rows.select(flag.alias("x")).collect()] == [False, True, None]


def test_platform_group(spark):
    cases = {
        "fplay-ottbox-x": "OTTBox", " AndroidTVBoxHis22 ": "OTTBox", "fplay-gr-android-box": "OTTBox", "Smart-TV-1": "SmartTV",
        "xsmarttv": "SmartTV", "vsmart": "Android", "android": "Android", "IOS": "iOS", "web-x": "Web", "Android TV": "Other", "": "Other", None: "Other",
    }
    assert apply(spark, devices.platform_group, cases) == list(cases.values())


def test_network_type(spark):
    cases = {"wlan": "WiFi", " wifi ": "WiFi", "5g": "Mobile", "WWAN": "Mobile", "ethernet": "Ethernet", "cab": "Cable", "###": "Unknown", None: "Unknown"}
    assert apply(spark, devices.network_type_norm, cases) == list(cases.values())


def test_subscriptions(spark):
    values = [["MAX XMAS : 3"], ["basic"], ["basic", "K+"], [None], [None, "VIP:1"], [], None]
    assert apply(spark, devices.has_premium, values, "array<string>") == [True, False, True, False, True, False, False]
    assert apply(spark, devices.subscription_count, values, "array<string>") == [1, 1, 2, 1, 2, 0, None]


def test_session_key_is_null_when_a_part_is_missing(spark):
    rows = spark.createDataFrame(
        [("u", None, None), (None, "isp", "tv"), (None, None, "tv")], "u string, i string, p string"
    )
    key = devices.session_key(F.col("u"), F.col("i"), F.col("p"), F.lit("1970-01-01 01:00:00").cast("timestamp"))
    assert [r.k for r in rows.select(key.alias("k")).collect()] == ["u|2", "isp|tv|2", None]


def test_preprocess_keyword(spark):
    cases = {
        "one piece tap 12": "one piece", "[vietsub] why her": "why her", "conan (2024)": "conan", "goooooal": "gooal",
        "a b​c　d": "a b c d", "  x \t y ": "x y", "part 3": "part 3", "naruto EP5": "naruto",
        "(phụ đề) xin chào": "xin chào", "[]x": "[]x", "aaa bbb": "aa bb", "": "",
    }
    assert apply(spark, text.preprocess_keyword, cases) == list(cases.values())


def test_strip_diacritics_agrees_with_unicode_and_keeps_d(spark):
    values = ["tiểu lý phi đao", "Ünïcödé ñ ç", "é ậ", "kênh vtv3", "ÀẢÃÁẠ ơ ư", "αά йё"]
    expected = ["".join(x for x in unicodedata.normalize("NFD", v) if unicodedata.category(x) != "Mn") for v in values]
    assert apply(spark, text.strip_diacritics, values) == expected
    assert expected[0] == "tieu ly phi đao"
    assert apply(spark, lambda c: text.strip_diacritics(c, fold_d=True), ["phi đao Đ"]) == ["phi dao D"]


def test_normalize_genre(spark):
    cases = {"kdrama": "PHIM_HAN", " K-pop ": "NHAC", "ANIME": "ANIME", "phim_le": "PHIM_VIET", "x": "UNKNOWN", "": "UNKNOWN", None: "UNKNOWN"}
    assert apply(spark, text.normalize_genre, cases) == list(cases.values())


def test_sanitize_and_keyword_norms(spark):
    assert apply(spark, text.sanitize_keyword, ["a\\b\n", "\x7fx\x00"]) == ["a b", "x"]
    assert apply(spark, text.keyword_norm, [" A ", "", "\tA", None]) == ["a", "", "\ta", None]
    assert apply(spark, text.stream_keyword_norm, [" A ", "", "\tA", None]) == ["a", None, "a", None]


@pytest.mark.parametrize(
    "keyword, genre",
    [
        ("xem KÊNH gì", "TRUYEN_HINH"), ("êkênh", None), ("k+", None), ("xk+x", None), ("k+x", "THE_THAO"), ("trực tiếp", "TRUYEN_HINH"),
        ("trực tiếp a vs b", "THE_THAO"), ("nhạc anime", "ANIME"), ("phim hàn quốc", "PHIM_HAN"), ("phim về cô gái", "PHIM_VIET"),
        ("reply 1988", "PHIM_HAN"), ("kpop", "NHAC"), ("v league", None), ("v-league", "THE_THAO"), ("", None), (None, None),
    ],
)
def test_regex_genre(spark, keyword, genre):
    import re

    if keyword is not None:
        hit = next((g for g in genres.GENRE_ORDER if re.search(genres.genre_alternation(g), keyword, re.I)), None)
        assert hit == genre
    assert apply(spark, genres.regex_genre, [keyword]) == [genre]
