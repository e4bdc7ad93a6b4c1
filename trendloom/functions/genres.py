"""Regex stage of the genre classifier."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns per genre. The first genre with a match, in this order, wins.
GENRE_PATTERNS = {
    "THE_THAO": (
        r"bóng đá", r"bong da", r"thể thao", r"the thao", r"nexsport",
        r"trực tiếp.*vs", r"\bvs\b.*việt nam", r"\bvs\b.*viet nam",
        r"tennis", r"bóng rổ", r"futsal", r"world cup", r"v-?league",
        r"\bk\+\b", r"cầu lông", r"cau long", r"bóng chuyền", r"bong chuyen",
        r"boxing", r"\bmma\b", r"kickboxing", r"võ thuật",
        r"\bolympic\b", r"thế vận hội", r"the van hoi",
    ),
    "ANIME": (
        r"\banime\b", r"hoạt hình nhật", r"hoat hinh nhat",
        r"\bnaruto\b", r"\bone piece\b", r"\bkirito\b",
        r"chuyển sinh", r"cậu mang", r"học viện anh hùng",
        r"\bdragon ball\b", r"\bsword art online\b", r"\bbleach\b",
        r"\battack on titan\b", r"\bconan\b", r"\bkimetsu\b", r"demon slayer",
        r"jujutsu kaisen", r"\bjjk\b", r"my hero academia",
        r"\btokyo ghoul\b", r"\bhaikyuu\b",
    ),
    "NHAC": (
        r"bolero", r"trữ tình", r"tru tinh", r"nhạc", r"nhac", r"vpop", r"remix", r"mv\b",
        r"k-?pop", r"\bbts\b", r"blackpink", r"\btwice\b",
    ),
    "TRUYEN_HINH": (
        r"vtv[1-9]", r"htv[1-9]", r"\bkênh\b", r"\bkenh\b",
        r"trực tiếp$", r"truc tiep$", r"\bvtv\b", r"\bhtv\b",
        r"gameshow", r"game show", r"variety show", r"reality show",
        r"phát sóng", r"phat song",
    ),
    "PHIM_HAN": (
        r"phim hàn", r"phim han\b", r"hàn quốc", r"han quoc", r"k-?drama",
        r"crash landing", r"goblin", r"descendants.*sun",
        r"my love from.*star", r"reply \d{4}",
    ),
    "PHIM_AU_MY": (
        r"\bmarvel\b", r"\bdisney\b", r"\bnetflix\b", r"\bhbo\b",
        r"\bavengers\b", r"\bbatman\b", r"\bspiderman\b", r"\bsuperman\b",
        r"\bstar wars\b", r"\bfast.furious\b",
        r"\bparamount\b", r"apple tv\+?", r"amazon prime",
    ),
    "PHIM_TRUNG": (
        r"kiếm hiệp", r"kiem hiep", r"cổ trang", r"co trang",
        r"tiên hiệp", r"tien hiep", r"lương sơn bá", r"luong son ba",
        r"hoa thiên cốt", r"diên hy công lược", r"trường nguyệt tẫn minh",
    ),
    "PHIM_VIET": (
        r"phim việt", r"phim viet", r"phim bộ việt", r"phim bo viet",
        r"đài truyền hình", r"dai truyen hinh",
        r"phim.*(?:ngôi nhà|ngoi nha|cô gái|co gai|chàng trai|chang trai)",
    ),
}
GENRE_ORDER = tuple(GENRE_PATTERNS)
# Genres whose patterns are trusted over a looked-up label.
STRONG_GENRES = ("THE_THAO", "ANIME", "NHAC", "PHIM_HAN", "TRUYEN_HINH")


def genre_alternation(genre: str) -> str:
    return "|".join(f"(?:{p})" for p in GENRE_PATTERNS[genre])


def regex_genre(c: Column, genres: Iterable[str] = GENRE_ORDER) -> Column:
    """First genre, in the fixed order, with a matching pattern; null when none matches.

    The U flag is needed: without it Java folds case and finds word edges for ASCII only.
    """
    wanted = set(genres)
    branches = [(g, c.rlike("(?iU)" + genre_alternation(g))) for g in GENRE_ORDER if g in wanted]
    return reduce(
        lambda chain, branch: F.when(branch[1], F.lit(branch[0])).otherwise(chain),
        reversed(branches),
        F.lit(None).cast("string"),
    )
