"""Device, network, subscription and user columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendloom.functions.text import strip

# Plan names that count as premium.
PREMIUM_PLANS = ("VIP", "HBO GO+", "K+", "MAX", "MAX XMAS")


def platform_name(c: Column) -> Column:
    return strip(F.lower(c))


def network_name(c: Column) -> Column:
    return strip(F.upper(c))


def platform_group(c: Column) -> Column:
    return group_of_platform(platform_name(c))


def group_of_platform(p: Column) -> Column:
    """The group of a trimmed name. Each test holds the name, so over many rows it is best made a column of its own before."""
    return (
        F.when(p.startswith("fplay-ottbox") | p.isin("androidtvboxhis22", "fplay-gr-android-box"), "OTTBox")
        .when(p.contains("smarttv") | p.contains("smart-tv"), "SmartTV")
        .when(p.isin("android", "vsmart"), "Android")
        .when(p == "ios", "iOS")
        .when(p.contains("web"), "Web")
        .otherwise("Other")
    )


def network_type_norm(c: Column) -> Column:
    return type_of_network(network_name(c))


def type_of_network(n: Column) -> Column:
    """The type of a trimmed name; as for platforms."""
    return (
        F.when(n.isin("WIFI", "WLAN"), "WiFi")
        .when(n.isin("WWAN", "3G", "4G", "LTE", "5G"), "Mobile")
        .when(n == "ETHERNET", "Ethernet")
        .when(n.isin("CAB", "CABLE"), "Cable")
        .otherwise("Unknown")
    )


def has_premium(c: Column, plans: Iterable[str] = PREMIUM_PLANS) -> Column:
    wanted = list(plans)
    found = F.exists(c, lambda e: strip(F.substring_index(e, ":", 1)).isin(*wanted))
    return F.coalesce(found, F.lit(False))


def subscription_count(c: Column) -> Column:
    return F.array_size(c)


def user_id_hashed(c: Column) -> Column:
    return F.sha2(c.cast("string"), 256)


def session_key(user: Column, isp: Column, platform: Column, ts: Column, bucket_s: int = 1800) -> Column:
    """Readable session key; null when an anonymous event lacks its ISP or platform."""
    bucket = F.floor(F.unix_seconds(ts) / bucket_s).cast("string")
    known = F.concat(user, F.lit("|"), bucket)
    anonymous = F.concat(isp, F.lit("|"), platform, F.lit("|"), bucket)
    return F.when(user.isNotNull(), known).otherwise(anonymous)


def search_session_id(user: Column, isp: Column, platform: Column, ts: Column, bucket_s: int = 1800) -> Column:
    return F.sha2(session_key(user, isp, platform, ts, bucket_s), 256)
