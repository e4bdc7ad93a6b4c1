"""Time the headline queries, warm, each operator on its own inputs; prints one JSON line.

Every query runs once to warm up and once for its time. ``log_1m`` is the enrichment of the events repeated until they
are at least a million, with shifted ids.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from trendloom.fixtures import tables  # noqa: E402
from trendloom.plans.enrichment import curate  # noqa: E402
from trendloom.registry.queries import QUERIES  # noqa: E402
from trendloom.session import build_session, stage  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))

# The daily run: enrichment, gold table, baseline, scoring; then the heavier single operators.
HEADLINE = (
    "search_enriched", "gold_keyword_trends", "baseline_stats", "anomaly_score", "injected_spike",
    "keyword_daily_stats", "rank_today", "is_repeat_search", "curated_profile", "abandonment_heatmap",
    "classify_rules", "fuzzy_lut_join", "token_subset_join", "replay_order", "throughput_metrics",
    "alarm_timeline", "genre_prf", "plan_lookup_fixes", "pii_scan", "dq_profile",
)


def main() -> None:
    spark = build_session(
        app="bench",
        master=f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "8g", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(make) -> float:
        start = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    # The layers are inputs of what follows; making them is timed by the queries themselves.
    for layer in (tables.search_log, tables.curated, tables.gold):
        layer(spark, SF_DIR)
    times = {}
    for name in HEADLINE:
        run(lambda: QUERIES[name](spark, SF_DIR))
        times[name] = run(lambda: QUERIES[name](spark, SF_DIR))

    log = tables.search_log(spark, SF_DIR)
    events = log.count()
    copies = -(-1_000_000 // events)
    shifted = F.concat(F.col("copy").cast("string"), F.lit("-"), F.col("eventid"))
    many = log.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).withColumn("eventid", shifted)
    many = stage(many.withColumn("user_id", F.when(F.col("user_id").isNotNull(), F.concat("copy", "user_id"))).drop("copy"), "log-1m")
    log_1m = run(lambda: curate(many, tables.lut(spark, SF_DIR)))
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "events": events,
                "enrichment_rows_per_sec": round(events / times["search_enriched"]),
                "log_1m_rows": copies * events,
                "log_1m_seconds": log_1m,
                "log_1m_rows_per_sec": round(copies * events / log_1m),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
