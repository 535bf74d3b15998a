"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores. Each query runs to a no-op sink after one short
warm-up of the session; the upsert and compaction figures use tables written by the bench itself.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from viewtide.bind import Playback
from viewtide.catalog import QUERIES
from viewtide.session import build_session, work_path
from viewtide.sources import tables

HEADLINE = (
    "rz1_build_raw_events", "rz1_quarantine", "fx1_fact_events", "fx2_fact_sessions", "fx3_fact_daily",
    "m1_content_engagement", "m2_device_engagement", "m3_genre_mix", "m4_completion_funnel", "m6_cohort_retention",
    "r1_top_titles", "r6_active_users", "r14_peak_concurrency", "q1_fact_equals_raw", "q19_session_sanity",
    "q29_position_drops", "a1_group_stats", "a7_percentiles_lineitem", "a15_pivot", "w1_latest_per_key", "w2_rank_all",
    "w5_running_sum", "w8_pct_of_group", "w10_top_n", "w12_sessionize", "w13_dedup_latest", "w17_rolling_actives",
    "dm1_upsert_scd1", "j2_attach_left", "st1_land_stream", "q_reconciliation", "fx2_incremental")


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def to_nowhere(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def storage_figures(spark, folder: str) -> dict:
    """Seconds to upsert 1 % and 10 % changed keys, and files before and after compaction."""
    p = Playback(spark, folder)
    path = work_path(spark, "bench-raw")
    tables.upsert(p.deduplicated, path, ["event_id"], ["event_date"], ["server_received_at"])
    out = {}
    for label, step in (("1pct", 100), ("10pct", 10)):
        later = F.col("server_received_at") + F.expr("interval 1 second")
        batch = p.deduplicated.where(F.col("event_id") % step == 0).withColumn("server_received_at", later)
        out[f"upsert_{label}_sec"] = timed(lambda b=batch: tables.upsert(
            b, path, ["event_id"], ["event_date"], ["server_received_at"]))
    small = work_path(spark, "bench-small")
    rows = p.deduplicated.select("event_id", "event_date")
    for _ in range(3):
        tables.append(rows, small, ["event_date"])
    out["compact_sec"] = timed(lambda: out.update(tables.compact(spark, small, ["event_date"])))
    return out


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"), "spark.sql.shuffle.partitions": cpus,
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    for name in ("fx2_fact_sessions", "w5_running_sum"):
        to_nowhere(QUERIES[name].run(spark, folder))
    seconds = {name: timed(lambda q=QUERIES[name]: to_nowhere(q.run(spark, folder))) for name in HEADLINE}
    events = spark.read.parquet(f"{folder}/events.parquet").count()
    rates = {"raw_rows_per_sec": round(events / seconds["rz1_build_raw_events"]),
             "session_rows_per_sec": round(events / seconds["fx2_fact_sessions"])}
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")), "cpus": int(cpus), **rates,
                      "storage": storage_figures(spark, folder)}))
    spark.stop()


if __name__ == "__main__":
    main()
