"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores; each query is run in full into a no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparkdesk.plans import load_all
from sparkdesk.plans.registry import QUERIES
from sparkdesk.session import get_session

HEADLINES = (
    "p01_typed_silver", "p04_wide_to_long", "a01_station_load", "a02_weekday_load", "a05_transfer_pattern", "a07_hourly_load",
    "a12_heat_map_wide", "w01_peak_hours", "m01_insert_only_daily", "m03_running_mean", "m05_transfer_pattern_merge",
    "p23_usage_shares", "j01_build_panel", "j07_missing_days", "a22_describe_amounts", "b05_total_score", "b08_statement_row",
    "j11_resolve_names", "w13_latest_filings", "x01_html_to_text", "x03_remove_noise", "x05_packed_chunks", "x06_chunk_table",
    "x12_chunk_quality", "x17_stratified_split", "b20_question_tags", "v01_cosine_top_k", "v05_bm25", "v06_fused_ranks",
    "k04_cluster_profile", "k08_correlation", "k18_anova",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINES
    load_all()
    spark = get_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # start the engine
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
