"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is planned and executed in full into the `noop` sink (no driver
collection).  One warm-up pass, then the median of $BENCH_REPS timed runs.
Prints ONE JSON line, with the one-off write of the curated layer as `curated_write`.  Set
BENCH_ALL=1 to time every registered query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "curate_daily_ohlcv", "daily_factors", "curate_ticks", "curate_quotes_l1", "curate_quotes_l2",
    "session_vwap", "top_of_book", "l2_at", "index_daily", "movers", "symbol_kpis", "equity_stats",
    "missing_days", "tick_vs_daily", "in_session", "parse_ticks", "write_receipts", "alert_suppress",
    "atr_gap_range", "sector_heatmap", "distinct_symbols",
]
# the curated tables that downstream queries scan; writing them is timed on its own line
CURATED = ["curated_daily", "curated_corp_actions", "curated_ticks", "curated_l1", "curated_l2", "curated_index",
           "curated_fundamentals"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    from marketlake.registry import QUERIES, lake, load_all
    from marketlake.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2, app="marketlake-bench")
    load_all()
    names = list(QUERIES) if os.environ.get("BENCH_ALL") else HEADLINE
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    t = time.perf_counter()
    for table in CURATED:
        getattr(lake(spark, sf_dir), table)
    curated_write = round(time.perf_counter() - t, 3)
    for n in names:
        def run():
            t = time.perf_counter()
            QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t
        run()  # warm-up (JIT, file listing, codegen)
        times[n] = round(statistics.median(run() for _ in range(reps)), 3)
    for n in ("curate_daily_ohlcv", "curate_ticks"):
        rows[n] = QUERIES[n](spark, sf_dir).count()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus), "reps": reps, "rows": rows, "curated_write": curated_write}))
    spark.stop()


if __name__ == "__main__":
    main()
