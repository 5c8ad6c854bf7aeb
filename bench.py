"""Benchmark the headline reports; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 5). Each query runs once to warm up, then BENCH_RUNS times;
the median is reported. Results are executed in full through the ``noop`` sink
(nothing is collected to the driver).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickpath.plans import catalog as C  # noqa: E402
from clickpath.session import build_session  # noqa: E402

HEADLINE = {
    "q1_category_top10": C.category_top10,              # R1
    "q2_category_top10_sessions": C.category_top10_sessions,  # R2
    "q3_page_flow_conversion": C.page_flow_conversion,  # R3
    "q4_ad_blacklist": C.ad_blacklist,                  # R4
    "q5_area_city_ad_daily": C.area_city_ad_daily,      # R5
    "q6_area_top3_ads_json": C.area_top3_ads_json,      # R6
    "q7_ad_trend_10s": C.ad_trend_10s,                  # R7
    "q8_page_avg_dwell": C.page_avg_dwell,              # R8
    "q9_word_count": C.word_count,                      # R9
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = build_session(f"local[{cpus}]", cpus, app_name="clickpath-bench",
                          extra={"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name, q in HEADLINE.items():
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            q(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 4)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 4),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "runs": runs}))


if __name__ == "__main__":
    main()
