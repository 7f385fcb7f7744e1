"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of source tables, BENCH_CPUS the number of local cores. Each time is
the best of BENCH_RUNS runs after one warm-up, from building the frame to the last result row.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from salesloom import scratch  # noqa: E402
from salesloom.plans.catalogue import QUERIES  # noqa: E402
from salesloom.session import build_session  # noqa: E402

HEADLINE = [
    "derive_metrics",
    "null_profile",
    "summary_yearly",
    "summary_regional",
    "summary_top_products",
    "quality_report",
    "dim_customer",
    "dim_product",
    "dim_location",
    "dim_date",
    "fact_sales",
    "star_fk_coverage",
    "star_pk_violations",
    "star_ship_date_gap",
    "star_revenue_by_month",
    "panel_kpis",
    "panel_revenue_by_month",
    "panel_segment_by_month",
    "panel_top_customers",
    "panel_cities",
    "panel_top_products",
    "silver_roundtrip",
]


def seconds(spark, query, base: str) -> float:
    begin = time.perf_counter()
    query(spark, base).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        int(cpus) if cpus.isdigit() else 8,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        seconds(spark, QUERIES[name], base)
        times[name] = round(min(seconds(spark, QUERIES[name], base) for _ in range(runs)), 3)
    scratch.clear(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(base.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
