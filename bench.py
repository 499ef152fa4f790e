"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local threads. The
smallest data set is run first, untimed, so that timings are not dominated by
the JVM loading and compiling code. `value` is a full refresh: line view,
quality gate, star, recommendations, adoption and run metrics, sharing nothing
with the other queries. Those share inputs the way published tables are shared;
the ones that build a shared input are timed building it.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tillspark.plans.queries import QUERIES
from tillspark.session import build_session

WARM_DIR = "/root/testdata/sf0.001"
HEADLINE = (
    "extract_typed", "extract_profile", "dq_results", "dq_flags", "dq_quarantine", "fact_sales",
    "dim_product", "dim_customer", "dim_date", "basket_items", "basket_pairs",
    "co_purchase_rules", "co_purchase_by_name", "tfidf_terms", "tfidf_documents",
    "content_similar", "recommendations", "rec_hubs", "adoption_headline", "adoption_weekly",
    "adoption_by_team", "sem_fact_sales", "ri_checks", "sales_measures", "rev_by_month",
    "rev_by_segment", "rev_ytd_mtd", "rev_yoy", "rev_r3m_daily", "rev_share", "product_rank",
    "top20_share", "dq_measures_by_rule", "rls_sales", "input_fingerprint", "full_refresh",
)


def run(spark, name: str, sf_dir: str) -> float:
    """Seconds to build the query and compute every row of it."""
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        f"local[{cpus}]",
        int(cpus) if cpus.isdigit() else None,
        {
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "20g"),
            "spark.driver.extraJavaOptions": "-XX:+UseParallelGC",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    if sf_dir != WARM_DIR and os.path.isdir(WARM_DIR):
        for name in names:
            run(spark, name, WARM_DIR)
    timings = {name: round(run(spark, name, sf_dir), 3) for name in names}
    headline = "full_refresh" if "full_refresh" in timings else names[0]
    print(
        json.dumps(
            {
                "metric": f"{headline}_seconds",
                "value": timings[headline],
                "unit": "sec",
                "queries": timings,
                "total": round(sum(timings.values()), 3),
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
