"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR  folder with the tables (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default 8)

``warm_up`` is the session's start-up.  ``build_*`` entries time the staged inputs
(cleaned sales, star, panel); the queries then read them, best of two runs, every
result row computed.  With BENCH_MODELS=1 the training chain (four models of full
size, calibration), the snapshot model and the contributions of the boosted model
are timed too; they take many minutes, as each boosting round is several jobs.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.plans import bases  # noqa: E402
from tidemark.plans.registry import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = [
    "q1_monthly", "q2_brand", "q3_region_share", "q4_top_customers", "q5_segment_share", "q6_mom", "q7_delay", "q8_top3_rank",
    "q9_cohort_m2", "q10_demographics", "op_dedupe_key", "op_quantile_trim", "op_rfm_scores", "op_panel_features", "op_describe",
    "ml_roc_auc", "ml_avg_precision",
]
BUILDS = {
    "build_sales_clean": bases.sales,
    "build_segments": bases.segments,
    "build_star": lambda spark, folder: dict(bases.star_tables(spark, folder)),
    "build_panel": bases.entity_panel,
    "build_features": bases.features,
}


def warm_up(spark, folder: str) -> None:
    """Start-up apart from the work: first read, join, aggregate and write of the session."""
    lines, orders = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("lineitem", "orders"))
    run(lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).groupBy("o_orderpriority").count())


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    start = time.perf_counter()
    warm_up(spark, folder)
    times["warm_up"] = round(time.perf_counter() - start, 3)
    for name, make in BUILDS.items():
        start = time.perf_counter()
        make(spark, folder)
        times[name] = round(time.perf_counter() - start, 3)
    for name in HEADLINE:
        best = None
        for _ in range(2):
            start = time.perf_counter()
            run(QUERIES[name](spark, folder))
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
    if os.environ.get("BENCH_MODELS") == "1":
        for name in ("ml_chain_report", "ml_snapshot_model", "ml_contributions"):
            start = time.perf_counter()
            run(QUERIES[name](spark, folder))
            times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rstrip("/").split("sf")[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
