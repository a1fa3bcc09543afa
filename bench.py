"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS choose the data and the cores.
Each query runs once to warm up and is then timed, its whole result computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

from creditloom.queries import QUERIES, load_all
from creditloom.session import local_session

HEADLINE = (
    "clean_application", "clean_bureau", "clean_bureau_balance", "clean_installments",
    "agg_bureau", "agg_bureau_balance", "agg_pos_cash", "agg_installments", "build_abt",
    "qa_bureau_balance", "quantiles", "quantile_bands", "percentile_of_each", "rank_by", "corr_matrix", "table_catalog",
    "stratified_split", "ranking_metrics", "threshold_sweep", "segment_risk", "portfolio_benchmark",
    "psi_numeric", "drift_report", "whatif", "triage", "top_factors",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    names = sys.argv[1:] or HEADLINE
    load_all()
    spark = local_session(cpus, "bench")
    times = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
