"""Benchmark of the headline queries.

Runs each query over the tables in $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints one JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {name: sec}, "sf": ...}

Every query is executed in full into the no-op sink (all rows produced, nothing
collected). One warm-up pass precedes the timed runs; each query's time is the
best of $BENCH_RUNS runs. Two extra entries time the fee summary over the
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from feeflow.operators import fees as fe  # noqa: E402
from feeflow.operators import flatten as fl  # noqa: E402
from feeflow.plans.queries import REGISTRY  # noqa: E402
from feeflow.session import get_session, scratch_path  # noqa: E402
from feeflow.sources import tables as tb  # noqa: E402

HEADLINE = [
    "tx_fees",
    "fee_summary",
    "tx_fees_docs",
    "tx_fees_rowlocal",
    "join_in_out_totals",
    "tx_flatten",
    "window_tx_groups",
    "window_event_counts",
    "describe_fees",
    "metrics_latest",
    "src_envelope_parse",
    "ml_rmse_percent",
]


# Fee summary over documents already stored as nested Parquet, the setting of the
NESTED = {
    "summary_nested_relational": lambda docs: fe.fee_summary(fe.fee_table(fl.fee_items(fl.expand(docs)))),
    "summary_nested_rowlocal": lambda docs: fe.fee_summary(fe.fee_table_rowlocal(fl.expand(docs))),
}


def run_once(spark, name: str, sf_dir: str, docs_path: str) -> float:
    t0 = time.perf_counter()
    if name in NESTED:
        df = NESTED[name](spark.read.parquet(docs_path))
    else:
        df = REGISTRY[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE + list(NESTED))).split(",") if n]
    spark = get_session(
        f"local[{cpus}]",
        app_name="feeflow-bench",
        shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", max(8, cpus * 2))),
        conf={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
        },
    )
    docs_path = scratch_path(spark, "bench/docs")  # untimed setup: the nested table
    tb.tx_documents(spark, sf_dir).write.parquet(docs_path)
    for name in names:  # warm-up: JIT, file listing caches, Python workers
        run_once(spark, name, sf_dir, docs_path)
    times = {name: round(min(run_once(spark, name, sf_dir, docs_path) for _ in range(runs)), 3) for name in names}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
