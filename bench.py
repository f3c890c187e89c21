"""Time the stages and the headline queries; prints one JSON line.

BENCH_SF_DIR is the folder of the input tables, BENCH_CPUS the number of local cores, BENCH_RUNS
how often each query is repeated after one warm-up run (the median counts). The stages are built
from scratch on each run and timed on their own; the queries that follow read them.
"""

import json
import os
import statistics
import time

from tallywright.checks import registry
from tallywright.plans.stages import Stages
from tallywright.session import local_session

HEADLINE = [
    "b_clean_erp",
    "e_match_table",
    "f_reconciliation",
    "d4_unexpected_payments",
    "g_register",
    "h_by_customer",
    "h_insights",
    "anom_zscore",
    "anom_iqr",
    "r1_status_summary",
    "r3_high_impact",
    "r6_by_customer",
    "v1_priority_queue",
    "v3_anomalies_by_gateway",
    "v10_executive",
    "k1_exception_table",
    "k3_transaction_table",
    "k5_kpis",
    "k11_measures",
]
STAGES = ["cleaned", "matches", "reconciliation", "exceptions", "anomalies"]


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, int(cpus))
    spark.sparkContext.setLogLevel("ERROR")

    seconds: dict[str, list[float]] = {}
    for _ in range(2):
        fresh = Stages(spark, registry.raw_tables(spark, folder))
        for stage in STAGES:
            took = timed(lambda: getattr(fresh, stage))
            seconds.setdefault(f"stage_{stage}", []).append(took)

    for name in HEADLINE:
        run = lambda: drain(registry.QUERIES[name](spark, folder))
        run()
        seconds[name] = [timed(run) for _ in range(runs)]

    # of the two stage builds the second is warm
    medians = {
        n: round(t[-1] if n.startswith("stage_") else statistics.median(t), 3)
        for n, t in seconds.items()
    }
    print(
        json.dumps(
            {
                "metric": "total seconds, warm stages and headline queries",
                "value": round(sum(medians.values()), 3),
                "unit": "sec",
                "queries": medians,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "shuffle_partitions": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
