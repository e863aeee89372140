"""Headline timings on one machine, as one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Queries run from the given tables to the collected result, nothing cached between runs; each figure is the best of
three runs after a warm-up. `full_run` is the whole pipeline from CSV files to report files, with its stages.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskmart import session  # noqa: E402
from riskmart.operators import quality, runlog  # noqa: E402
from riskmart.plans import pipeline  # noqa: E402
from riskmart.plans.queries import CHECKED_YEAR, QUERIES  # noqa: E402
from riskmart.sources import given  # noqa: E402

HEADLINE = ["gold_monthly_report", "silver_provision_summary", "bronze_split_counts", "bronze_transactions",
            "silver_loan_accounts", "dq_results", "recon_results", "report_npl_by_region", "diag_quarantine_reasons",
            "runlog_recent"]
WIDE = {"bronze_transactions", "silver_loan_accounts"}  # all rows and columns: written, not collected
RUNS = 3


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def write_sources(spark, folder: str) -> str:
    """The given tables as CSV source files, every rate present."""
    target = f"{session.shared_folder(spark)}/riskmart-bench/{uuid.uuid4().hex}"
    given.transaction_source(spark, folder).drop("_load_seq").repartition(8).write.option("header", True).csv(f"{target}/transactions")
    month, currency = given.MISSING_RATE
    missing = spark.createDataFrame([(month, currency, "43.4571", "bank")], given.fx_source(spark, folder).schema)
    given.fx_source(spark, folder).unionByName(missing).coalesce(1).write.option("header", True).csv(f"{target}/rates")
    return target


def full_run(spark, sources: str, name: str) -> dict[str, float]:
    """Seconds of the whole run and of each stage."""
    settings = pipeline.Settings(f"{sources}/transactions", f"{sources}/rates", f"{sources}/{name}", CHECKED_YEAR)
    run = pipeline.Run(spark, settings)
    total = seconds(run.execute)
    runs = runlog.current(runlog.read_events(spark, run.log.path)).collect()
    return {"full_run": total} | {f"full_run.{r['step_name']}": float(r["duration_sec"]) for r in runs}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session.create("riskmart-bench", f"local[{cpus}]", **{
        # The given tables are small files: split them among the cores, as large ones are by themselves.
        "spark.sql.files.maxPartitionBytes": "1m", "spark.sql.files.openCostInBytes": "0",
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")

    times: dict[str, float] = {}
    for name in HEADLINE:
        def run(name=name) -> None:
            result = QUERIES[name](spark, folder)
            result.write.format("noop").mode("overwrite").save() if name in WIDE else result.collect()
        run()
        times[name] = min(seconds(run) for _ in range(RUNS))
    sources = write_sources(spark, folder)
    try:
        full_run(spark, sources, "warm-up")
        times |= full_run(spark, sources, "timed")
    except quality.ChecksFailed as problem:  # tables without a complete year stop at the gate
        print(f"full run stopped: {problem}", file=sys.stderr)
    headline = [v for k, v in times.items() if "." not in k]
    print(json.dumps({"metric": "headline_total", "value": round(sum(headline), 3), "unit": "sec",
                      "queries": {k: round(v, 3) for k, v in times.items()},
                      "sf": float(os.path.basename(folder.rstrip("/")).removeprefix("sf")), "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
