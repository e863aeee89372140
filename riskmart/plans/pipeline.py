"""The full run: eight stages in fixed order, tables between them, each stage recorded, stop at the first failure.

    python -m riskmart.plans.pipeline --transactions txns.csv --rates fx.csv --root /shared/risk --year 2024
"""

from __future__ import annotations

import argparse
import logging
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from riskmart import session
from riskmart.operators import bronze, constraints, gold, quality, reconcile, reports, rules, runlog, silver
from riskmart.sources import landing, reports_csv, tables
from riskmart.sources.tables import Tables
from riskmart.spec import STAGES, TRANSACTION_COLUMNS

log = logging.getLogger(__name__)
PIPELINE_NAME = "full_pipeline"


@dataclass
class Settings:
    """What a run reads, where it stores its tables and reports, and which year must be complete."""

    transactions: str
    rates: str
    root: str
    year: int
    months: int = 12
    tolerance: str = "1.00"
    require_all_rates: bool = False
    multi_line: bool = False
    report_folder: str | None = None
    keep_runs: int | None = None  # published writes kept of each table; all of them unless given


@dataclass
class Run:
    """One run over one root folder."""

    spark: SparkSession
    settings: Settings
    started: datetime = field(default_factory=lambda: datetime.now(timezone.utc).replace(tzinfo=None))

    def __post_init__(self):
        self.spark = session.configured(self.spark)
        self.run_id = self.started.strftime("%Y%m%d_%H%M%S_%f")
        self.tables = Tables(self.spark, self.settings.root, self.run_id)
        self.log = runlog.RunLog(self.spark, f"{self.settings.root.rstrip('/')}/{tables.RUN_LOG}", PIPELINE_NAME)
        self.files: list[str] = []

    def execute(self, from_stage: str | None = None) -> None:
        """All stages, or those from the named one on, which then read what an earlier run stored."""
        for stage in STAGES[STAGES.index(from_stage) if from_stage else 0:]:
            run_id = self.log.start(stage)
            try:
                rows = getattr(self, stage)()
            except Exception as problem:
                self.log.end(run_id, runlog.FAILED, error=str(problem))
                raise
            self.log.end(run_id, runlog.SUCCESS, rows=rows)
            log.info("%s: %s rows", stage, rows)

    def _land(self, path: str, table: str) -> tuple[int, DataFrame]:
        """Store a source file, unpublished, and check that as many rows were stored as read."""
        read = Observation(f"read_{table}")
        landed = landing.land_csv(self.spark, path, self.started.isoformat(), self.settings.multi_line)
        stored = self.tables.write(table, landed.observe(read, F.count(F.lit(1)).alias("rows")), publish=False)
        return landing.check_count(read.get["rows"], stored.count(), table), stored

    def load_raw_transaction(self) -> int:
        rows, _ = self._land(self.settings.transactions, tables.RAW_TRANSACTIONS)
        self.tables.publish(tables.RAW_TRANSACTIONS)
        return rows

    def load_fx_rate(self) -> int:
        rows, stored = self._land(self.settings.rates, tables.RAW_FX)
        repeated = landing.repeated_keys(stored, ["rate_month", "currency_code"])
        repeated = self.tables.write(tables.REPEATED_RATES, repeated)
        landing.require_unique(repeated, tables.RAW_FX, self.tables.path(tables.REPEATED_RATES))
        self.tables.publish(tables.RAW_FX)
        return rows

    def _publish(self, table: str, rows: DataFrame, partition_by: list[str] | None = None) -> tuple[int, DataFrame]:
        """Store a layer, publish it if it keeps its constraints; (number of rows, the layer as stored).

        Rows and broken conditions are counted by the write itself.
        """
        declared, counted = constraints.CONSTRAINTS[table], Observation(f"write_{table}")
        stored = self.tables.write(table, rows.observe(counted, *constraints.metrics(declared)), partition_by, publish=False)
        constraints.require(table, declared, counted.get, stored)
        self.tables.publish(table)
        return counted.get["rows"], stored

    def bronze_transform(self) -> int:
        """Judge the raw rows once and store the outcome, good and bad apart; then remove copies of transactions.

        Raw text is read and converted in one pass. Only good rows whose key may repeat are shuffled (see `firsts`).
        """
        judged = bronze.judge(self.tables.read(tables.RAW_TRANSACTIONS)).drop("_task")
        good, split = F.col(bronze.RULE).isNull(), Observation("judged")
        judged = self.tables.write(tables.JUDGED, judged.withColumn("_good", good).observe(
            split, F.count_if("_good").alias("good"), F.count_if(~F.col("_good")).alias("bad")), ["_good"])
        self._publish(tables.QUARANTINE, bronze.quarantine(judged.where("not _good"), self.started.isoformat(" ")))
        kept = bronze.without_copies(bronze.passed(judged.where("_good")).drop("_good"))
        rows, _ = self._publish(tables.BRONZE, self._stamped(kept, "bronze"))
        log.info("Bronze: %s good, %s quarantined, %s duplicate, %s stored", split.get["good"], split.get["bad"],
                 split.get["good"] - rows, rows)
        self.tables.drop(tables.JUDGED)
        return rows

    def _stamped(self, layer: DataFrame, name: str) -> DataFrame:
        """The layer with the run's one time of loading."""
        return layer.withColumn(f"_{name}_loaded_at", F.lit(self.started.isoformat(" ")).cast("timestamp_ntz"))

    def silver_transform(self) -> int:
        bronze_rows, fx = self.tables.read(tables.BRONZE), self.tables.read(tables.RAW_FX)
        if self.settings.require_all_rates:
            rules.require_rates(bronze_rows, fx)
        # One folder per month, so that readers of a month read only it. Without a shuffle every task would write a
        # file for every month; rebalancing gathers a month and splits one that is large among many tasks.
        built = self._stamped(silver.build(bronze_rows, fx), "silver").hint("rebalance", "txn_month")
        rows, stored = self._publish(tables.SILVER, built, ["txn_month"])
        unmatched = silver.eligible(bronze_rows).count() - rows  # reads one column of Bronze
        if unmatched:
            log.warning("Silver: %s rows with debt have no exchange rate", unmatched)
        log.info("Silver: status %s; provision %s", silver.status_distribution(stored).collect(),
                 silver.provision_summary(stored).collect())  # a row per status, and per code and rate
        return rows

    def _silver(self) -> DataFrame:
        """Silver as stored; the month is a folder name and must stay text."""
        folder = self.tables.newest(tables.SILVER)
        if folder is None:
            raise FileNotFoundError(f"{self.settings.root}/{tables.SILVER} has no published write")
        schema = silver.build(self.tables.read(tables.BRONZE), self.tables.read(tables.RAW_FX)).schema
        return self.spark.read.schema(schema).parquet(folder).select(*TRANSACTION_COLUMNS, *silver.ADDED_COLUMNS)

    def gold_aggregate(self) -> int:
        rows, stored = self._publish(tables.GOLD, self._stamped(gold.monthly(self._silver()), "gold"))
        log.info("Gold: %s; totals %s", gold.listing(stored).collect(), gold.totals(stored).first())  # a row per month
        return rows

    def data_quality(self) -> int:
        results = quality.checks(self._silver(), self.tables.read(tables.GOLD), self.settings.year,
                                 self.settings.months)
        return len(quality.gate(results))

    def reconciliation(self) -> int:
        results = reconcile.checks(self.tables.read(tables.BRONZE), self._silver(), self.tables.read(tables.GOLD),
                                   self.settings.tolerance)
        return len(quality.gate(results))

    def export_report(self) -> int:
        sums, kpis = self.tables.write(tables.REPORT_SUMS, reports.sums(self._silver())), self.tables.read(tables.GOLD)
        folder = self.settings.report_folder or f"{self.settings.root.rstrip('/')}/reports"
        stamp = self.started.strftime("%Y%m%d_%H%M%S")
        contents = {
            reports_csv.CREDIT_RISK_SUMMARY: reports.credit_risk_summary(kpis),
            reports_csv.NPL_MONTHLY: reports.npl_breakdown_of(sums, "txn_month"),
            reports_csv.NPL_BY_REGION: reports.npl_breakdown_of(sums, "primary_branch_region"),
            reports_csv.NPL_BY_ACCOUNT_TYPE: reports.npl_breakdown_of(sums, "account_type"),
            reports_csv.PROVISION_MONTHLY: reports.provision_monthly_of(sums),
            reports_csv.PROVISION_BY_DELINQUENCY: reports.provision_by_delinquency_of(sums),
        }
        first_rows = reports.preview(contents[reports_csv.CREDIT_RISK_SUMMARY]).collect()
        log.info("%s: %s rows, first: %s", reports_csv.CREDIT_RISK_SUMMARY, kpis.count(), first_rows)
        self.files = [reports_csv.export(report, folder, name, stamp) for name, report in contents.items()]
        if self.settings.keep_runs:
            self.tables.retain(self.settings.keep_runs)
        return len(self.files)


def run(spark: SparkSession, settings: Settings, from_stage: str | None = None) -> Run:
    """Execute a run and give it back, with its tables and report files."""
    done = Run(spark, settings)
    done.execute(from_stage)
    return done


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--transactions", required=True)
    parser.add_argument("--rates", required=True)
    parser.add_argument("--root", required=True)
    parser.add_argument("--year", type=int, required=True)
    parser.add_argument("--months", type=int, default=12)
    parser.add_argument("--from-stage", choices=STAGES)
    parser.add_argument("--require-all-rates", action="store_true")
    parser.add_argument("--multi-line", action="store_true")
    parser.add_argument("--keep-runs", type=int)
    arguments = vars(parser.parse_args())
    from_stage = arguments.pop("from_stage")
    logging.basicConfig(level=logging.INFO)
    done = run(session.create("riskmart"), Settings(**arguments), from_stage)
    runlog.recent(runlog.current(runlog.read_events(done.spark, done.log.path)), done.started.date(), 1).show(50, False)


if __name__ == "__main__":
    main()
