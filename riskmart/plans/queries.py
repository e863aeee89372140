"""Registered queries: one per job, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskmart.operators import bronze, constraints, diagnostics, gold, quality, reconcile, reports, rules, runlog, silver
from riskmart.plans.layers import Layers
from riskmart.sources import given, landing, tables
from riskmart.spec import LOAD_SEQ

Query = Callable[[SparkSession, str], DataFrame]
CHECKED_YEAR = 1997


def _over(job: Callable[[Layers], DataFrame]) -> Query:
    return lambda spark, folder: job(Layers(spark, folder))


def _silver_check(name: str) -> Query:
    return _over(lambda x: quality.row_checks(x.silver, quality.SILVER, [name]))


def _gold_check(name: str) -> Query:
    return _over(lambda x: quality.row_checks(x.gold, quality.GOLD, [name]))


def _reconciled(*names: str) -> Query:
    return _over(lambda x: reconcile.checks(x.bronze, x.silver, names=list(names) or None))


QUERIES: dict[str, Query] = {
    # Raw
    "ingest_transactions": _over(lambda x: x.raw.drop(LOAD_SEQ)),
    "ingest_fx_rates": _over(lambda x: x.fx),
    "ingest_lineage": _over(lambda x: x.raw.select("txn_id", "_loaded_at", "_source_file", LOAD_SEQ)),
    "ingest_row_count_check": _over(
        lambda x: landing.row_count_check(x.spark.read.parquet(f"{x.folder}/orders.parquet"), x.raw)),
    # Bronze
    "bronze_transactions": _over(lambda x: x.whole_bronze),
    "bronze_dedup": _over(lambda x: x.bronze.select("txn_id", "txn_timestamp", "txn_amount_usd", "account_id")),
    "bronze_delinquency": _over(
        lambda x: x.bronze.select("txn_id", "target_credit_default", "delinquency_status")),
    "bronze_quarantine": _over(lambda x: x.quarantine),
    "bronze_split_counts": _over(lambda x: bronze.split_counts(x.judged)),
    # Silver
    "silver_loan_accounts": _over(lambda x: x.whole_silver),
    "silver_fx_join": _over(lambda x: silver.fx_join(x.bronze, x.fx)),
    "silver_loan_status": _over(
        lambda x: x.silver.select("txn_id", "delinquency_status", "target_credit_default", "loan_status")),
    "silver_provision": _over(
        lambda x: x.silver.select("txn_id", "orig_balance_thb", "provision_rate", "provision_amount_thb")),
    "silver_unmatched_fx": _over(lambda x: silver.unmatched(x.bronze, x.fx).select(
        "txn_id", "txn_month", "txn_currency", "orig_balance_after")),
    "silver_status_distribution": _over(lambda x: silver.status_distribution(x.silver)),
    "silver_provision_summary": _over(lambda x: silver.provision_summary(x.silver)),
    "silver_npl_accounts": _over(lambda x: silver.npl_accounts(x.silver)),
    "silver_monthly_totals": _over(lambda x: silver.monthly_totals(x.silver)),
    # Gold
    "gold_monthly_report": _over(lambda x: x.gold.orderBy("report_month")),
    "gold_kpi_listing": _over(lambda x: gold.listing(x.gold)),
    "gold_period_totals": _over(lambda x: gold.totals(x.gold)),
    # Quality checks
    "dq_null_check": _silver_check(quality.NULL_CHECK),
    "dq_duplicate_txn": _over(lambda x: quality.duplicate_check(x.silver)),
    "dq_fx_rate_positive": _silver_check(quality.FX_POSITIVE),
    "dq_balance_positive": _silver_check(quality.BALANCE_POSITIVE),
    "dq_loan_status_valid": _silver_check(quality.STATUS_VALID),
    "dq_default_provision_rate": _silver_check(quality.DEFAULT_RATE),
    "dq_default_loan_status": _silver_check(quality.DEFAULT_STATUS),
    "dq_npl_ratio_range": _gold_check(quality.RATIO_RANGE),
    "dq_provision_vs_balance": _gold_check(quality.PROVISION_LIMIT),
    "dq_monthly_completeness": _over(lambda x: quality.completeness_check(x.gold, CHECKED_YEAR)),
    "dq_results": _over(lambda x: quality.checks(x.silver, None, CHECKED_YEAR)),
    # Constraints of the tables
    "constraints_bronze": _over(lambda x: constraints.report(x.bronze, constraints.CONSTRAINTS[tables.BRONZE])),
    "constraints_silver": _over(lambda x: constraints.report(x.silver, constraints.CONSTRAINTS[tables.SILVER])),
    "constraints_silver_spoilt": _over(
        lambda x: constraints.report(given.spoilt_silver(x.silver), constraints.CONSTRAINTS[tables.SILVER])),
    "constraints_gold": _over(lambda x: constraints.report(x.gold, constraints.CONSTRAINTS[tables.GOLD])),
    "constraints_run_log": _over(lambda x: constraints.report(x.runs, constraints.CONSTRAINTS[tables.RUN_LOG])),
    # Reconciliation
    "recon_count_bronze_silver": _reconciled(reconcile.BRONZE_SILVER),
    "recon_count_silver_gold": _reconciled(reconcile.SILVER_GOLD),
    "recon_balance": _reconciled(reconcile.BALANCE),
    "recon_provision": _reconciled(reconcile.PROVISION),
    "recon_npl_count": _reconciled(reconcile.NPL_COUNT),
    "recon_results": _reconciled(),
    # The same over layers spoilt on purpose: every check fails
    "dq_results_spoilt": _over(lambda x: quality.checks(given.spoilt_silver(x.silver), given.spoilt_gold(x.gold), CHECKED_YEAR)),
    "recon_results_spoilt": _over(
        lambda x: reconcile.checks(x.bronze, given.spoilt_silver(x.silver), given.spoilt_gold(x.gold))),
    # Reports
    "report_credit_risk_summary": _over(lambda x: reports.credit_risk_summary(x.gold)),
    "report_npl_monthly": _over(lambda x: reports.npl_breakdown(x.silver, "txn_month")),
    "report_npl_by_region": _over(lambda x: reports.npl_breakdown(x.silver, "primary_branch_region")),
    "report_npl_by_account_type": _over(lambda x: reports.npl_breakdown(x.silver, "account_type")),
    "report_provision_monthly": _over(lambda x: reports.provision_monthly(x.silver)),
    "report_provision_by_delinquency": _over(lambda x: reports.provision_by_delinquency(x.silver)),
    "report_sums": _over(lambda x: reports.sums(x.silver)),
    "report_preview": _over(lambda x: reports.preview(reports.credit_risk_summary(x.gold))),
    # Diagnostics
    "diag_recent_runs": _over(lambda x: diagnostics.recent_runs(x.runs)),
    "diag_failed_steps": _over(lambda x: diagnostics.failed_steps(x.runs)),
    "diag_recent_failures": _over(lambda x: diagnostics.failed_steps(x.runs, 5)),
    "diag_step_durations": _over(lambda x: diagnostics.step_durations(x.runs)),
    "diag_raw_profile": _over(lambda x: diagnostics.raw_profile(x.raw)),
    "diag_fx_coverage": _over(lambda x: diagnostics.fx_coverage(x.fx)),
    "diag_bronze_counts": _over(lambda x: diagnostics.bronze_counts_of(bronze.split_counts(x.judged))),
    "diag_recent_quarantine": _over(lambda x: diagnostics.recent_quarantine(x.quarantine)),
    "diag_delinquency_distribution": _over(lambda x: diagnostics.delinquency_distribution(x.bronze)),
    "diag_silver_nulls": _over(lambda x: diagnostics.silver_nulls(x.silver)),
    "diag_status_totals": _over(lambda x: diagnostics.status_totals(x.silver)),
    "diag_fx_used": _over(lambda x: diagnostics.fx_used(x.silver)),
    "diag_quick_recon": _over(lambda x: diagnostics.quick_recon(x.silver)),
    "diag_quarantine_reasons": _over(lambda x: diagnostics.quarantine_reasons(x.quarantine)),
    "diag_layer_counts": _over(lambda x: diagnostics.layer_counts(x.bronze, x.silver)),
    "diag_rate_by_delinquency": _over(lambda x: diagnostics.rate_by_delinquency(x.silver)),
    "diag_default_audit": _over(lambda x: diagnostics.default_audit(x.silver)),
    # Run log
    "runlog_current": _over(lambda x: x.runs),
    "runlog_recent": _over(lambda x: runlog.recent(x.runs, given.RUN_LOG_AS_OF)),
    # Documented rules
    "rule_npl_alert": _over(lambda x: rules.npl_alert(x.gold)),
    "rule_fx_complete": _over(lambda x: rules.missing_rates(x.bronze, x.fx)),
    "rule_month_end_snapshot": _over(lambda x: rules.month_end(x.silver.select(
        "account_id", "txn_month", "txn_id", "txn_timestamp", "orig_balance_thb", "loan_status"), stored=False)),
    "rule_npl_anomaly": _over(lambda x: rules.npl_anomaly(x.gold)),
    "rule_npl_anomaly_critical": _over(lambda x: rules.npl_anomaly(x.gold, rules.CRITICAL_ABOVE)),
}
