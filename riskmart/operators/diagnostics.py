"""Questions asked when a run fails or a figure looks wrong. Lists with a row limit are the newest entries of a log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.amounts import count_rows, total
from riskmart.operators import gold as gold_layer
from riskmart.spec import MONEY_SUM


def recent_runs(runs: DataFrame, rows: int = 10) -> DataFrame:
    return (runs.orderBy(F.desc("run_id")).limit(rows)
            .select("run_id", "pipeline_name", "step_name", "status", "started_at", "finished_at", "duration_sec",
                    "rows_processed", "error_message"))


def failed_steps(runs: DataFrame, rows: int | None = None) -> DataFrame:
    """Failed steps, newest first; all of them unless a number of rows is given."""
    failed = runs.where(F.col("status") == "FAILED").orderBy(F.desc("run_id"))
    return (failed.limit(rows) if rows else failed).select("run_id", "step_name", "started_at", "error_message")


def step_durations(runs: DataFrame) -> DataFrame:
    """Run count and mean, longest and shortest duration of successful steps, slowest first."""
    mean = F.sum("duration_sec").cast("decimal(30,6)") / F.nullif(F.count("duration_sec"), F.lit(0))
    return (runs.where(F.col("status") == "SUCCESS").groupBy("step_name")
            .agg(count_rows().alias("total_runs"), F.round(mean, 2).cast("decimal(10,2)").alias("avg_duration_sec"),
                 F.max("duration_sec").alias("max_duration_sec"), F.min("duration_sec").alias("min_duration_sec"))
            .orderBy(F.desc_nulls_first("avg_duration_sec"), "step_name"))


def raw_profile(raw: DataFrame) -> DataFrame:
    """Row count, distinct keys and load times.

    Load times are aggregated per value first, and each key has an aggregate of its own: all hash on one column, where
    distinct counts and text extremes in one aggregate would multiply and sort the rows.
    """
    loads = raw.groupBy("_loaded_at").agg(count_rows().alias("rows")).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"), F.min("_loaded_at").alias("first_loaded"),
        F.max("_loaded_at").alias("last_loaded"))
    keys = [raw.groupBy(key).agg(count_rows().alias("rows")).agg(F.count(key).alias(name))
            for key, name in (("cust_id", "unique_customers"), ("txn_id", "unique_transactions"))]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [loads, *keys])
    return rows.agg(*[F.max(c).alias(c) for c in ("total_rows", "unique_customers", "unique_transactions", "first_loaded",
                                                  "last_loaded")])


def fx_coverage(fx: DataFrame) -> DataFrame:
    """Currencies per month, counted and listed. The list holds one entry per rate row of the month, sorted.

    Rows are first counted per month and currency, so what is collected per month is one entry per currency.
    """
    per_currency = fx.groupBy("rate_month", "currency_code").agg(count_rows().cast("int").alias("rows"))
    entries = F.expr("flatten(transform(array_sort(collect_list(struct(currency_code, rows))), "
                     "e -> array_repeat(e.currency_code, e.rows)))")
    return (per_currency.groupBy("rate_month")
            .agg(F.count("currency_code").alias("currency_count"), F.array_join(entries, ", ").alias("currencies"))
            .orderBy(F.asc_nulls_last("rate_month")))


def bronze_counts_of(split: DataFrame) -> DataFrame:
    """Rows of Bronze and of the quarantine, from the counts of one judging pass."""
    return split.selectExpr(
        "inline(array(named_struct('table_name', 'bronze.financial_transactions', 'row_count', bronze_rows), "
        "named_struct('table_name', 'bronze.quarantine_log', 'row_count', quarantined_rows)))")


def recent_quarantine(quarantined: DataFrame, rows: int = 20) -> DataFrame:
    return (quarantined.orderBy(F.desc("quarantined_at"), "quarantine_id").limit(rows)
            .select("cust_id", "txn_id", "failed_column", "failed_value", "failure_reason", "quarantined_at"))


def delinquency_distribution(bronze: DataFrame) -> DataFrame:
    return (bronze.groupBy("delinquency_status").agg(count_rows().alias("row_count"))
            .orderBy(F.asc_nulls_last("delinquency_status")))


def silver_nulls(silver: DataFrame) -> DataFrame:
    columns = {"null_cust_id": "cust_id", "null_balance": "orig_balance_thb", "null_loan_status": "loan_status",
               "null_provision": "provision_amount_thb", "null_fx_rate": "fx_rate_to_thb"}
    return silver.agg(count_rows().alias("total_rows"),
                      *[F.count_if(F.col(c).isNull()).alias(name) for name, c in columns.items()])


def status_totals(silver: DataFrame) -> DataFrame:
    return (silver.groupBy("loan_status")
            .agg(count_rows().alias("accounts"), total("orig_balance_thb").alias("total_balance_thb"),
                 total("provision_amount_thb").alias("total_provision_thb"))
            .orderBy(F.asc_nulls_last("loan_status")))


def fx_used(silver: DataFrame) -> DataFrame:
    return (silver.groupBy("txn_currency", "txn_month", "fx_rate_to_thb")
            .agg(count_rows().alias("transaction_count")).orderBy(*map(F.asc_nulls_last, ("txn_month", "txn_currency", "fx_rate_to_thb"))))


def quick_recon(silver: DataFrame, gold: DataFrame | None = None) -> DataFrame:
    """Four figures as text: row counts and balances of Silver and Gold. A balance without rows is NULL, a count 0.

    Without a stored Gold table both come from one monthly aggregate of Silver.
    """
    def figures(layer, aggregates):
        one_row = layer.agg(*[F.expr(sql).cast("string").alias(name) for name, sql in aggregates.items()])
        rows = ", ".join(f"named_struct('metric', '{name}', 'value', {name})" for name in aggregates)
        return one_row.selectExpr(f"inline(array({rows}))")
    def of(prefix, balance):
        return {f"{prefix}_accounts": "coalesce(sum(total_accounts), 0)",
                balance: f"cast(sum(outstanding_balance_thb) as {MONEY_SUM})"}
    facts = gold_layer.monthly(silver)
    of_silver, of_gold = of("silver_total", "silver_total_balance_thb"), of("gold_sum_total", "gold_sum_outstanding_balance_thb")
    if gold is None:
        return figures(facts, of_silver | of_gold)
    return figures(facts, of_silver).unionByName(figures(gold, of_gold))


def quarantine_reasons(quarantined: DataFrame) -> DataFrame:
    return (quarantined.groupBy("failed_column", "failure_reason").agg(count_rows().alias("row_count"))
            .orderBy(F.desc("row_count"), "failed_column", "failure_reason"))


def layer_counts(bronze: DataFrame, silver: DataFrame, gold: DataFrame | None = None) -> DataFrame:
    """Rows with debt in Bronze, rows in Silver and accounts in Gold, side by side."""
    def accounts(name):
        return F.coalesce(F.sum("total_accounts"), F.lit(0)).alias(name)
    facts = gold_layer.monthly(silver)
    counts = [bronze.agg(F.count_if(F.col("orig_balance_after") > 0).alias("bronze_count"))]
    counts += [facts.agg(accounts("silver_count"), accounts("gold_count"))] if gold is None else [
        facts.agg(accounts("silver_count")), gold.agg(accounts("gold_count"))]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), counts)
    return rows.agg(*[F.max(c).alias(c) for c in ("bronze_count", "silver_count", "gold_count")])


def rate_by_delinquency(silver: DataFrame) -> DataFrame:
    return (silver.groupBy("delinquency_status", "provision_rate").agg(count_rows().alias("row_count"))
            .orderBy(F.asc_nulls_last("delinquency_status"), F.asc_nulls_last("provision_rate")))


def default_audit(silver: DataFrame) -> DataFrame:
    """Rows in default by code, rate and status; every one should show rate 1 and NPL."""
    return (silver.where("target_credit_default")
            .groupBy("delinquency_status", "target_credit_default", "provision_rate", "loan_status")
            .agg(count_rows().alias("row_count"))
            .orderBy(F.asc_nulls_last("delinquency_status"), F.asc_nulls_last("provision_rate")))
