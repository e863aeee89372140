"""Six reports over Gold and Silver. Results are small: one row per month or per code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.functions.amounts import count_rows, percent_of, percent_of_money, total, total_where
from riskmart.operators.gold import STATUS_PREFIXES
from riskmart.spec import NPL


def credit_risk_summary(gold: DataFrame) -> DataFrame:
    """Monthly KPIs with the provision coverage."""
    return (gold.select("report_month", "total_accounts", "outstanding_balance_thb", "npl_accounts", "npl_ratio_pct",
                        "total_provision_thb")
            .withColumn("provision_coverage_pct",
                        percent_of_money("total_provision_thb", "outstanding_balance_thb").cast("decimal(12,4)"))
            .orderBy(F.asc_nulls_last("report_month")))


DELINQUENCY = ["delinquency_status", "loan_status", "provision_rate"]
NPL_DIMENSIONS = ["txn_month", "primary_branch_region", "account_type"]


def _npl_sums(status: str = "loan_status") -> list[Column]:
    npl = F.col(status) == NPL
    return [F.count_if(npl).alias("npl_accounts"), count_rows().alias("total_accounts"),
            total_where(npl, "orig_balance_thb").alias("npl_balance_thb")]


def _status_provisions(status: str = "loan_status") -> list[Column]:
    return [total_where(F.col(status) == value, "provision_amount_thb").alias(f"{prefix}_provision_thb")
            for prefix, value in STATUS_PREFIXES.items()]


def _npl_shown(sums: DataFrame, dimension: str) -> DataFrame:
    result = sums.withColumn("npl_ratio_pct", percent_of("npl_accounts", "total_accounts")).select(
        dimension, "npl_accounts", "total_accounts", "npl_ratio_pct", "npl_balance_thb")
    if dimension == "txn_month":
        return result.orderBy(F.asc_nulls_last(dimension))
    return result.orderBy(F.desc_nulls_first("npl_ratio_pct"), F.asc_nulls_last(dimension))


def _monthly_shown(sums: DataFrame) -> DataFrame:
    provisions = [f"{prefix}_provision_thb" for prefix in STATUS_PREFIXES]
    return sums.select("txn_month", *provisions, "total_provision_thb").orderBy(F.asc_nulls_last("txn_month"))


def _delinquency_shown(sums: DataFrame) -> DataFrame:
    return (sums.orderBy(F.asc_nulls_last("provision_rate"), F.asc_nulls_last("delinquency_status"))
            .select("delinquency_status", "loan_status",
                    F.round(F.col("provision_rate") * 100, 0).cast("decimal(5,0)").alias("provision_rate_pct"),
                    "total_accounts", "total_balance_thb", "total_provision_thb"))


def npl_breakdown(silver: DataFrame, dimension: str) -> DataFrame:
    """NPL count, ratio and balance by one column: by month in time order, else the worst ratio first."""
    return _npl_shown(silver.groupBy(dimension).agg(*_npl_sums()), dimension)


def provision_monthly(silver: DataFrame) -> DataFrame:
    """Provision by month, one column per loan status, and the total."""
    return _monthly_shown(silver.groupBy("txn_month").agg(
        *_status_provisions(), total("provision_amount_thb").alias("total_provision_thb")))


def provision_by_delinquency(silver: DataFrame) -> DataFrame:
    """Count, balance and provision by code, status and rate."""
    return _delinquency_shown(silver.groupBy(*DELINQUENCY).agg(
        count_rows().alias("total_accounts"), total("orig_balance_thb").alias("total_balance_thb"),
        total("provision_amount_thb").alias("total_provision_thb")))


def sums(silver: DataFrame) -> DataFrame:
    """The sums of all reports over Silver from one pass: a row per month, region, account type and code, with `report`
    naming which of the four it is. A few hundred rows."""
    sets = [[d] for d in NPL_DIMENSIONS] + [DELINQUENCY]
    columns = [*NPL_DIMENSIONS, *DELINQUENCY]
    # Each bit of the grouping id is 1 where a column is not in the set; the first column has the highest bit.
    ids = [sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in s) for s in sets]
    names = F.create_map(*(F.lit(x) for i, s in zip(ids, sets) for x in (i, s[0])))
    # The statuses are counted under a name of their own: as a grouping column `loan_status` is null in other sets.
    rows = silver.select(*columns, "orig_balance_thb", "provision_amount_thb", F.col("loan_status").alias("_status"))
    grouped = rows.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(
        F.grouping_id().alias("_id"), *_npl_sums("_status"), *_status_provisions("_status"),
        total("orig_balance_thb").alias("total_balance_thb"), total("provision_amount_thb").alias("total_provision_thb"))
    return grouped.withColumn("report", names[F.col("_id").cast("int")]).drop("_id")


def npl_breakdown_of(found: DataFrame, dimension: str) -> DataFrame:
    """`npl_breakdown` from `sums`."""
    return _npl_shown(found.where(F.col("report") == dimension), dimension)


def provision_monthly_of(found: DataFrame) -> DataFrame:
    return _monthly_shown(found.where("report = 'txn_month'"))


def provision_by_delinquency_of(found: DataFrame) -> DataFrame:
    return _delinquency_shown(found.where(F.col("report") == DELINQUENCY[0]))


def preview(report: DataFrame, rows: int = 5) -> DataFrame:
    """First rows of a report in its own order."""
    return report.limit(rows)
