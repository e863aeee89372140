"""Silver to Gold: one KPI row per month. "Accounts" counts transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.amounts import count_rows, percent_of, total, total_where
from riskmart.spec import MONEY_SUM, NPL, PERFORMING, UNDER_PERFORMING

STATUS_PREFIXES = {"performing": PERFORMING, "under_performing": UNDER_PERFORMING, "npl": NPL}
COLUMNS = ["report_month", "total_accounts", "outstanding_balance_thb", "npl_accounts", "npl_ratio_pct",
           "total_provision_thb", "performing_accounts", "performing_balance_thb", "performing_provision_thb",
           "under_performing_accounts", "under_performing_balance_thb", "under_performing_provision_thb",
           "npl_balance_thb", "npl_provision_thb"]


def facts(silver: DataFrame, counted: dict[str, str] | None = None) -> DataFrame:
    """Gold and, per month, how many Silver rows meet each of the named conditions: all that checks ask of Silver's
    rows, in one pass. Rows of unknown status count in the totals only.

    Sums are partial per task before the shuffle, so a month that holds most rows costs no more than another.
    """
    counted = counted or {}
    aggregates = [count_rows().alias("total_accounts"),
                  total("orig_balance_thb").alias("outstanding_balance_thb"),
                  total("provision_amount_thb").alias("total_provision_thb")]
    for prefix, status in STATUS_PREFIXES.items():
        of_status = F.col("loan_status") == status
        aggregates += [F.count_if(of_status).alias(f"{prefix}_accounts"),
                       total_where(of_status, "orig_balance_thb").alias(f"{prefix}_balance_thb"),
                       total_where(of_status, "provision_amount_thb").alias(f"{prefix}_provision_thb")]
    aggregates += [F.count_if(F.expr(condition)).alias(name) for name, condition in counted.items()]
    return (silver.groupBy(F.col("txn_month").alias("report_month")).agg(*aggregates)
            .withColumn("npl_ratio_pct", percent_of("npl_accounts", "total_accounts"))
            .select(*COLUMNS, *counted))


def monthly(silver: DataFrame) -> DataFrame:
    """KPIs per month in one aggregation."""
    return facts(silver)


def listing(gold: DataFrame) -> DataFrame:
    return gold.select("report_month", "total_accounts", "outstanding_balance_thb", "npl_accounts", "npl_ratio_pct",
                       "total_provision_thb").orderBy(F.asc_nulls_last("report_month"))


def totals(gold: DataFrame) -> DataFrame:
    """Whole-period totals; the ratio comes from the sums, it is no mean of monthly ratios."""
    def amount(c):
        return F.sum(c).cast(MONEY_SUM)
    return (gold.agg(F.sum("total_accounts").alias("total_accounts"),
                     amount("outstanding_balance_thb").alias("total_balance"),
                     F.sum("npl_accounts").alias("total_npl"),
                     amount("total_provision_thb").alias("total_provision"))
            .withColumn("avg_npl_ratio", percent_of("total_npl", "total_accounts")))
