"""Business rules that the documents state and the run does not apply by itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.amounts import count_rows
from riskmart.operators import firsts
from riskmart.operators import silver as silver_layer

# NPL ratio limits in percent.
WATCH_FROM, CRITICAL_ABOVE, ANOMALY_ABOVE = 3, 5, 20


def npl_alert(gold: DataFrame) -> DataFrame:
    """Alert level per month: below 3 normal, 3 to 5 watch, above 5 critical."""
    ratio = F.col("npl_ratio_pct")
    level = F.when(ratio < WATCH_FROM, "normal").when(ratio <= CRITICAL_ABOVE, "watch").when(
        ratio > CRITICAL_ABOVE, "critical")
    return gold.select("report_month", "npl_ratio_pct", level.alias("alert_level")).orderBy(F.asc_nulls_last("report_month"))


def npl_anomaly(gold: DataFrame, above: int = ANOMALY_ABOVE) -> DataFrame:
    return (gold.where(F.col("npl_ratio_pct") > above)
            .select("report_month", "total_accounts", "npl_accounts", "npl_ratio_pct").orderBy(F.asc_nulls_last("report_month")))


def missing_rates(bronze: DataFrame, fx: DataFrame) -> DataFrame:
    """Month and currency pairs that have debt but no rate, with their row count."""
    return (silver_layer.unmatched(bronze, fx).groupBy(*silver_layer.JOIN_KEYS)
            .agg(count_rows().alias("row_count")).orderBy(*map(F.asc_nulls_last, silver_layer.JOIN_KEYS)))


class MissingRate(RuntimeError):
    """Rows with debt have no exchange rate."""


def require_rates(bronze: DataFrame, fx: DataFrame) -> None:
    """Error that names all missing pairs, which are bounded by months and currencies; to be called before conversion."""
    missing = missing_rates(bronze, fx).collect()
    if missing:
        raise MissingRate(", ".join(f"{r['txn_month']} {r['txn_currency']}: {r['row_count']}" for r in missing))


def month_end(silver: DataFrame, stored: bool = True) -> DataFrame:
    """Last transaction per account and month.

    Of a stored Silver only accounts with several transactions in a month are shuffled. `stored=False` is for rows that
    are computed as they are read: they are read once and shuffled, at most one per account, month and task.
    """
    plan = firsts.first_rows if stored else firsts.by_window
    return plan(silver, ["account_id", "txn_month"], [F.desc("txn_timestamp"), F.desc("txn_id")])
