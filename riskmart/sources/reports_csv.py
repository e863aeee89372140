"""Report files: one UTF-8 CSV with byte-order mark per report, named by report and time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Report file names and the header shown for each column.
CREDIT_RISK_SUMMARY = "1_credit_risk_summary"
NPL_MONTHLY = "2_npl_monthly"
NPL_BY_REGION = "2_npl_by_region"
NPL_BY_ACCOUNT_TYPE = "2_npl_by_account_type"
PROVISION_MONTHLY = "3_provision_monthly"
PROVISION_BY_DELINQUENCY = "3_provision_by_delinquency"

_NPL_LABELS = {
    "npl_accounts": "NPL Accounts",
    "total_accounts": "Total Accounts",
    "npl_ratio_pct": "NPL Ratio (%)",
    "npl_balance_thb": "NPL Balance (THB)",
}
LABELS = {
    CREDIT_RISK_SUMMARY: {
        "report_month": "เดือน",
        "total_accounts": "จำนวนบัญชีทั้งหมด",
        "outstanding_balance_thb": "ยอดหนี้รวม (THB)",
        "npl_accounts": "จำนวนบัญชี NPL",
        "npl_ratio_pct": "NPL Ratio (%)",
        "total_provision_thb": "เงินสำรองรวม (THB)",
        "provision_coverage_pct": "Provision Coverage (%)",
    },
    NPL_MONTHLY: {"txn_month": "เดือน", **_NPL_LABELS},
    NPL_BY_REGION: {"primary_branch_region": "Region", **_NPL_LABELS},
    NPL_BY_ACCOUNT_TYPE: {"account_type": "Account Type", **_NPL_LABELS},
    PROVISION_MONTHLY: {
        "txn_month": "เดือน",
        "performing_provision_thb": "Provision - Performing (THB)",
        "under_performing_provision_thb": "Provision - Under-Performing (THB)",
        "npl_provision_thb": "Provision - NPL (THB)",
        "total_provision_thb": "Provision รวม (THB)",
    },
    PROVISION_BY_DELINQUENCY: {
        "delinquency_status": "Delinquency",
        "loan_status": "Loan Status",
        "provision_rate_pct": "Provision Rate (%)",
        "total_accounts": "จำนวนบัญชี",
        "total_balance_thb": "ยอดหนี้รวม (THB)",
        "total_provision_thb": "เงินสำรองรวม (THB)",
    },
}
BOM = "\ufeff"
_PLACE = "_place"


def export(report: DataFrame, folder: str, name: str, stamp: str) -> str:
    """Write a report in its own order and give the path of its file.

    Reports are aggregates with a row per month or code, so one task writes the file.
    """
    spark = report.sparkSession
    labelled = [F.col(c).alias(LABELS[name].get(c, c)) for c in report.columns]
    first, *others = labelled
    first = F.col(report.columns[0]).alias(BOM + LABELS[name].get(report.columns[0], report.columns[0]))
    target, parts = f"{folder.rstrip('/')}/{name}_{stamp}.csv", f"{folder.rstrip('/')}/_{name}_{stamp}"
    # Position in the report's order, then one task that sorts by it: gathering sorted partitions need not keep order.
    ordered = report.select(first, *others).withColumn(_PLACE, F.monotonically_increasing_id())
    (ordered.repartition(1).sortWithinPartitions(_PLACE).drop(_PLACE).write.mode("overwrite")
     .options(header=True, quote='"', escape='"', emptyValue="").csv(parts))

    hadoop = spark._jvm.org.apache.hadoop.fs
    system = hadoop.Path(parts).getFileSystem(spark._jsc.hadoopConfiguration())
    written = next(s.getPath() for s in system.listStatus(hadoop.Path(parts)) if s.getPath().getName().endswith(".csv"))
    if not system.rename(written, hadoop.Path(target)):
        raise OSError(f"{target} could not be written")
    system.delete(hadoop.Path(parts), True)
    return target
