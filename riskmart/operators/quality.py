"""Ten quality checks on Silver and Gold, as rows (check_name, layer, status, failed_count, detail), and the gate.

The row checks of both layers come from one monthly aggregate of Silver, and of the stored Gold table where there is
one; only the key check needs a pass and a shuffle of its own, of the key column alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.amounts import count_rows
from riskmart.functions.convert import text_list
from riskmart.operators import gold as gold_layer
from riskmart.spec import DEFAULT_PROVISION_RATE, KEY, NPL, PERFORMING, UNDER_PERFORMING

SILVER, GOLD = "silver", "gold"
NULL_CHECK = "silver_null_check"
DUPLICATE = "silver_duplicate_txn"
FX_POSITIVE = "silver_fx_rate_positive"
BALANCE_POSITIVE = "silver_balance_positive"
STATUS_VALID = "silver_loan_status_valid"
DEFAULT_RATE = "silver_default_provision_rate"
DEFAULT_STATUS = "silver_default_loan_status"
RATIO_RANGE = "gold_npl_ratio_range"
PROVISION_LIMIT = "gold_provision_not_exceed_balance"
COMPLETENESS = "gold_monthly_completeness"

# A row fails a check where its condition is true; NULL does not fail unless the condition says so.
FAILS = {
    NULL_CHECK: " or ".join(f"{c} is null" for c in (
        "cust_id", "txn_id", "orig_balance_thb", "loan_status", "provision_amount_thb")),
    FX_POSITIVE: "fx_rate_to_thb <= 0 or fx_rate_to_thb is null",
    BALANCE_POSITIVE: "orig_balance_thb <= 0",
    STATUS_VALID: f"loan_status not in ({text_list([PERFORMING, UNDER_PERFORMING, NPL])})",
    DEFAULT_RATE: f"target_credit_default and provision_rate <> {DEFAULT_PROVISION_RATE}",
    DEFAULT_STATUS: f"target_credit_default and loan_status <> '{NPL}'",
    RATIO_RANGE: "npl_ratio_pct < 0 or npl_ratio_pct > 100",
    PROVISION_LIMIT: "total_provision_thb > outstanding_balance_thb",
}

# The text shown with each check.
DETAILS = {
    NULL_CHECK: "NULL ใน column: cust_id, txn_id, orig_balance_thb, loan_status, provision_amount_thb",
    DUPLICATE: "txn_id ที่ซ้ำกันมากกว่า 1 แถว",
    FX_POSITIVE: "fx_rate_to_thb ต้องมากกว่า 0 เสมอ",
    BALANCE_POSITIVE: "orig_balance_thb ต้องมากกว่า 0",
    STATUS_VALID: "loan_status ต้องเป็น Performing, Under-Performing, หรือ NPL เท่านั้น",
    DEFAULT_RATE: "ลูกค้าที่ Default=True ต้องมี provision_rate = 1.00 เสมอ ไม่ว่า Delinquency จะเป็นอะไร",
    DEFAULT_STATUS: "ลูกค้าที่ Default=True ต้องมี loan_status = NPL เสมอ",
    RATIO_RANGE: "npl_ratio_pct ต้องอยู่ระหว่าง 0 ถึง 100",
    PROVISION_LIMIT: "total_provision_thb ต้องไม่เกิน outstanding_balance_thb",
}
COMPLETENESS_DETAIL = ("มีข้อมูล ", " เดือน (ต้องการ ", " เดือน)")

RESULT_COLUMNS = ["check_name", "layer", "status", "failed_count", "detail"]


def row_checks(layer: DataFrame, layer_name: str, names: list[str]) -> DataFrame:
    """The named row checks of one layer in a single pass."""
    return _listed(layer.agg(*[F.count_if(F.expr(FAILS[n])).alias(n) for n in names]), names).where(
        F.col("layer") == layer_name)


def _listed(counts: DataFrame, names: list[str]) -> DataFrame:
    """One row per check of a row of failure counts."""
    rows = ", ".join(f"named_struct('check_name', '{n}', 'layer', '{n.split('_')[0]}', 'failed_count', {n}, "
                     f"'detail', '{DETAILS[n]}')" for n in names)
    return counts.selectExpr(f"inline(array({rows}))").select("check_name", "layer", _status(), "failed_count", "detail")


def duplicate_check(silver: DataFrame) -> DataFrame:
    """Counts repeated keys, not rows; missing keys count as one key."""
    repeated = silver.groupBy(KEY).agg(count_rows().alias("rows")).where("rows > 1")
    return repeated.agg(count_rows().alias("failed_count")).select(
        F.lit(DUPLICATE).alias("check_name"), F.lit(SILVER).alias("layer"), _status(), "failed_count",
        F.lit(DETAILS[DUPLICATE]).alias("detail"))


def completeness_check(gold: DataFrame, year: int, months: int = 12) -> DataFrame:
    """Fails unless the year has the expected number of months; the count is what is missing."""
    return _completeness(gold.agg(_months_of(year)), months)


def _months_of(year: int):
    return F.count_if(F.col("report_month").startswith(f"{year:04d}-")).alias("found")


def _completeness(found: DataFrame, months: int) -> DataFrame:
    start, middle, end = COMPLETENESS_DETAIL
    detail = F.concat(F.lit(start), F.col("found").cast("string"), F.lit(f"{middle}{months}{end}"))
    return (found.select((F.lit(months).cast("long") - F.col("found")).alias("failed_count"), detail.alias("detail"))
            .select(F.lit(COMPLETENESS).alias("check_name"), F.lit(GOLD).alias("layer"), _status(),
                    "failed_count", "detail"))


def _status():
    return F.when(F.col("failed_count") == 0, "PASS").otherwise("FAIL").alias("status")


SILVER_FAILS = {n: condition for n, condition in FAILS.items() if n.startswith(SILVER)}


def checks(silver: DataFrame, gold: DataFrame | None, year: int, months: int = 12) -> DataFrame:
    """All ten checks, ordered by layer and name; `gold` is the stored table, or None: Gold is then what Silver gives."""
    facts = gold_layer.facts(silver, SILVER_FAILS)
    of_silver = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in SILVER_FAILS]
    gold_names = [n for n in FAILS if n.startswith(GOLD)]
    of_gold = [*(F.count_if(F.expr(FAILS[n])).alias(n) for n in gold_names), _months_of(year)]
    if gold is None:
        counts = facts.agg(*of_silver, *of_gold)
    else:
        one_row = facts.agg(*of_silver).unionByName(gold.agg(*of_gold), allowMissingColumns=True)
        counts = one_row.agg(*[F.max(c).alias(c) for c in one_row.columns])
    # One plan node gives the rows of all nine checks, so that the aggregate is computed once.
    start, middle, end = COMPLETENESS_DETAIL
    complete = (f"named_struct('check_name', '{COMPLETENESS}', 'layer', '{GOLD}', 'failed_count', {months}L - found, "
                f"'detail', concat('{start}', cast(found as string), '{middle}{months}{end}'))")
    rows = ", ".join(f"named_struct('check_name', '{n}', 'layer', '{n.split('_')[0]}', 'failed_count', {n}, "
                     f"'detail', '{DETAILS[n]}')" for n in FAILS)
    parts = [counts.selectExpr(f"inline(array({rows}, {complete}))").withColumn("status", _status()), duplicate_check(silver)]
    return reduce(DataFrame.unionByName, parts).select(*RESULT_COLUMNS).orderBy("layer", "check_name")


class ChecksFailed(RuntimeError):
    """At least one check of a result table failed."""


def gate(results: DataFrame) -> list[str]:
    """Names of all checks when every one passed; otherwise an error that lists each failure.

    `results` is a check table of at most ten rows.
    """
    rows = results.collect()
    failed = [r.asDict() for r in rows if r["status"] != "PASS"]
    if failed:
        raise ChecksFailed("; ".join(
            f"{r['check_name']}: {r.get('failed_count', r.get('difference'))} ({r['detail']})" for r in failed))
    return [r["check_name"] for r in rows]
