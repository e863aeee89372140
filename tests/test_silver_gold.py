from __future__ import annotations

from datetime import datetime
from decimal import Decimal as D

import pytest

from riskmart.operators import bronze, gold, reports, rules, silver

FX = [("2024-01", "USD", "35.25"), ("2024-01", "EUR", "38.10"), ("2024-01", "Local", "1"),
      ("2024-01", "X", "1.4870"), ("2024-01", "Y", "35.25123456")]


@pytest.fixture
def fx(spark):
    return spark.createDataFrame(FX, "rate_month string, currency_code string, rate_to_thb string")


@pytest.fixture
def bronze_rows(raw_rows):
    return lambda *changes: bronze.good(bronze.judge(raw_rows(*changes)))


@pytest.mark.parametrize(("balance", "currency", "change", "expected"), [
    ("1000", "USD", {}, ("35250.00", "Performing", "0.0100", "352.50")),
    ("500", "EUR", {"delinquency_status": "30_Days_Past_Due"}, ("19050.00", "Under-Performing", "0.0200", "381.00")),
    ("50000", "Local", {"delinquency_status": "60_Days_Past_Due"},
     ("50000.00", "Under-Performing", "0.1000", "5000.00")),
    ("80000", "Local", {"target_credit_default": "True"}, ("80000.00", "NPL", "1.0000", "80000.00")),
    # Rounded once: 1.487 * 0.5 = 0.7435, not 1.49 * 0.5 = 0.745.
    ("1.00", "X", {"delinquency_status": "90_Plus_Days_Past_Due"}, ("1.49", "Under-Performing", "0.5000", "0.74")),
    ("1000.13", "Y", {}, ("35255.82", "Performing", "0.0100", "352.56")),
])
def test_worked_examples(bronze_rows, fx, balance, currency, change, expected):
    row = silver.build(bronze_rows({"orig_balance_after": balance, "txn_currency": currency} | change), fx).first()
    assert (row.orig_balance_thb, row.loan_status, row.provision_rate, row.provision_amount_thb) == (
        D(expected[0]), expected[1], D(expected[2]), D(expected[3]))
    assert row.txn_month == "2024-01"


def test_amounts_use_the_full_rate_and_storage_the_rounded_one(bronze_rows, fx):
    row = silver.build(bronze_rows({"txn_currency": "Y", "txn_amount_usd": "100000.00"}), fx).first()
    assert row.fx_rate_to_thb == D("35.2512") and row.txn_amount_thb == D("3525123.46")


@pytest.mark.parametrize("balance", ["0", "-5", ""])
def test_rows_without_debt_leave(bronze_rows, fx, balance):
    rows = bronze_rows({"orig_balance_after": balance})
    assert silver.build(rows, fx).count() == 0 and silver.unmatched(rows, fx).count() == 0


def test_rows_without_a_rate_are_named(bronze_rows, fx):
    rows = bronze_rows({"txn_currency": "GBP"}, {"txn_timestamp": "2024-02-01 00:00:00"}, {"txn_timestamp": ""}, {})
    assert [r.txn_id for r in silver.build(rows, fx).collect()] == ["TXN-3"]
    assert sorted(r.txn_id for r in silver.unmatched(rows, fx).collect()) == ["TXN-0", "TXN-1", "TXN-2"]
    with pytest.raises(rules.MissingRate, match="2024-01 GBP: 1"):
        rules.require_rates(rows, fx)
    rules.require_rates(bronze_rows({}), fx)


def test_repeated_rate_fans_out(spark, bronze_rows, fx):
    assert silver.build(bronze_rows({}), fx.unionByName(fx)).count() == 2


def test_status_looks_at_the_code_before_the_flag(spark):
    """Only the lift in Bronze makes a default NPL; a row that escaped it shows in the quality check."""
    rows = spark.createDataFrame(
        [("M0", True), ("M4+", False), ("M9", None), ("M9", True), (None, None)],
        "delinquency_status string, target_credit_default boolean").selectExpr(
        "*", "cast(100 as decimal(14,2)) as orig_balance_after", "cast(1 as decimal(18,8)) as _rate")
    found = [(r.loan_status, r.provision_rate) for r in silver.classify(rows).collect()]
    assert found == [("Performing", D("1.0000")), ("NPL", D("1.0000")), ("Unknown", D("0.0100")), ("NPL", D("1.0000")),
                     ("Unknown", D("0.0100"))]


def stored_silver(spark, rows):
    schema = ("txn_month string, loan_status string, orig_balance_thb decimal(14,2), "
              "provision_amount_thb decimal(14,2), primary_branch_region string")
    return spark.createDataFrame([(m, s, D(b), D(p), r) for m, s, b, p, r in rows], schema)


def test_gold_row(spark):
    rows = stored_silver(spark, [
        ("2024-01", "Performing", "100", "1", "N"), ("2024-01", "NPL", "50", "50", "N"),
        ("2024-01", "Unknown", "10", "0.1", "N"), ("2024-02", "Performing", "7", "0.07", "S")])
    first, second = gold.monthly(rows).orderBy("report_month").collect()
    assert (first.total_accounts, first.outstanding_balance_thb, first.npl_ratio_pct) == (3, D("160.00"), D("33.3333"))
    assert (first.performing_accounts, first.npl_accounts, first.under_performing_accounts) == (1, 1, 0)
    assert first.under_performing_balance_thb is None, "a sum without rows is NULL"
    assert (second.npl_accounts, second.npl_ratio_pct, second.npl_balance_thb) == (0, D("0.0000"), None)
    total = gold.totals(gold.monthly(rows)).first()
    assert (total.total_accounts, total.avg_npl_ratio) == (4, D("25.0000")), "ratio of sums"


def test_breakdown_puts_the_worst_ratio_first(spark):
    rows = stored_silver(spark, [("2024-01", "NPL", "1", "1", "B"), ("2024-01", "Performing", "1", "1", "A"),
                                 ("2024-01", "NPL", "1", "1", None), ("2024-01", "Performing", "1", "1", None)])
    assert [r.primary_branch_region for r in reports.npl_breakdown(rows, "primary_branch_region").collect()] == [
        "B", None, "A"]


def test_npl_limits(spark):
    kpis = spark.createDataFrame([("1", D("2.9999")), ("2", D("3")), ("3", D("5")), ("4", D("5.0001")), ("5", D("21"))],
                                 "report_month string, npl_ratio_pct decimal(8,4)")
    assert [r.alert_level for r in rules.npl_alert(kpis).collect()] == [
        "normal", "watch", "watch", "critical", "critical"]
    wide = kpis.selectExpr("*", "1L as total_accounts", "1L as npl_accounts")
    assert [r.report_month for r in rules.npl_anomaly(wide).collect()] == ["5"]


def test_month_end_keeps_the_last_row_per_account_and_month(spark):
    rows = spark.createDataFrame(
        [("a", "2024-01", datetime(2024, 1, d), f"t{d}") for d in (3, 9, 5)]
        + [("a", "2024-02", datetime(2024, 2, 1), "u"), ("b", "2024-01", datetime(2024, 1, 1), "v1"),
           ("b", "2024-01", datetime(2024, 1, 1), "v2")],
        "account_id string, txn_month string, txn_timestamp timestamp_ntz, txn_id string")
    for stored in (True, False):
        assert sorted(r.txn_id for r in rules.month_end(rows, stored).collect()) == ["t9", "u", "v2"]


@pytest.mark.parametrize(("rate", "exact"), [("36.12345678", True), ("36.1234567800", True), ("7", True), ("0.123456789", False),
                                             ("0.00000000123", False), ("1e-9", False), ("12345678901.5", False), ("x", False)])
def test_rates_are_exact_or_refused_by_name(spark, rate, exact):
    fx = spark.createDataFrame([("2024-01", "USD", rate)], "rate_month string, currency_code string, rate_to_thb string")
    if exact:
        assert silver.rates(fx).first()["_rate"] == D(rate)
    else:
        with pytest.raises(Exception, match="2024-01 USD"):
            silver.rates(fx).collect()


def test_all_missing_pairs_are_named(spark, bronze_rows):
    fx = spark.createDataFrame([], "rate_month string, currency_code string, rate_to_thb string")
    months = [f"2024-{m:02d}" for m in range(1, 13)]
    rows = bronze_rows(*[{"txn_timestamp": f"{m}-05 10:00:00"} for m in months])
    with pytest.raises(rules.MissingRate) as problem:
        rules.require_rates(rows, fx)
    assert all(m in str(problem.value) for m in months)
