from __future__ import annotations

from decimal import Decimal as D

import pytest

from riskmart.operators import quality, reconcile

SILVER_SCHEMA = ("cust_id string, txn_id string, txn_month string, fx_rate_to_thb decimal(10,4), "
                 "orig_balance_thb decimal(14,2), loan_status string, provision_rate decimal(5,4), "
                 "provision_amount_thb decimal(14,2), target_credit_default boolean")
OK = {"cust_id": "c", "txn_id": "t", "txn_month": "2024-01", "fx_rate_to_thb": D("35"),
      "orig_balance_thb": D("100.00"), "loan_status": "Performing", "provision_rate": D("0.01"),
      "provision_amount_thb": D("1.00"), "target_credit_default": False}
GOLD_SCHEMA = ("report_month string, total_accounts long, outstanding_balance_thb decimal(20,2), npl_accounts long, "
               "npl_ratio_pct decimal(8,4), total_provision_thb decimal(20,2)")


def silver_of(spark, *changes):
    rows = [OK | {"txn_id": f"t{i}"} | c for i, c in enumerate(changes)]
    return spark.createDataFrame([tuple(r[k] for k in OK) for r in rows], SILVER_SCHEMA)


def gold_of(spark, *changes, months=12):
    base = [{"report_month": f"2024-{m:02d}", "total_accounts": 1, "outstanding_balance_thb": D("100"),
             "npl_accounts": 0, "npl_ratio_pct": D("0"), "total_provision_thb": D("1")} for m in range(1, months + 1)]
    for row, change in zip(base, changes):
        row.update(change)
    return spark.createDataFrame([tuple(r.values()) for r in base], GOLD_SCHEMA)


def failed(spark, silver, gold, year=2024):
    rows = quality.checks(silver, gold, year).collect()
    assert [r.check_name for r in rows] == sorted(
        [r.check_name for r in rows], key=lambda n: (n.split("_")[0], n)) and len(rows) == 10
    return {r.check_name: r.failed_count for r in rows if r.status == "FAIL"}


def test_all_pass(spark):
    silver, gold = silver_of(spark, {}, {}), gold_of(spark)
    assert failed(spark, silver, gold) == {}
    assert len(quality.gate(quality.checks(silver, gold, 2024))) == 10


@pytest.mark.parametrize(("changes", "expected"), [
    ([{"cust_id": None}, {"provision_amount_thb": None}], {quality.NULL_CHECK: 2}),
    # A key present three times is one failure; missing keys count as one key.
    ([{"txn_id": "d"}, {"txn_id": "d"}, {"txn_id": "d"}], {quality.DUPLICATE: 1}),
    ([{"txn_id": None}, {"txn_id": None}], {quality.DUPLICATE: 1, quality.NULL_CHECK: 2}),
    ([{"fx_rate_to_thb": None}, {"fx_rate_to_thb": D("0")}], {quality.FX_POSITIVE: 2}),
    ([{"orig_balance_thb": D("0")}], {quality.BALANCE_POSITIVE: 1}),
    ([{"loan_status": "Unknown"}], {quality.STATUS_VALID: 1}),
    # A missing status passes the domain check and fails the null check.
    ([{"loan_status": None}], {quality.NULL_CHECK: 1}),
    ([{"target_credit_default": True, "loan_status": "NPL"}], {quality.DEFAULT_RATE: 1}),
    ([{"target_credit_default": True, "provision_rate": D("1")}], {quality.DEFAULT_STATUS: 1}),
])
def test_silver_failures(spark, changes, expected):
    assert failed(spark, silver_of(spark, *changes), gold_of(spark)) == expected


@pytest.mark.parametrize(("changes", "expected"), [
    ([{"npl_ratio_pct": D("-1")}, {"npl_ratio_pct": D("100.0001")}, {"npl_ratio_pct": D("100")}],
     {quality.RATIO_RANGE: 2}),
    ([{"total_provision_thb": D("100.01")}, {"total_provision_thb": D("100")}], {quality.PROVISION_LIMIT: 1}),
])
def test_gold_failures(spark, changes, expected):
    assert failed(spark, silver_of(spark, {}), gold_of(spark, *changes)) == expected


def test_completeness_and_gate(spark):
    results = quality.checks(silver_of(spark, {"orig_balance_thb": D("0")}), gold_of(spark, months=11), 2024)
    row = results.where("check_name = 'gold_monthly_completeness'").first()
    assert (row.status, row.failed_count) == ("FAIL", 1) and " 11 " in row.detail
    with pytest.raises(quality.ChecksFailed) as error:
        quality.gate(results)
    assert "gold_monthly_completeness: 1" in str(error.value) and "silver_balance_positive: 1" in str(error.value)


def bronze_of(spark, *balances):
    return spark.createDataFrame([(None if b is None else D(b),) for b in balances], "orig_balance_after decimal(14,2)")


def recon(spark, silver, gold, *balances, **options):
    rows = reconcile.checks(bronze_of(spark, *balances), silver, gold, **options).collect()
    return {r.check_name: r for r in rows}


def one_month(spark, **change):
    totals = {"report_month": "2024-01", "total_accounts": 2, "outstanding_balance_thb": D("200"), "npl_accounts": 1,
              "npl_ratio_pct": D("50"), "total_provision_thb": D("2")} | change
    return spark.createDataFrame([tuple(totals.values())], GOLD_SCHEMA)


def test_reconciled(spark):
    rows = recon(spark, silver_of(spark, {}, {"loan_status": "NPL"}), one_month(spark), "1", "2", "0", "-1", None)
    assert list(rows) == sorted(reconcile.DETAILS) and {r.status for r in rows.values()} == {"PASS"}
    assert rows[reconcile.BRONZE_SILVER].source_value == 2


@pytest.mark.parametrize(("change", "balances", "name", "difference"), [
    ({}, ["1", "1", "1"], reconcile.BRONZE_SILVER, "1"),
    ({"total_accounts": 3}, ["1", "1"], reconcile.SILVER_GOLD, "-1"),
    ({"npl_accounts": 0}, ["1", "1"], reconcile.NPL_COUNT, "1"),
    ({"outstanding_balance_thb": D("198.99")}, ["1", "1"], reconcile.BALANCE, "1.01"),
    ({"total_provision_thb": D("0.99")}, ["1", "1"], reconcile.PROVISION, "1.01"),
])
def test_each_reconciliation_fails(spark, change, balances, name, difference):
    rows = recon(spark, silver_of(spark, {}, {"loan_status": "NPL"}), one_month(spark, **change), *balances)
    assert {n for n, r in rows.items() if r.status == "FAIL"} == {name}
    assert rows[name].difference == D(difference)


@pytest.mark.parametrize("column", ["outstanding_balance_thb", "total_provision_thb"])
def test_amounts_may_differ_by_the_tolerance(spark, column):
    base = {"outstanding_balance_thb": D("200"), "total_provision_thb": D("2")}
    rows = recon(spark, silver_of(spark, {}, {"loan_status": "NPL"}),
                 one_month(spark, **{column: base[column] - 1}), "1", "1")
    assert {r.status for r in rows.values()} == {"PASS"}


def test_empty_gold_counts_as_zero(spark):
    rows = recon(spark, silver_of(spark, {}), gold_of(spark).where("false"), "1")
    assert rows[reconcile.SILVER_GOLD].target_value == 0 and rows[reconcile.SILVER_GOLD].status == "FAIL"
