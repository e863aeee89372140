from __future__ import annotations

import csv
import os

import pytest

import oracle_check
from conftest import TINY
from riskmart.operators import constraints, quality, reports, runlog
from riskmart.plans import oracle, pipeline
from riskmart.plans.layers import Layers
from riskmart.plans.pipeline import Settings
from riskmart.sources import given, tables
from riskmart.spec import STAGES, TRANSACTION_COLUMNS


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """Source files of the smallest tables, in load order: transactions, all rates, rates with one pair missing."""
    folder = tmp_path_factory.mktemp("source")
    transactions = given.transaction_source(spark, TINY).orderBy("_load_seq").drop("_load_seq").toPandas()
    transactions.to_csv(folder / "txns.csv", index=False)
    rates = given.fx_source(spark, TINY).toPandas()
    rates.to_csv(folder / "missing.csv", index=False)
    month, currency = given.MISSING_RATE
    rates.loc[len(rates)] = [month, currency, "43.4571", "bank"]
    rates.to_csv(folder / "rates.csv", index=False)
    return folder


def settings(files, root, rates="rates.csv", **options):
    return Settings(str(files / "txns.csv"), str(files / rates), str(root), 1997, **options)


@pytest.fixture(scope="module")
def complete(spark, files, tmp_path_factory):
    root = tmp_path_factory.mktemp("complete")
    return pipeline.run(spark, settings(files, root))


def same(left, right, columns):
    return sorted(map(str, left.select(*columns).collect())) == sorted(map(str, right.select(*columns).collect()))


def test_stored_layers_equal_the_lazy_ones(spark, complete):
    lazy = Layers(spark, TINY)
    assert complete.tables.read(tables.RAW_TRANSACTIONS).count() == 1500
    assert same(complete.tables.read(tables.BRONZE), lazy.bronze, TRANSACTION_COLUMNS)
    assert same(complete.tables.read(tables.QUARANTINE), lazy.quarantine,
                ["cust_id", "txn_id", "failed_column", "failed_value", "failure_reason"])
    stored = complete._silver().where("not (txn_month = '1998-02' and txn_currency = 'GBP')")
    assert stored.schema.simpleString() == lazy.silver.schema.simpleString()
    assert same(stored, lazy.silver, stored.columns)
    kpis = complete.tables.read(tables.GOLD).where("report_month <> '1998-02'")
    assert same(kpis, lazy.gold.where("report_month <> '1998-02'"), lazy.gold.columns)
    for table, name in ((tables.BRONZE, "bronze"), (tables.SILVER, "silver"), (tables.GOLD, "gold")):
        stamps = complete.tables.read(table).select(f"_{name}_loaded_at").distinct().collect()
        assert [r[0] for r in stamps] == [complete.started]


def test_silver_is_pruned_by_month(complete):
    plan = complete._silver().where("txn_month = '1997-03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(txn_month" in plan


def test_run_log_holds_every_stage(spark, complete):
    runs = runlog.current(runlog.read_events(spark, complete.log.path)).orderBy("run_id").collect()
    assert [r.step_name for r in runs] == STAGES
    assert {r.status for r in runs} == {"SUCCESS"}
    rows = {r.step_name: r.rows_processed for r in runs}
    # The run has the rate that the given tables lack, so every Bronze row with debt reaches Silver.
    bronze_sql = oracle.build()["bronze_transactions"]
    counted = oracle_check.connect(TINY).execute(
        f"SELECT count(*), count(*) FILTER (orig_balance_after > 0) FROM ({bronze_sql})").fetchone()
    assert rows["load_raw_transaction"] == 1500 and (rows["bronze_transform"], rows["silver_transform"]) == counted
    assert rows["data_quality"] == 10 and rows["reconciliation"] == 5


def test_six_report_files(complete):
    names = sorted(os.path.basename(f) for f in complete.files)
    assert [n.rsplit("_", 2)[0] for n in names] == [
        "1_credit_risk_summary", "2_npl_by_account_type", "2_npl_by_region", "2_npl_monthly", "3_provision_by_delinquency",
        "3_provision_monthly"]
    path = next(f for f in complete.files if "2_npl_monthly" in f)
    with open(path, "rb") as raw:
        assert raw.read(3) == b"\xef\xbb\xbf"
    with open(path, encoding="utf-8-sig", newline="") as text:
        header, *rows = list(csv.reader(text))
    assert header == ["เดือน", "NPL Accounts", "Total Accounts", "NPL Ratio (%)", "NPL Balance (THB)"]
    assert [r[0] for r in rows] == sorted(r[0] for r in rows) and len(rows) == 79
    assert all((r[1] == "0") == (r[4] == "") for r in rows), "a month without NPL has a blank balance"
    assert not [n for n in os.listdir(os.path.dirname(path)) if n.startswith("_")]


def test_rerun_from_silver_gives_the_same_tables(spark, files, complete):
    before = complete.tables.read(tables.GOLD).drop("_gold_loaded_at").collect()
    again = pipeline.run(spark, settings(files, complete.settings.root), from_stage="silver_transform")
    assert again.tables.newest(tables.GOLD).endswith(again.run_id)
    assert not again.tables.newest(tables.BRONZE).endswith(again.run_id)
    assert sorted(map(str, again.tables.read(tables.GOLD).drop("_gold_loaded_at").collect())) == sorted(map(str, before))


def test_missing_rate_fails_reconciliation_and_blocks_the_reports(spark, files, tmp_path):
    with pytest.raises(quality.ChecksFailed, match="count_bronze_to_silver: 2"):
        pipeline.run(spark, settings(files, tmp_path, "missing.csv"))
    runs = runlog.current(runlog.read_events(spark, f"{tmp_path}/{tables.RUN_LOG}")).orderBy("run_id").collect()
    assert [(r.step_name, r.status) for r in runs][-1] == ("reconciliation", "FAILED") and len(runs) == 7
    assert "count_bronze_to_silver" in runs[-1].error_message
    assert not (tmp_path / "reports").exists()


def test_run_can_insist_on_all_rates(spark, files, tmp_path):
    with pytest.raises(Exception, match="1998-02 GBP: 2"):
        pipeline.run(spark, settings(files, tmp_path, "missing.csv", require_all_rates=True))
    assert not (tmp_path / tables.SILVER).exists()


def test_empty_source_replaces_the_tables(spark, files, complete, tmp_path):
    header = (files / "txns.csv").read_text().splitlines()[0]
    (tmp_path / "empty.csv").write_text(header + "\n")
    empty = Settings(str(tmp_path / "empty.csv"), str(files / "rates.csv"), str(tmp_path / "root"), 1997)
    with pytest.raises(quality.ChecksFailed, match="gold_monthly_completeness: 12"):
        pipeline.run(spark, empty)
    run = pipeline.Run(spark, empty)
    for table in (tables.BRONZE, tables.QUARANTINE, tables.GOLD):
        assert run.tables.read(table).count() == 0
    assert run._silver().count() == 0


def test_unfinished_write_is_not_read(spark, tmp_path):
    done = tables.Tables(spark, str(tmp_path), "1")
    done.write("t", spark.range(3))
    os.makedirs(tmp_path / "t" / "run=2")
    assert done.read("t").count() == 3
    with pytest.raises(FileNotFoundError):
        done.read("other")


def test_log_that_cannot_be_written_does_not_stop_a_run(spark, tmp_path):
    (tmp_path / "file").write_text("")
    log = runlog.RunLog(spark, str(tmp_path / "file"), "p")
    log.end(log.start("step"), runlog.SUCCESS, rows=1)


def test_a_table_whose_check_failed_is_not_published(spark, files, complete, tmp_path):
    rates = (files / "rates.csv").read_text()
    month, currency = given.MISSING_RATE
    (tmp_path / "twice.csv").write_text(rates + f"{month},{currency},1.5,bank\n{month},USD,1.5,bank\n")
    before = complete.tables.newest(tables.RAW_FX)
    twice = Settings(str(files / "txns.csv"), str(tmp_path / "twice.csv"), complete.settings.root, 1997)
    with pytest.raises(ValueError, match="2 repeated keys"):
        pipeline.run(spark, twice)
    assert complete.tables.newest(tables.RAW_FX) == before
    again = pipeline.run(spark, twice, from_stage="silver_transform")
    assert again.tables.read(tables.SILVER).count() == complete.tables.read(tables.BRONZE).where("orig_balance_after > 0").count()
    repeated = again.tables.read(tables.REPEATED_RATES).collect()
    assert {(r.rate_month, r.currency_code, r.copies) for r in repeated} == {(month, currency, 2), (month, "USD", 2)}


def test_errors_are_logged_whole(spark, tmp_path):
    log = runlog.RunLog(spark, str(tmp_path / "log"), "p")
    log.end(log.start("step"), runlog.FAILED, error="x" * 5000)
    assert max(len(r.error_message or "") for r in runlog.read_events(spark, str(tmp_path / "log")).collect()) == 5000


def test_retention_keeps_the_newest_published_writes(spark, tmp_path):
    for run in "1234":
        tables.Tables(spark, str(tmp_path), run).write(tables.GOLD, spark.range(int(run)), publish=run != "3")
    last = tables.Tables(spark, str(tmp_path), "5")
    last.retain(2)
    assert sorted(os.listdir(tmp_path / tables.GOLD)) == ["run=2", "run=3", "run=4"]
    assert last.read(tables.GOLD).count() == 4


@pytest.mark.parametrize(("table", "rows", "problem"), [
    (tables.SILVER, [("a",), ("b",), ("a",), ("a",)], r"txn_id not unique \(1\)"),
    (tables.BRONZE, [("a",), (None,), (None,)], r"txn_id is null \(2\); txn_id not unique \(1\)"),
    (tables.GOLD, [("2024-01",), (None,)], r"report_month is null \(1\)"),
])
def test_broken_constraint_leaves_the_published_table(spark, files, tmp_path, table, rows, problem):
    column = "report_month" if table == tables.GOLD else "txn_id"
    run = pipeline.Run(spark, settings(files, tmp_path))
    count, stored = run._publish(table, spark.createDataFrame([("x",), ("y",)], f"{column} string"))
    assert count == stored.count() == 2
    later = pipeline.Run(spark, settings(files, tmp_path))
    with pytest.raises(constraints.Violated, match=problem):
        later._publish(table, spark.createDataFrame(rows, f"{column} string"))
    assert later.tables.newest(table) == run.tables.newest(table)
    assert {r[column] for r in later.tables.read(table).collect()} == {"x", "y"}


def test_run_log_refuses_events_that_break_its_constraints(spark, tmp_path, caplog):
    log = runlog.RunLog(spark, str(tmp_path / "log"), None)
    log.start("step")
    assert "without pipeline_name" in caplog.text and not (tmp_path / "log").exists()


def test_sums_give_the_same_reports(complete):
    stored, found = complete._silver(), complete.tables.read(tables.REPORT_SUMS)
    for dimension in reports.NPL_DIMENSIONS:
        assert reports.npl_breakdown_of(found, dimension).collect() == reports.npl_breakdown(stored, dimension).collect()
    assert reports.provision_monthly_of(found).collect() == reports.provision_monthly(stored).collect()
    assert reports.provision_by_delinquency_of(found).collect() == reports.provision_by_delinquency(stored).collect()


def test_sums_read_silver_once(complete):
    plan = reports.sums(complete._silver())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
