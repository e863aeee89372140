from __future__ import annotations

import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskmart.operators import bronze, firsts
from riskmart.spec import TRANSACTION_COLUMNS, TRANSACTION_SPEC

AT = "2024-02-01 00:00:00"


def outcome(raw):
    """(good rows, quarantine rows) of a raw layer."""
    judged = bronze.judge(raw)
    return bronze.good(judged).collect(), bronze.quarantine(judged, AT).collect()


@pytest.mark.parametrize(("change", "column", "reason"), [
    ({"cust_age": "12.0"}, "cust_age", "INVALID_INT"),
    ({"cust_age": "1_000"}, "cust_age", "INVALID_INT"),
    ({"is_vpn_used": "yes"}, "is_vpn_used", "INVALID_BOOLEAN"),
    ({"is_vpn_used": "TRUE"}, "is_vpn_used", "INVALID_BOOLEAN"),
    ({"txn_timestamp": "2024-02-30 00:00:00"}, "txn_timestamp", "INVALID_TIMESTAMP"),
    ({"txn_timestamp": "2024-02-01T00:00:00"}, "txn_timestamp", "INVALID_TIMESTAMP"),
    ({"txn_timestamp": "2024-02-01 00:00:00.5"}, "txn_timestamp", "INVALID_TIMESTAMP"),
    ({"txn_timestamp": "2024-02-01"}, "txn_timestamp", "INVALID_TIMESTAMP"),
    ({"account_open_date": "2014-01"}, "account_open_date", "INVALID_DATE"),
    ({"account_open_date": "2014-13-01"}, "account_open_date", "INVALID_DATE"),
    ({"account_open_date": " 2014-01-05"}, "account_open_date", "INVALID_DATE"),
    ({"account_open_date": "0000-01-05"}, "account_open_date", "INVALID_DATE"),
    ({"txn_amount_usd": "inf"}, "txn_amount_usd", "INVALID_DECIMAL"),
    ({"txn_amount_usd": "1d"}, "txn_amount_usd", "INVALID_DECIMAL"),
    ({"cust_age": "x", "txn_amount_usd": "abc"}, "cust_age", "INVALID_INT"),
    ({"target_credit_default": "yes", "delinquency_status": "?"}, "target_credit_default", "INVALID_BOOLEAN"),
    ({"delinquency_status": ""}, "delinquency_status", "UNKNOWN_DELINQUENCY"),
    ({"delinquency_status": None}, "delinquency_status", "UNKNOWN_DELINQUENCY"),
    ({"delinquency_status": "?", "target_credit_default": "True"}, "delinquency_status", "UNKNOWN_DELINQUENCY"),
    ({"cust_age": "3000000000"}, "cust_age", "OUT_OF_RANGE"),
    ({"txn_amount_usd": "1e400"}, "txn_amount_usd", "OUT_OF_RANGE"),
    ({"credit_card_utilization_rate": "10"}, "credit_card_utilization_rate", "OUT_OF_RANGE"),
    # A number out of range is judged after every conversion and after the delinquency code.
    ({"cust_age": "3000000000", "txn_amount_usd": "abc"}, "txn_amount_usd", "INVALID_DECIMAL"),
    ({"cust_age": "3000000000", "delinquency_status": "?"}, "delinquency_status", "UNKNOWN_DELINQUENCY"),
    ({"txn_id": ""}, "txn_id", "NULL_KEY"),
    ({"txn_id": "", "cust_age": "3000000000"}, "cust_age", "OUT_OF_RANGE"),
])
def test_bad_row_is_set_aside_with_its_first_failure(raw_rows, change, column, reason):
    good, bad = outcome(raw_rows(change))
    assert good == []
    assert [(r.failed_column, r.failed_value, r.failure_reason) for r in bad] == [(column, change[column], reason)]


@pytest.mark.parametrize(("change", "column", "value"), [
    ({"cust_age": ""}, "cust_age", None),
    ({"cust_age": None}, "cust_age", None),
    ({"cust_age": " +12 "}, "cust_age", 12),
    ({"is_vpn_used": "1"}, "is_vpn_used", True),
    ({"is_vpn_used": "false"}, "is_vpn_used", False),
    ({"account_open_date": "2014-1-5"}, "account_open_date", date(2014, 1, 5)),
    ({"txn_timestamp": "2024-1-5 3:4:5"}, "txn_timestamp", datetime(2024, 1, 5, 3, 4, 5)),
    ({"txn_timestamp": "2024-01-05   03:04:05"}, "txn_timestamp", datetime(2024, 1, 5, 3, 4, 5)),
    ({"txn_amount_usd": "2.345"}, "txn_amount_usd", Decimal("2.35")),
    ({"txn_amount_usd": "-2.345"}, "txn_amount_usd", Decimal("-2.35")),
    ({"txn_amount_usd": "1e3"}, "txn_amount_usd", Decimal("1000.00")),
    ({"txn_amount_usd": ".5"}, "txn_amount_usd", Decimal("0.50")),
    ({"device_ip_country": ""}, "device_ip_country", None),
    ({"target_credit_default": "True"}, "delinquency_status", "M4+"),
    ({"delinquency_status": "30_Days_Past_Due", "target_credit_default": "1"}, "delinquency_status", "M4+"),
    ({"delinquency_status": "90_Plus_Days_Past_Due"}, "delinquency_status", "M3"),
    ({"delinquency_status": "90_Plus_Days_Past_Due", "target_credit_default": ""}, "delinquency_status", "M3"),
    ({"delinquency_status": "60_Days_Past_Due"}, "delinquency_status", "M2"),
])
def test_good_row_is_typed(raw_rows, change, column, value):
    good, bad = outcome(raw_rows(change))
    assert bad == []
    assert good[0][column] == value


def test_schema_is_the_declared_one(raw_rows):
    schema = bronze.good(bronze.judge(raw_rows({}))).schema
    assert [f.name for f in schema.fields] == TRANSACTION_COLUMNS
    assert {f.name: f.dataType.simpleString() for f in schema.fields} == {
        c.name: c.sql_type for c in TRANSACTION_SPEC}


def test_results_do_not_depend_on_zone_or_ansi_mode(spark, raw_rows):
    raw = raw_rows({"txn_timestamp": "2024-03-10 02:30:00"}, {"cust_age": "x"})
    plain = outcome(raw)
    saved = {k: spark.conf.get(k) for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled")}
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        spark.conf.set("spark.sql.ansi.enabled", "false")
        assert outcome(raw) == plain
    finally:
        for key, value in saved.items():
            spark.conf.set(key, value)


def test_quarantine_keeps_the_whole_raw_row(raw_rows):
    _, bad = outcome(raw_rows({"cust_age": "x", "cust_education": "a \"quoted\" text"}))
    kept = json.loads(bad[0].raw_row_data)
    assert kept["cust_age"] == "x" and kept["cust_education"] == "a \"quoted\" text"
    assert kept["_source_file"] == "t.csv" and kept["cust_gender"] == ""
    assert set(kept) == {*TRANSACTION_COLUMNS, "_loaded_at", "_source_file"}
    assert bad[0].quarantined_at == datetime(2024, 2, 1)


def test_missing_source_column_is_null(raw_rows):
    good, bad = outcome(raw_rows({}).drop("cust_age", "account_open_date"))
    assert bad == [] and good[0].cust_age is None and good[0].account_open_date is None


def copies():
    """Rows of one transaction: a bad first one, then three good ones, among other rows."""
    return [{"txn_id": "A", "cust_age": "x"}, {"txn_id": "A", "cust_age": "1"}, {"txn_id": "B", "cust_age": "2"},
            {"txn_id": "A", "cust_age": "3"}, {"txn_id": "C", "cust_age": "4"}, {"txn_id": "C", "cust_age": "y"},
            {"txn_id": "A", "cust_age": "5"}]


def test_first_good_copy_is_kept(raw_rows):
    good, bad = outcome(raw_rows(*copies()))
    assert sorted((r.txn_id, r.cust_age) for r in good) == [("A", 1), ("B", 2), ("C", 4)]
    assert sorted(r.failed_value for r in bad) == ["x", "y"]


def test_plans_for_wide_rows_give_the_same_rows(raw_rows):
    raw = raw_rows(*copies(), {"txn_id": ""}, {"txn_id": ""}, *[{"txn_id": "HOT", "cust_age": str(i)} for i in range(500)],
                   *[{"txn_id": f"ONE-{i}"} for i in range(500)])
    judged = bronze.judge(raw)
    expected = sorted(bronze.good(judged).collect(), key=str)
    assert sorted(bronze.build(raw).collect(), key=str) == expected and len(expected) == 504
    assert sorted(bronze.without_copies(bronze.passed(judged)).collect(), key=str) == expected


def test_only_rows_that_may_repeat_are_shuffled(spark, raw_rows, tmp_path):
    raw_rows(*[{"txn_id": f"ONE-{i}"} for i in range(3000)], *[{"txn_id": "TWO"}] * 2).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    seen = {}
    for name, rows in (("wide", bronze.build(raw)), ("window", bronze.good(bronze.judge(raw)))):
        assert len(rows.collect()) == 3001
        queue, wide = [rows._jdf.queryExecution().executedPlan()], []
        while queue:
            node = queue.pop()
            kind = node.nodeName()
            if kind == "AdaptiveSparkPlan":
                queue.append(node.executedPlan())
                continue
            if "QueryStage" in kind:
                queue.append(node.plan())
                continue
            if kind == "Exchange" and node.output().size() > 40:
                wide.append(node.metrics().apply("shuffleRecordsWritten").value())
            children = node.children()
            queue += [children.apply(i) for i in range(children.size())]
        seen[name] = sum(wide)
    assert seen["wide"] <= 20 and seen["window"] >= 3001


def test_a_full_sieve_still_gives_the_first_rows(spark, monkeypatch):
    monkeypatch.setattr(firsts, "WORDS", 1)
    rows = spark.range(2000).selectExpr("id % 700 as k", "id as place", "cast(id as string) as text")
    found = firsts.first_rows(rows, ["k"], [F.col("place")]).collect()
    assert sorted((r.k, r.place) for r in found) == [(k, k) for k in range(700)]


def test_missing_keys_are_one_key(spark):
    rows = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), (None, 0)], "k string, place int")
    for plan in (firsts.first_rows, firsts.by_window):
        assert sorted(plan(rows, ["k"], [F.col("place")]).collect(), key=str) == [("a", 3), (None, 0)]


def test_split_counts(raw_rows):
    counts = bronze.split_counts(bronze.judge(raw_rows(*copies()))).first()
    assert counts.asDict() == {"good_rows": 5, "quarantined_rows": 2, "duplicate_rows": 2, "bronze_rows": 3}
    empty = bronze.split_counts(bronze.judge(raw_rows({}).where("false"))).first()
    assert set(empty.asDict().values()) == {0}


def test_every_text_is_converted_once(raw_rows):
    """The filter stays above the judging, so no rule is copied below it."""
    judged = bronze.judge(raw_rows({}))
    for rows in (bronze.good(judged), bronze.quarantine(judged, AT)):
        filters = [line for line in rows._jdf.queryExecution().optimizedPlan().toString().splitlines()
                   if "Filter " in line and bronze.RULE in line]
        assert len(filters) == 1 and "CASE" not in filters[0]
