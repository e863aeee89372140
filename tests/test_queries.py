from __future__ import annotations

import pytest

import __spark_entry__ as contract
import oracle_check
from conftest import TINY
from riskmart.operators import runlog
from riskmart.plans import oracle
from riskmart.plans.queries import QUERIES

ORACLE = oracle.build()


@pytest.fixture(scope="module")
def connection():
    return oracle_check.connect(TINY)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, connection, name):
    rows, difference = oracle_check.compare(spark, connection, contract.queries()[name], ORACLE[name], TINY)
    assert difference == "" and rows > 0


def test_flagship_figures(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 79 and sum(r.total_accounts for r in rows) == 1265
    assert str(sum(r.outstanding_balance_thb for r in rows)) == "172528262.77"
    assert str(sum(r.total_provision_thb for r in rows)) == "31039448.87"
    assert sum(r.npl_balance_thb is None for r in rows) == 31


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_plans_have_no_product_and_no_python(spark, name):
    plan = plan_of(contract.queries()[name](spark, TINY))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert operator not in plan


def test_flagship_plan(spark):
    plan = plan_of(contract.queries()["gold_monthly_report"](spark, TINY))
    assert "partial_sum" in plan, "sums are combined before the shuffle"
    assert plan.count("WindowGroupLimit") >= 2, "copies leave before the shuffle"
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "o_orderkey" in line)
    assert "o_orderstatus" not in scan


def test_hot_customer_is_split(spark, tmp_path):
    """A customer with a third of all orders joined by shuffle: same result, skewed partition split."""
    for table in ("customer", "nation", "region", "events"):
        spark.read.parquet(f"{TINY}/{table}.parquet").write.parquet(str(tmp_path / f"{table}.parquet"))
    orders = spark.read.parquet(f"{TINY}/orders.parquet")
    hot = orders.selectExpr("o_orderkey", "if(o_orderkey % 3 = 0, 7L, o_custkey) as o_custkey", "o_orderstatus",
                            "o_totalprice", "o_orderdate", "o_orderpriority")
    hot.repartition(16).write.parquet(str(tmp_path / "orders.parquet"))
    query = contract.queries()["gold_monthly_report"]
    expected = sorted(map(str, query(spark, str(tmp_path)).collect()))
    options = {"spark.sql.autoBroadcastJoinThreshold": "-1",
               "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000",
               "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
               "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000"}
    saved = {k: spark.conf.get(k) for k in options}
    try:
        for key, value in options.items():
            spark.conf.set(key, value)
        shuffled = query(spark, str(tmp_path))
        assert sorted(map(str, shuffled.collect())) == expected
        assert "skew=true" in shuffled._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in saved.items():
            spark.conf.set(key, value)


def test_run_log_fold_keeps_the_last_state(spark):
    events = spark.sql("""select * from values
        (1L, 'p', 's', 'RUNNING', timestamp_ntz'2024-01-01 00:00:00', cast(null as timestamp_ntz), null, null, null,
         date'2024-01-01', timestamp_ntz'2024-01-01 00:00:00'),
        (1L, 'p', 's', 'FAILED', timestamp_ntz'2024-01-01 00:00:00', timestamp_ntz'2024-01-01 00:00:00', 0.00BD, 5L,
         'why', date'2024-01-01', timestamp_ntz'2024-01-01 00:00:00'),
        (2L, 'p', 's', 'RUNNING', timestamp_ntz'2024-01-09 00:00:00', null, null, null, null,
         date'2024-01-09', timestamp_ntz'2024-01-09 00:00:00')
        as t(run_id, pipeline_name, step_name, status, started_at, finished_at, duration_sec, rows_processed,
             error_message, run_date, event_time)""")
    runs = runlog.current(events)
    assert sorted((r.run_id, r.status) for r in runs.collect()) == [(1, "FAILED"), (2, "RUNNING")]
    assert [r.status for r in runlog.recent(runs, "2024-01-09", 7).collect()] == ["RUNNING"]
    assert runlog.recent(runs, "2024-01-08", 7).count() == 2


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_building_a_query_starts_no_job_and_leaves_the_session_alone(spark, name):
    settings = dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.codegen.maxFields"), spark.conf.get(
        "spark.sql.shuffle.partitions")
    spark.sparkContext.setJobGroup(f"build-{name}", name)
    try:
        QUERIES[name](spark, TINY)
        # Reading a schema from a file footer is the one job that building may need.
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{name}")
        stages = [spark.sparkContext.statusTracker().getJobInfo(j).stageIds for j in jobs]
        tasks = [spark.sparkContext.statusTracker().getStageInfo(s) for ids in stages for s in ids]
        assert all(t is None or t.name.startswith("parquet at") for t in tasks)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert settings == (dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.codegen.maxFields"),
                        spark.conf.get("spark.sql.shuffle.partitions"))


def test_checks_read_silver_twice(spark):
    final = QUERIES["dq_results"](spark, TINY)
    final.collect()
    plan = final._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert sum("FileScan" in line and "o_orderkey" in line for line in plan.splitlines()) <= 2


def test_raw_profile_hashes(spark):
    plan = plan_of(QUERIES["diag_raw_profile"](spark, TINY))
    assert "Expand" not in plan
