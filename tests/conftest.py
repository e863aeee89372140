from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from riskmart import session  # noqa: E402
from riskmart.spec import TRANSACTION_COLUMNS  # noqa: E402

TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    created = session.create(
        "riskmart-tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
           "spark.ui.showConsoleProgress": "false", "spark.sql.debug.maxToStringFields": "1000",
           "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    created.sparkContext.setLogLevel("ERROR")
    yield created
    created.stop()


# A raw row that passes every rule.
VALID = dict.fromkeys(TRANSACTION_COLUMNS, "") | {
    "cust_id": "CUST-00000001", "cust_age": "30", "account_id": "ACCT-000000001", "account_type": "Savings",
    "account_open_date": "2014-01-05", "primary_branch_region": "North", "txn_id": "TXN-1",
    "txn_timestamp": "2024-01-31 23:59:59", "txn_amount_usd": "10.00", "txn_currency": "USD",
    "orig_balance_after": "1000.00", "delinquency_status": "Current", "target_credit_default": "False",
    "_loaded_at": "2024-02-01T00:00:00", "_source_file": "t.csv",
}


@pytest.fixture
def raw_rows(spark):
    """Raw layer of the given changes to the valid row, in load order."""
    def build(*changes: dict):
        rows = [VALID | {"txn_id": f"TXN-{i}"} | change | {"_load_seq": i} for i, change in enumerate(changes)]
        names = [*VALID, "_load_seq"]
        schema = ", ".join(f"`{n}` {'long' if n == '_load_seq' else 'string'}" for n in names)
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
    return build
