"""Column specification and business constants shared by all layers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The 50 transaction columns in judging order, each with its type. "First failing column" means first
# in this order.
_TRANSACTION_COLUMNS = """
cust_id                        text
cust_age                       int
cust_gender                    text
cust_marital_status            text
cust_dependents                int
cust_education                 text
cust_employment_status         text
cust_occupation_sector         text
cust_annual_income_usd         decimal(14,2)
cust_home_ownership            text
account_id                     text
account_type                   text
account_open_date              date
account_status                 text
account_kyc_tier               text
primary_branch_region          text
total_assets_under_management  decimal(14,2)
has_active_credit_card         boolean
has_active_loan                boolean
digital_banking_enrollment     boolean
txn_id                         text
txn_timestamp                  timestamp
txn_type                       text
txn_channel                    text
txn_amount_usd                 decimal(14,2)
txn_currency                   text
counterparty_id                text
counterparty_type              text
merchant_category_code_mcc     int
txn_response_code              text
orig_balance_before            decimal(14,2)
orig_balance_after             decimal(14,2)
dest_balance_before            decimal(14,2)
dest_balance_after             decimal(14,2)
monthly_avg_inflow             decimal(14,2)
monthly_avg_outflow            decimal(14,2)
overdraft_limit_usd            decimal(14,2)
days_in_overdraft_l12m         int
credit_card_utilization_rate   decimal(5,4)
delinquency_status             text
risk_score_internal            int
bureau_credit_score            int
device_type                    text
device_ip_country              text
is_vpn_used                    boolean
login_attempts_fail_count      int
txn_velocity_1h                int
behavioral_anomaly_flag        boolean
target_credit_default          boolean
target_is_fraud_aml            boolean
"""


@dataclass(frozen=True)
class ColumnSpec:
    """One transaction column: its lower-case name, the kind of converter it needs and its SQL type."""

    name: str
    kind: str
    sql_type: str


def _column(line: str) -> ColumnSpec:
    name, declared = line.split()
    sql_type = {"text": "string", "timestamp": "timestamp_ntz"}.get(declared, declared)
    return ColumnSpec(name, declared.split("(")[0], sql_type)


TRANSACTION_SPEC = [_column(line) for line in _TRANSACTION_COLUMNS.strip().splitlines()]
TRANSACTION_COLUMNS = [c.name for c in TRANSACTION_SPEC]

KEY = "txn_id"
LOAD_SEQ = "_load_seq"

# Texts that the loader treats as missing, besides the empty text.
NA_TOKENS = [
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Source delinquency text -> standard code. A customer in default is lifted to DEFAULT_CODE.
DELINQUENCY_CODES = {
    "Current": "M0",
    "30_Days_Past_Due": "M1",
    "60_Days_Past_Due": "M2",
    "90_Plus_Days_Past_Due": "M3",
}
DEFAULT_CODE = "M4+"

# Loan status per code and provision rate per code.
PERFORMING, UNDER_PERFORMING, NPL, UNKNOWN = "Performing", "Under-Performing", "NPL", "Unknown"
PROVISION_RATES = {"M0": "0.01", "M1": "0.02", "M2": "0.10", "M3": "0.50", "M4+": "1.00"}
DEFAULT_PROVISION_RATE = "1.00"
OTHER_PROVISION_RATE = "0.01"

# Types of stored amounts. Rates have 8 decimals at most (others are refused) until the one rounding at the end.
MONEY = "decimal(14,2)"
MONEY_SUM = "decimal(20,2)"
RATIO = "decimal(8,4)"
FX_RATE = "decimal(18,8)"
FX_DECIMALS = 8
STORED_FX_RATE = "decimal(10,4)"
STORED_PROVISION_RATE = "decimal(5,4)"

# The stage names of a full run, in order.
STAGES = ["load_raw_transaction", "load_fx_rate", "bronze_transform", "silver_transform", "gold_aggregate",
          "data_quality", "reconciliation", "export_report"]

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.LongType(), False),
    T.StructField("pipeline_name", T.StringType(), False),
    T.StructField("step_name", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("started_at", T.TimestampNTZType(), False),
    T.StructField("finished_at", T.TimestampNTZType(), True),
    T.StructField("duration_sec", T.DecimalType(10, 2), True),
    T.StructField("rows_processed", T.LongType(), True),
    T.StructField("error_message", T.StringType(), True),
    T.StructField("run_date", T.DateType(), False),
    T.StructField("event_time", T.TimestampNTZType(), False),
])
