"""Adapter: the given tables seen as the three inputs of the pipeline.

Transactions come from `orders` with its customer and region, one row per order, every value as text and with the
header spelling of a source file. Some values are spoilt on purpose by order key, so that every reject reason and
copies of a transaction occur. Rates cover every order month and currency but one pair, left out on purpose. Run-log
events come from `events`.

The column expressions are plain SQL that Spark and DuckDB both read; only the text of a timestamp differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.spec import LOAD_SEQ, STAGES

CURRENCIES = {"USD": "34.1234", "EUR": "37.5678", "GBP": "43.4321", "Local": None}
MISSING_RATE = ("1998-02", "GBP")
RUN_LOG_AS_OF = "2024-01-30"
SOURCE_FILE = "orders.parquet"
LOADED_AT = "2024-01-30T00:00:00"


def _padded(prefix: str, number: str, width: int) -> str:
    """Prefix and zero-padded number; a longer number keeps all its digits, so that keys stay distinct."""
    text = f"cast({number} as string)"
    return f"concat('{prefix}-', lpad({text}, cast(greatest({width}, length({text})) as int), '0'))"


def _choice(key: str, texts: list[str]) -> str:
    """One of the texts, by remainder of the key."""
    branches = " ".join(f"when {i} then '{t}'" for i, t in enumerate(texts[:-1]))
    return f"case cast({key} as bigint) % {len(texts)} {branches} else '{texts[-1]}' end"


def _flag(key: str, divisor: int) -> str:
    return f"case when cast({key} as bigint) % {divisor} = 0 then 'True' else 'False' end"


def _money(expression: str) -> str:
    return f"cast(cast({expression} as decimal(14,2)) as string)"


def transaction_expressions(order_time: str) -> dict[str, str]:
    """Column name -> SQL over orders, customer and region. `order_time` is the text of the order timestamp."""
    balance = "cast(c_acctbal as decimal(14,2))"
    return {
        "cust_id": _padded("CUST", "o_custkey", 8),
        "cust_age": "case when o_orderkey % 109 = 13 then '12.0' else cast(22 + o_custkey % 40 as string) end",
        "cust_gender": _choice("o_custkey", ["M", "F"]),
        "cust_marital_status": _choice("o_custkey", ["Single", "Married", "Divorced", "Widowed"]),
        "cust_dependents": "case when o_orderkey % 131 = 23 then '99999999999' else cast(o_custkey % 5 as string) end",
        "cust_education": _choice("o_custkey", ["High_School", "Undergraduate", "Postgraduate", "Doctorate"]),
        "cust_employment_status": _choice(
            "o_custkey", ["Employed", "Self-Employed", "Unemployed", "Retired", "Student"]),
        "cust_occupation_sector": "case when o_custkey % 50 = 0 then '' else "
            + _choice("o_custkey", ["Finance", "Tech", "Healthcare", "Government", "Retail"]) + " end",
        "cust_annual_income_usd": _money("7487.50 + 100 * (o_custkey % 1000)"),
        "cust_home_ownership": _choice("o_custkey", ["Own_Outright", "Own_Mortgage", "Rent", "Live_With_Parents"]),
        "account_id": _padded("ACCT", "o_custkey", 9),
        "account_type": "c_mktsegment",
        "account_open_date": "case when o_orderkey % 113 = 17 then '2014-13-01' "
            "else concat(cast(2005 + o_custkey % 15 as string), '-01-15') end",
        "account_status": _choice("o_custkey", ["Active", "Dormant", "Suspended"]),
        "account_kyc_tier": _choice("o_custkey", ["Tier_1_Basic", "Tier_2_Standard", "Tier_3_Premium"]),
        "primary_branch_region": "r_name",
        "total_assets_under_management": _money(f"abs({balance}) * 3"),
        "has_active_credit_card": _flag("o_custkey", 2),
        "has_active_loan": _flag("o_custkey", 3),
        "digital_banking_enrollment": _flag("o_custkey", 5),
        "txn_id": "case when o_orderkey % 127 = 19 then '' "
            f"when o_orderkey % 89 = 7 then {_padded('TXN', '(o_orderkey - 1)', 10)} "
            f"else {_padded('TXN', 'o_orderkey', 10)} end",
        "txn_timestamp": f"case when o_orderkey % 103 = 9 then '2024-02-30 00:00:00' else {order_time} end",
        "txn_type": _choice(
            "o_orderkey", ["ACH_Debit", "ATM_Withdrawal", "Cash_Deposit", "Online_Shopping", "POS_Purchase"]),
        "txn_channel": _choice("o_orderkey", ["Mobile_App", "Web_Portal", "Branch_ATM", "In_Person_Branch"]),
        "txn_amount_usd": f"case when o_orderkey % 97 = 5 then 'abc' else {_money('o_totalprice')} end",
        "txn_currency": _choice("o_orderkey", list(CURRENCIES)),
        "counterparty_id": _padded("CP", "(o_orderkey % 1000)", 9),
        "counterparty_type": _choice("o_orderkey", ["Individual", "Small_Business", "Mega_Corporation"]),
        "merchant_category_code_mcc": "cast(5000 + o_orderkey % 1000 as string)",
        "txn_response_code": _choice("o_orderkey", ["Approved", "Insufficient_Funds", "System_Timeout"]),
        "orig_balance_before": _money(f"{balance} + 100"),
        "orig_balance_after": _money("c_acctbal"),
        "dest_balance_before": _money("500"),
        "dest_balance_after": _money("600"),
        "monthly_avg_inflow": "case when o_orderkey % 137 = 29 then '1234567890123456.00' else "
            + _money("1000 + o_custkey % 100") + " end",
        "monthly_avg_outflow": _money("900 + o_custkey % 100"),
        "overdraft_limit_usd": _money("1000"),
        "days_in_overdraft_l12m": "cast(o_custkey % 30 as string)",
        "credit_card_utilization_rate": "cast(cast((o_custkey % 101) * 0.01 as decimal(5,4)) as string)",
        "delinquency_status": "case when o_orderkey % 101 = 3 then 'Unknown_Status' "
            "when o_orderpriority = '1-URGENT' then '90_Plus_Days_Past_Due' "
            "when o_orderpriority = '2-HIGH' then '60_Days_Past_Due' "
            "when o_orderpriority = '3-MEDIUM' then '30_Days_Past_Due' else 'Current' end",
        "risk_score_internal": "cast(494 + o_custkey % 300 as string)",
        "bureau_credit_score": "cast(519 + o_custkey % 265 as string)",
        "device_type": _choice("o_orderkey", ["iOS", "Android", "Windows", "MacOS", "Linux"]),
        "device_ip_country": _choice("o_orderkey", ["US", "TH", "NA", "RU"]),
        "is_vpn_used": _flag("o_orderkey", 7),
        "login_attempts_fail_count": "cast(o_orderkey % 4 as string)",
        "txn_velocity_1h": "cast(o_orderkey % 8 as string)",
        "behavioral_anomaly_flag": _flag("o_orderkey", 11),
        "target_credit_default": "case when o_orderkey % 107 = 11 then 'yes' "
            "when o_orderkey % 17 = 0 then 'True' else 'False' end",
        "target_is_fraud_aml": _flag("o_orderkey", 13),
    }


def header(name: str) -> str:
    """Spelling of a column in a source file, such as Txn_Id."""
    return "_".join(part.capitalize() for part in name.split("_"))


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def transaction_source(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions as a source file would hold them, plus the load position.

    Region is joined to the customers, not to the orders; an order without a customer stays, its customer's columns
    empty. No join carries a hint: Spark broadcasts a side only when its size allows, and splits skewed customers when
    it joins by shuffle.
    """
    customers = (_table(spark, folder, "customer")
                 .join(_table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
                 .join(_table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
                 .select("c_custkey", "c_acctbal", "c_mktsegment", "r_name"))
    rows = _table(spark, folder, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
    columns = transaction_expressions("cast(o_orderdate as string)")
    return rows.selectExpr(*[f"{sql} as {header(name)}" for name, sql in columns.items()],
                           f"o_orderkey as {LOAD_SEQ}")


def fx_source(spark: SparkSession, folder: str) -> DataFrame:
    """Exchange rates as text: one row per order month and currency."""
    months = (_table(spark, folder, "orders").where("o_orderdate is not null")
              .select(F.substring(F.col("o_orderdate").cast("string"), 1, 7).alias("rate_month")).distinct())
    month_number = "cast(substring(rate_month, 6, 2) as int)"
    rates = ", ".join(
        f"named_struct('currency_code', '{code}', 'rate', cast("
        + (f"{base} + 0.0125 * {month_number}" if base else "1") + " as decimal(18,8)))"
        for code, base in CURRENCIES.items())
    month, currency = MISSING_RATE
    return (months.selectExpr("rate_month", f"inline(array({rates}))")
            .where(f"not (rate_month = '{month}' and currency_code = '{currency}')")
            .selectExpr("rate_month as Rate_Month", "currency_code as Currency_Code",
                        "cast(rate as string) as Rate_To_Thb", "'bank' as Source"))


_KEY_NUMBER = "cast(substring(txn_id, 5) as bigint)"
_IN_DEFAULT = "target_credit_default"

# Columns of Silver and Gold spoilt by key, so that each check has rows that fail it; SQL that both engines read.
SPOILT_SILVER = {
    "cust_id": f"case when {_KEY_NUMBER} % 31 = 1 then null else cust_id end",
    "fx_rate_to_thb": f"case when {_KEY_NUMBER} % 41 = 3 then 0 else fx_rate_to_thb end",
    "orig_balance_thb": f"case when {_KEY_NUMBER} % 43 = 4 then -1 else orig_balance_thb end",
    "loan_status": f"case when {_KEY_NUMBER} % 47 = 5 then 'Unknown' when {_IN_DEFAULT} and {_KEY_NUMBER} % 3 = 1 "
                   "then 'Performing' else loan_status end",
    "provision_rate": f"case when {_IN_DEFAULT} and {_KEY_NUMBER} % 2 = 1 then 0.5 else provision_rate end",
}
REPEATED_SILVER = f"{_KEY_NUMBER} % 37 = 2"
_MONTH = "substring(report_month, 6, 2)"
SPOILT_GOLD = {
    "total_accounts": f"case when {_MONTH} = '08' then total_accounts + 1 else total_accounts end",
    "outstanding_balance_thb": f"case when {_MONTH} = '04' then outstanding_balance_thb + 2 "
                               f"when {_MONTH} = '05' then 0 else outstanding_balance_thb end",
    "npl_accounts": f"case when {_MONTH} = '06' then npl_accounts + 1 else npl_accounts end",
    "npl_ratio_pct": f"case when {_MONTH} = '03' then 150 else npl_ratio_pct end",
    "total_provision_thb": f"case when {_MONTH} = '09' then total_provision_thb + 3 else total_provision_thb end",
}
LOST_MONTH = f"{_MONTH} = '07'"


def _spoilt(layer: DataFrame, changes: dict[str, str]) -> DataFrame:
    types = {f.name: f.dataType.simpleString() for f in layer.schema}
    return layer.selectExpr(*[f"cast({changes[c]} as {types[c]}) as {c}" if c in changes else c for c in layer.columns])


def spoilt_silver(silver: DataFrame) -> DataFrame:
    """Silver with values that fail every row check, and some rows twice."""
    return _spoilt(silver, SPOILT_SILVER).withColumn(
        "_times", F.expr(f"explode(case when {REPEATED_SILVER} then array(1, 2) else array(1) end)")).drop("_times")


def spoilt_gold(gold: DataFrame) -> DataFrame:
    """Gold with figures that fail its checks and reconciliations, and a month lost in each year."""
    return _spoilt(gold, SPOILT_GOLD).where(f"not ({LOST_MONTH})")


def run_log_events(spark: SparkSession, folder: str) -> DataFrame:
    """Run-log events: a RUNNING event when a step starts and, for most steps, a second one with its final state."""
    names = ", ".join(f"'{s}'" for s in STAGES)
    steps = _table(spark, folder, "events").selectExpr(
        "event_id as run_id", "'full_pipeline' as pipeline_name",
        f"element_at(array({names}), cast(event_id % {len(STAGES)} as int) + 1) as step_name",
        "case event_type when 'error' then 'FAILED' when 'signup' then 'RUNNING' else 'SUCCESS' end as final_status",
        "ts as started_at", "cast(value as decimal(10,2)) as seconds", "user_id", "props")
    micros = "make_dt_interval(0, 0, 0, cast(seconds as decimal(18,6)))"
    states = ("inline(filter(array("
              "named_struct('status', 'RUNNING', 'ended', false), "
              "named_struct('status', final_status, 'ended', true)), s -> not s.ended or s.status <> 'RUNNING'))")
    return (steps.selectExpr("*", states)
            .selectExpr(
                "run_id", "pipeline_name", "step_name", "status", "started_at",
                f"case when ended then started_at + {micros} end as finished_at",
                "case when ended then seconds end as duration_sec",
                "case when ended then user_id end as rows_processed",
                "case when status = 'FAILED' then props end as error_message",
                "to_date(started_at) as run_date",
                f"case when ended then started_at + {micros} else started_at end as event_time"))
