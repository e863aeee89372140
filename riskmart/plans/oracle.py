"""The registered queries as plain SQL for another engine, written apart from the DataFrame jobs.

Only the adapter's column expressions and the column list are shared. Sums and counts are cast to the types the jobs
give, because engines differ in the type of a sum.
"""

from __future__ import annotations

from riskmart.operators import quality, reconcile
from riskmart.plans.layers import QUARANTINED_AT
from riskmart.plans.queries import CHECKED_YEAR
from riskmart.sources import given
from riskmart.spec import NA_TOKENS, STAGES, TRANSACTION_SPEC

_NAMES = [c.name for c in TRANSACTION_SPEC]
_TYPED_KINDS = [c for c in TRANSACTION_SPEC if c.kind != "text"]


_FORMS = {"int": r"\s*[+-]?\d+\s*", "decimal": r"\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*"}


def _readable(c, text: str | None = None) -> str:
    return f"regexp_full_match({text or c.name}, '{_FORMS[c.kind]}')"


def _typed(c) -> str:
    t = f"r.{c.name}"
    if c.kind in _FORMS:
        return f"CASE WHEN {_readable(c, t)} THEN try_cast(trim({t}) AS {c.sql_type}) END"
    if c.kind == "boolean":
        return f"CASE WHEN {t} IN ('True', 'true', '1') THEN true WHEN {t} IN ('False', 'false', '0') THEN false END"
    if c.kind == "date":
        return f"CAST(try_strptime({t}, '%Y-%m-%d') AS DATE)"
    if c.kind == "timestamp":
        return f"try_strptime({t}, '%Y-%m-%d %H:%M:%S')"
    return f"nullif({t}, '')"


def _cte_raw() -> str:
    columns = given.transaction_expressions("CAST(o_orderdate AS VARCHAR)")
    tokens = ", ".join(f"'{t}'" for t in NA_TOKENS)
    source = ",\n    ".join(f"{sql} AS {name}" for name, sql in columns.items())
    blanked = ",\n    ".join(f"CASE WHEN {n} IS NULL OR {n} IN ({tokens}) THEN '' ELSE {n} END AS {n}" for n in _NAMES)
    return f"""source AS (
  SELECT {source}, o_orderkey AS seq
  FROM orders LEFT JOIN (customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
    ON o_custkey = c_custkey),
raw AS (
  SELECT {blanked}, '{given.LOADED_AT}' AS _loaded_at, '{given.SOURCE_FILE}' AS _source_file, seq FROM source)"""


def _cte_judged() -> str:
    reason = {"int": "INVALID_INT", "decimal": "INVALID_DECIMAL", "boolean": "INVALID_BOOLEAN",
              "date": "INVALID_DATE", "timestamp": "INVALID_TIMESTAMP"}
    typed = ",\n    ".join(f"{_typed(c)} AS t_{c.name}" for c in TRANSACTION_SPEC if c.name != "delinquency_status")
    conversions = "\n    ".join(
        f"WHEN {c.name} <> '' AND t_{c.name} IS NULL" + (f" AND NOT {_readable(c)}" if c.kind in _FORMS else "")
        + f" THEN '{c.name}|{reason[c.kind]}'" for c in _TYPED_KINDS)
    ranges = "\n    ".join(f"WHEN {c.name} <> '' AND t_{c.name} IS NULL THEN '{c.name}|OUT_OF_RANGE'"
                           for c in _TYPED_KINDS if c.kind in _FORMS)
    known = "('Current', '30_Days_Past_Due', '60_Days_Past_Due', '90_Plus_Days_Past_Due')"
    return f"""typed AS (
  SELECT r.*, {typed} FROM raw r),
judged AS (
  SELECT *, CASE {conversions}
    WHEN delinquency_status NOT IN {known} THEN 'delinquency_status|UNKNOWN_DELINQUENCY'
    {ranges}
    WHEN t_txn_id IS NULL THEN 'txn_id|NULL_KEY' END AS fail FROM typed)"""


def _cte_bronze() -> str:
    columns = ",\n    ".join(
        """CASE WHEN t_target_credit_default THEN 'M4+' WHEN delinquency_status = 'Current' THEN 'M0'
      WHEN delinquency_status = '30_Days_Past_Due' THEN 'M1' WHEN delinquency_status = '60_Days_Past_Due' THEN 'M2'
      ELSE 'M3' END AS delinquency_status""" if n == "delinquency_status" else f"t_{n} AS {n}" for n in _NAMES)
    return f"""good AS (
  SELECT {columns}, row_number() OVER (PARTITION BY t_txn_id ORDER BY seq) AS copy FROM judged WHERE fail IS NULL),
bronze AS (SELECT * EXCLUDE (copy) FROM good WHERE copy = 1)"""


def _cte_quarantine() -> str:
    value = " ".join(f"WHEN '{n}' THEN {n}" for n in _NAMES)
    pairs = ", ".join(f"'{n}', {n}" for n in [*_NAMES, "_loaded_at", "_source_file"])
    return f"""quarantine AS (
  SELECT md5(txn_id || '|' || CAST(seq AS VARCHAR)) AS quarantine_id, cust_id, txn_id,
    split_part(fail, '|', 1) AS failed_column, CASE split_part(fail, '|', 1) {value} END AS failed_value,
    split_part(fail, '|', 2) AS failure_reason, CAST(json_object({pairs}) AS VARCHAR) AS raw_row_data,
    TIMESTAMP '{QUARANTINED_AT}' AS quarantined_at
  FROM judged WHERE fail IS NOT NULL)"""


def _cte_fx() -> str:
    month_number = "month(month_start)"
    rows = " UNION ALL ".join(
        f"SELECT rate_month, '{code}' AS currency_code, CAST("
        + (f"{base} + 0.0125 * {month_number}" if base else "1")
        + " AS DECIMAL(18,8)) AS rate FROM months" for code, base in given.CURRENCIES.items())
    month, currency = given.MISSING_RATE
    return f"""months AS (
  SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS rate_month, CAST(date_trunc('month', o_orderdate) AS DATE)
    AS month_start FROM orders WHERE o_orderdate IS NOT NULL),
fx AS (SELECT * FROM ({rows}) WHERE NOT (rate_month = '{month}' AND currency_code = '{currency}'))"""


def _cte_silver() -> str:
    columns = ", ".join(f"b.{n}" for n in _NAMES)
    rate = """CASE WHEN target_credit_default THEN 1.00 WHEN delinquency_status = 'M0' THEN 0.01
      WHEN delinquency_status = 'M1' THEN 0.02 WHEN delinquency_status = 'M2' THEN 0.10
      WHEN delinquency_status = 'M3' THEN 0.50 WHEN delinquency_status = 'M4+' THEN 1.00 ELSE 0.01 END"""
    return f"""joined AS (
  SELECT {columns}, fx.rate, strftime(b.txn_timestamp, '%Y-%m') AS txn_month, {rate} AS p
  FROM bronze b JOIN fx ON strftime(b.txn_timestamp, '%Y-%m') = fx.rate_month AND b.txn_currency = fx.currency_code
  WHERE b.orig_balance_after > 0),
silver AS (
  SELECT {", ".join(_NAMES)}, txn_month, CAST(rate AS DECIMAL(10,4)) AS fx_rate_to_thb,
    CAST(round(txn_amount_usd * rate, 2) AS DECIMAL(14,2)) AS txn_amount_thb,
    CAST(round(orig_balance_after * rate, 2) AS DECIMAL(14,2)) AS orig_balance_thb,
    CASE WHEN delinquency_status = 'M0' THEN 'Performing'
      WHEN delinquency_status IN ('M1', 'M2', 'M3') THEN 'Under-Performing'
      WHEN delinquency_status = 'M4+' OR target_credit_default THEN 'NPL' ELSE 'Unknown' END AS loan_status,
    CAST(p AS DECIMAL(5,4)) AS provision_rate,
    CAST(round(orig_balance_after * rate * CAST(p AS DECIMAL(3,2)), 2) AS DECIMAL(14,2)) AS provision_amount_thb
  FROM joined)"""


def _money(column: str, status: str | None = None) -> str:
    where = f" FILTER (WHERE loan_status = '{status}')" if status else ""
    return f"CAST(sum({column}){where} AS DECIMAL(20,2))"


def _ratio(part: str, whole: str) -> str:
    return f"CAST(round(CAST({part} * 100 AS DOUBLE) / nullif({whole}, 0), 4) AS DECIMAL(8,4))"


_GOLD_COLUMNS = """report_month, total_accounts, outstanding_balance_thb, npl_accounts, npl_ratio_pct,
  total_provision_thb, performing_accounts, performing_balance_thb, performing_provision_thb,
  under_performing_accounts, under_performing_balance_thb, under_performing_provision_thb, npl_balance_thb,
  npl_provision_thb"""
_GOLD_LISTING = ("report_month, total_accounts, outstanding_balance_thb, npl_accounts, npl_ratio_pct, "
                 "total_provision_thb")


def _cte_gold() -> str:
    parts = []
    for prefix, status in (("performing", "Performing"), ("under_performing", "Under-Performing"), ("npl", "NPL")):
        parts += [f"count(*) FILTER (WHERE loan_status = '{status}') AS {prefix}_accounts",
                  f"{_money('orig_balance_thb', status)} AS {prefix}_balance_thb",
                  f"{_money('provision_amount_thb', status)} AS {prefix}_provision_thb"]
    return f"""summary AS (
  SELECT txn_month AS report_month, count(*) AS total_accounts, {_money('orig_balance_thb')} AS outstanding_balance_thb,
    {_money('provision_amount_thb')} AS total_provision_thb, {", ".join(parts)}
  FROM silver GROUP BY txn_month),
gold AS (SELECT *, {_ratio('npl_accounts', 'total_accounts')} AS npl_ratio_pct FROM summary)"""


def _spoilt(table: str, changes: dict[str, str]) -> str:
    types = {"fx_rate_to_thb": "DECIMAL(10,4)", "orig_balance_thb": "DECIMAL(14,2)", "provision_rate": "DECIMAL(5,4)",
             "outstanding_balance_thb": "DECIMAL(20,2)", "total_provision_thb": "DECIMAL(20,2)",
             "npl_ratio_pct": "DECIMAL(8,4)"}
    replaced = ", ".join(f"CAST({sql} AS {types[c]}) AS {c}" if c in types else f"{sql} AS {c}" for c, sql in changes.items())
    return f"SELECT * REPLACE ({replaced}) FROM {table}"


def _cte_spoilt() -> str:
    return f"""bad_silver AS (
  {_spoilt('silver', given.SPOILT_SILVER)}
  UNION ALL {_spoilt('silver', given.SPOILT_SILVER)} WHERE {given.REPEATED_SILVER}),
bad_gold AS (SELECT * FROM ({_spoilt('gold', given.SPOILT_GOLD)}) WHERE NOT ({given.LOST_MONTH}))"""


def _cte_runs() -> str:
    branches = " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(STAGES))
    return f"""steps AS (
  SELECT event_id AS run_id, 'full_pipeline' AS pipeline_name,
    CASE event_id % {len(STAGES)} {branches} END AS step_name,
    CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'RUNNING' ELSE 'SUCCESS' END AS status,
    ts AS started_at, CAST(value AS DECIMAL(10,2)) AS seconds, user_id, props FROM events),
runs AS (
  SELECT run_id, pipeline_name, step_name, status, started_at,
    CASE WHEN status <> 'RUNNING' THEN started_at + to_microseconds(CAST(seconds * 1000000 AS BIGINT)) END
      AS finished_at,
    CASE WHEN status <> 'RUNNING' THEN seconds END AS duration_sec,
    CASE WHEN status <> 'RUNNING' THEN user_id END AS rows_processed,
    CASE WHEN status = 'FAILED' THEN props END AS error_message, CAST(started_at AS DATE) AS run_date FROM steps)"""


_TO_RAW = [_cte_raw]
_TO_JUDGED = [*_TO_RAW, _cte_judged]
_TO_BRONZE = [*_TO_JUDGED, _cte_bronze]
_TO_QUARANTINE = [*_TO_JUDGED, _cte_quarantine]
_TO_SILVER = [*_TO_BRONZE, _cte_fx, _cte_silver]
_TO_GOLD = [*_TO_SILVER, _cte_gold]


def _sql(ctes: list, select: str) -> str:
    return "WITH " + ",\n".join(cte() for cte in ctes) + "\n" + select


def _check(name: str, layer: str, table: str, condition: str) -> str:
    return (f"SELECT '{name}' AS check_name, '{layer}' AS layer, "
            f"CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, count(*) AS failed_count, "
            f"'{quality.DETAILS[name]}' AS detail FROM {table} WHERE {condition}")


_DQ = {
    "dq_null_check": _check(
        "silver_null_check", "silver", "silver",
        "cust_id IS NULL OR txn_id IS NULL OR orig_balance_thb IS NULL OR loan_status IS NULL "
        "OR provision_amount_thb IS NULL"),
    "dq_duplicate_txn": _check(
        "silver_duplicate_txn", "silver", "(SELECT txn_id FROM silver GROUP BY txn_id HAVING count(*) > 1)", "true"),
    "dq_fx_rate_positive": _check(
        "silver_fx_rate_positive", "silver", "silver", "fx_rate_to_thb <= 0 OR fx_rate_to_thb IS NULL"),
    "dq_balance_positive": _check(
        "silver_balance_positive", "silver", "silver", "orig_balance_thb <= 0"),
    "dq_loan_status_valid": _check(
        "silver_loan_status_valid", "silver", "silver",
        "loan_status NOT IN ('Performing', 'Under-Performing', 'NPL')"),
    "dq_default_provision_rate": _check(
        "silver_default_provision_rate", "silver", "silver", "target_credit_default AND provision_rate <> 1.00"),
    "dq_default_loan_status": _check(
        "silver_default_loan_status", "silver", "silver", "target_credit_default AND loan_status <> 'NPL'"),
    "dq_npl_ratio_range": _check(
        "gold_npl_ratio_range", "gold", "gold", "npl_ratio_pct < 0 OR npl_ratio_pct > 100"),
    "dq_provision_vs_balance": _check(
        "gold_provision_not_exceed_balance", "gold", "gold", "total_provision_thb > outstanding_balance_thb"),
    "dq_monthly_completeness":
        "SELECT 'gold_monthly_completeness' AS check_name, 'gold' AS layer, "
        "CASE WHEN count(*) = 12 THEN 'PASS' ELSE 'FAIL' END AS status, 12 - count(*) AS failed_count, "
        f"concat('{quality.COMPLETENESS_DETAIL[0]}', count(*), '{quality.COMPLETENESS_DETAIL[1]}12{quality.COMPLETENESS_DETAIL[2]}') "
        "AS detail "
        f"FROM gold WHERE report_month LIKE '{CHECKED_YEAR}-%'",
}


def _recon(name: str, source: str, target: str, tolerance: str) -> str:
    return (f"SELECT '{name}' AS check_name, s AS source_value, t AS target_value, "
            f"CAST(s - t AS DECIMAL(22,2)) AS difference, "
            f"CASE WHEN abs(s - t) <= {tolerance} THEN 'PASS' ELSE 'FAIL' END AS status, '{reconcile.DETAILS[name]}' AS detail "
            f"FROM (SELECT CAST(({source}) AS DECIMAL(22,2)) AS s, CAST(({target}) AS DECIMAL(22,2)) AS t)")


_RECON = {
    "recon_count_bronze_silver": _recon(
        "count_bronze_to_silver", "SELECT count(*) FROM bronze WHERE orig_balance_after > 0",
        "SELECT count(*) FROM silver", "0"),
    "recon_count_silver_gold": _recon(
        "count_silver_to_gold", "SELECT count(*) FROM silver", "SELECT coalesce(sum(total_accounts), 0) FROM gold",
        "0"),
    "recon_balance": _recon(
        "amount_balance_silver_vs_gold", "SELECT coalesce(sum(orig_balance_thb), 0) FROM silver",
        "SELECT coalesce(sum(outstanding_balance_thb), 0) FROM gold", "1.00"),
    "recon_provision": _recon(
        "amount_provision_silver_vs_gold", "SELECT coalesce(sum(provision_amount_thb), 0) FROM silver",
        "SELECT coalesce(sum(total_provision_thb), 0) FROM gold", "1.00"),
    "recon_npl_count": _recon(
        "count_npl_silver_vs_gold", "SELECT count(*) FROM silver WHERE loan_status = 'NPL'",
        "SELECT coalesce(sum(npl_accounts), 0) FROM gold", "0"),
}


def _npl_by(dimension: str) -> str:
    npl = "count(*) FILTER (WHERE loan_status = 'NPL')"
    return (f"SELECT {dimension}, {npl} AS npl_accounts, count(*) AS total_accounts, "
            f"{_ratio(npl, 'count(*)')} AS npl_ratio_pct, {_money('orig_balance_thb', 'NPL')} AS npl_balance_thb "
            f"FROM silver GROUP BY {dimension}")


def _constraints(table: str, conditions: dict[str, str], key: str | None = None) -> str:
    parts = [f"SELECT '{name}' AS rule, count(*) FILTER ({broken}) AS broken FROM {table}" for name, broken in conditions.items()]
    if key:
        parts.append(f"SELECT '{key} not unique', count(*) FROM (SELECT {key} FROM {table} GROUP BY {key} HAVING count(*) > 1)")
    return f"SELECT *, CASE broken WHEN 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({' UNION ALL '.join(parts)})"


def _sums() -> str:
    sets = ["txn_month", "primary_branch_region", "account_type", "delinquency_status, loan_status, provision_rate"]
    names = " ".join(f"WHEN GROUPING({s.split(',')[0]}) = 0 THEN '{s.split(',')[0]}'" for s in sets)
    provisions = ", ".join(f"{_money('provision_amount_thb', status)} AS {prefix}_provision_thb" for prefix, status in (
        ("performing", "Performing"), ("under_performing", "Under-Performing"), ("npl", "NPL")))
    return f"""SELECT {", ".join(sets)}, CASE {names} END AS report,
  count(*) FILTER (WHERE loan_status = 'NPL') AS npl_accounts, count(*) AS total_accounts,
  {_money('orig_balance_thb', 'NPL')} AS npl_balance_thb, {provisions}, {_money('orig_balance_thb')} AS total_balance_thb,
  {_money('provision_amount_thb')} AS total_provision_thb
FROM silver GROUP BY GROUPING SETS ({", ".join(f"({s})" for s in sets)})"""


_SUMMARY = (f"SELECT {_GOLD_LISTING}, CAST(round(CAST(total_provision_thb * 100 AS DOUBLE) / "
            "nullif(outstanding_balance_thb, 0), 4) AS DECIMAL(12,4)) AS provision_coverage_pct "
            "FROM gold ORDER BY report_month")


def build() -> dict[str, str]:
    """Query name -> SQL."""
    queries = {
        "ingest_transactions": _sql(_TO_RAW, "SELECT * EXCLUDE (seq) FROM raw"),
        "ingest_fx_rates": _sql([_cte_fx], f"""SELECT rate_month, currency_code, CAST(rate AS VARCHAR) AS rate_to_thb,
  'bank' AS source, '{given.LOADED_AT}' AS _loaded_at, 'fx_rate.csv' AS _source_file FROM fx"""),
        "ingest_lineage": _sql(_TO_RAW, "SELECT txn_id, _loaded_at, _source_file, seq AS _load_seq FROM raw"),
        "ingest_row_count_check": _sql(_TO_RAW, """SELECT s AS source_rows, t AS stored_rows,
  CASE WHEN s = t THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT (SELECT count(*) FROM orders) AS s, (SELECT count(*) FROM raw) AS t)"""),
        "bronze_transactions": _sql(_TO_BRONZE, "SELECT * FROM bronze"),
        "bronze_dedup": _sql(_TO_BRONZE, "SELECT txn_id, txn_timestamp, txn_amount_usd, account_id FROM bronze"),
        "bronze_delinquency": _sql(
            _TO_BRONZE, "SELECT txn_id, target_credit_default, delinquency_status FROM bronze"),
        "bronze_quarantine": _sql(_TO_QUARANTINE, "SELECT * FROM quarantine"),
        "bronze_split_counts": _sql(_TO_BRONZE, """SELECT
  (SELECT count(*) FROM good) AS good_rows, (SELECT count(*) FROM judged WHERE fail IS NOT NULL) AS quarantined_rows,
  (SELECT count(*) FROM good WHERE copy > 1) AS duplicate_rows, (SELECT count(*) FROM bronze) AS bronze_rows"""),
        "silver_loan_accounts": _sql(_TO_SILVER, "SELECT * FROM silver"),
        "silver_fx_join": _sql(_TO_SILVER, "SELECT txn_id, orig_balance_after, rate AS rate_to_thb FROM joined"),
        "silver_loan_status": _sql(
            _TO_SILVER, "SELECT txn_id, delinquency_status, target_credit_default, loan_status FROM silver"),
        "silver_provision": _sql(
            _TO_SILVER, "SELECT txn_id, orig_balance_thb, provision_rate, provision_amount_thb FROM silver"),
        "silver_unmatched_fx": _sql([*_TO_BRONZE, _cte_fx], """SELECT txn_id,
  strftime(txn_timestamp, '%Y-%m') AS txn_month, txn_currency, orig_balance_after FROM bronze b
WHERE orig_balance_after > 0 AND NOT EXISTS (SELECT 1 FROM fx WHERE fx.currency_code = b.txn_currency
  AND fx.rate_month = strftime(b.txn_timestamp, '%Y-%m'))"""),
        "silver_status_distribution": _sql(
            _TO_SILVER, "SELECT loan_status, count(*) AS total FROM silver GROUP BY loan_status"),
        "silver_provision_summary": _sql(_TO_SILVER, """SELECT delinquency_status, loan_status, provision_rate,
  CAST(round(avg(orig_balance_thb), 2) AS DECIMAL(20,2)) AS avg_balance_thb,
  CAST(round(avg(provision_amount_thb), 2) AS DECIMAL(20,2)) AS avg_provision_thb, count(*) AS total
FROM silver GROUP BY delinquency_status, loan_status, provision_rate"""),
        "silver_npl_accounts": _sql(_TO_SILVER, """SELECT cust_id, txn_id, loan_status, orig_balance_thb,
  provision_amount_thb FROM silver WHERE loan_status = 'NPL'"""),
        "silver_monthly_totals": _sql(_TO_SILVER, f"""SELECT strftime(txn_timestamp, '%Y-%m') AS txn_month,
  count(*) AS total, {_money('orig_balance_thb')} AS total_balance FROM silver GROUP BY 1"""),
        "gold_monthly_report": _sql(_TO_GOLD, f"SELECT {_GOLD_COLUMNS} FROM gold ORDER BY report_month"),
        "gold_kpi_listing": _sql(_TO_GOLD, f"SELECT {_GOLD_LISTING} FROM gold ORDER BY report_month"),
        "gold_period_totals": _sql(_TO_GOLD, f"""SELECT CAST(sum(total_accounts) AS BIGINT) AS total_accounts,
  {_money('outstanding_balance_thb')} AS total_balance, CAST(sum(npl_accounts) AS BIGINT) AS total_npl,
  {_money('total_provision_thb')} AS total_provision,
  {_ratio('sum(npl_accounts)', 'sum(total_accounts)')} AS avg_npl_ratio FROM gold"""),
        "dq_results": _sql(_TO_GOLD, "\nUNION ALL\n".join(_DQ.values()) + "\nORDER BY layer, check_name"),
        "recon_results": _sql(_TO_GOLD, "\nUNION ALL\n".join(_RECON.values()) + "\nORDER BY check_name"),
        "report_credit_risk_summary": _sql(_TO_GOLD, _SUMMARY),
        "report_npl_monthly": _sql(_TO_SILVER, _npl_by("txn_month")),
        "report_npl_by_region": _sql(_TO_SILVER, _npl_by("primary_branch_region")),
        "report_npl_by_account_type": _sql(_TO_SILVER, _npl_by("account_type")),
        "report_provision_monthly": _sql(_TO_SILVER, f"""SELECT txn_month,
  {_money('provision_amount_thb', 'Performing')} AS performing_provision_thb,
  {_money('provision_amount_thb', 'Under-Performing')} AS under_performing_provision_thb,
  {_money('provision_amount_thb', 'NPL')} AS npl_provision_thb,
  {_money('provision_amount_thb')} AS total_provision_thb FROM silver GROUP BY txn_month"""),
        "report_provision_by_delinquency": _sql(_TO_SILVER, f"""SELECT delinquency_status, loan_status,
  CAST(round(provision_rate * 100, 0) AS DECIMAL(5,0)) AS provision_rate_pct, count(*) AS total_accounts,
  {_money('orig_balance_thb')} AS total_balance_thb, {_money('provision_amount_thb')} AS total_provision_thb
FROM silver GROUP BY delinquency_status, loan_status, provision_rate"""),
        "report_sums": _sql(_TO_SILVER, _sums()),
        "constraints_bronze": _sql(_TO_BRONZE, _constraints("bronze", {"txn_id is null": "txn_id IS NULL"}, "txn_id")),
        "constraints_silver": _sql(_TO_SILVER, _constraints("silver", {"txn_id is null": "txn_id IS NULL"}, "txn_id")),
        "constraints_silver_spoilt": _sql([*_TO_GOLD, _cte_spoilt], _constraints(
            "bad_silver", {"txn_id is null": "txn_id IS NULL"}, "txn_id")),
        "constraints_gold": _sql(_TO_GOLD, _constraints(
            "gold", {"report_month is null": "report_month IS NULL"}, "report_month")),
        "constraints_run_log": _sql([_cte_runs], _constraints("runs", {
            **{f"{c} is null": f"{c} IS NULL" for c in (
                "run_id", "pipeline_name", "step_name", "status", "started_at", "run_date")},
            "status is not one of RUNNING, SUCCESS, FAILED": "status NOT IN ('RUNNING', 'SUCCESS', 'FAILED')"})),
        "report_preview": _sql(_TO_GOLD, _SUMMARY + " LIMIT 5"),
        "diag_recent_runs": _sql([_cte_runs], """SELECT run_id, pipeline_name, step_name, status, started_at,
  finished_at, duration_sec, rows_processed, error_message FROM runs ORDER BY run_id DESC LIMIT 10"""),
        "diag_failed_steps": _sql([_cte_runs], """SELECT run_id, step_name, started_at, error_message FROM runs
WHERE status = 'FAILED' ORDER BY run_id DESC"""),
        "diag_recent_failures": _sql([_cte_runs], """SELECT run_id, step_name, started_at, error_message FROM runs
WHERE status = 'FAILED' ORDER BY run_id DESC LIMIT 5"""),
        "diag_step_durations": _sql([_cte_runs], """SELECT step_name, count(*) AS total_runs,
  CAST(round(avg(duration_sec), 2) AS DECIMAL(10,2)) AS avg_duration_sec, max(duration_sec) AS max_duration_sec,
  min(duration_sec) AS min_duration_sec FROM runs WHERE status = 'SUCCESS' GROUP BY step_name"""),
        "diag_raw_profile": _sql(_TO_RAW, """SELECT count(*) AS total_rows,
  count(DISTINCT cust_id) AS unique_customers, count(DISTINCT txn_id) AS unique_transactions,
  min(_loaded_at) AS first_loaded, max(_loaded_at) AS last_loaded FROM raw"""),
        "diag_fx_coverage": _sql([_cte_fx], """SELECT rate_month, count(DISTINCT currency_code) AS currency_count,
  string_agg(currency_code, ', ' ORDER BY currency_code) AS currencies FROM fx GROUP BY rate_month"""),
        "diag_bronze_counts": _sql([*_TO_BRONZE, _cte_quarantine], """SELECT
  'bronze.financial_transactions' AS table_name, count(*) AS row_count FROM bronze
UNION ALL SELECT 'bronze.quarantine_log', count(*) FROM quarantine"""),
        "diag_recent_quarantine": _sql(_TO_QUARANTINE, """SELECT cust_id, txn_id, failed_column, failed_value,
  failure_reason, quarantined_at FROM quarantine ORDER BY quarantined_at DESC, quarantine_id LIMIT 20"""),
        "diag_delinquency_distribution": _sql(
            _TO_BRONZE, "SELECT delinquency_status, count(*) AS row_count FROM bronze GROUP BY delinquency_status"),
        "diag_silver_nulls": _sql(_TO_SILVER, """SELECT count(*) AS total_rows,
  count(*) FILTER (WHERE cust_id IS NULL) AS null_cust_id,
  count(*) FILTER (WHERE orig_balance_thb IS NULL) AS null_balance,
  count(*) FILTER (WHERE loan_status IS NULL) AS null_loan_status,
  count(*) FILTER (WHERE provision_amount_thb IS NULL) AS null_provision,
  count(*) FILTER (WHERE fx_rate_to_thb IS NULL) AS null_fx_rate FROM silver"""),
        "diag_status_totals": _sql(_TO_SILVER, f"""SELECT loan_status, count(*) AS accounts,
  {_money('orig_balance_thb')} AS total_balance_thb, {_money('provision_amount_thb')} AS total_provision_thb
FROM silver GROUP BY loan_status"""),
        "diag_fx_used": _sql(_TO_SILVER, """SELECT txn_currency, txn_month, fx_rate_to_thb,
  count(*) AS transaction_count FROM silver GROUP BY txn_currency, txn_month, fx_rate_to_thb"""),
        "diag_quick_recon": _sql(_TO_GOLD, f"""SELECT 'silver_total_accounts' AS metric,
  CAST(count(*) AS VARCHAR) AS value FROM silver
UNION ALL SELECT 'gold_sum_total_accounts', CAST(coalesce(sum(total_accounts), 0) AS VARCHAR) FROM gold
UNION ALL SELECT 'silver_total_balance_thb', CAST({_money('orig_balance_thb')} AS VARCHAR) FROM silver
UNION ALL SELECT 'gold_sum_outstanding_balance_thb',
  CAST({_money('outstanding_balance_thb')} AS VARCHAR) FROM gold"""),
        "diag_quarantine_reasons": _sql(_TO_QUARANTINE, """SELECT failed_column, failure_reason,
  count(*) AS row_count FROM quarantine GROUP BY failed_column, failure_reason"""),
        "diag_layer_counts": _sql(_TO_GOLD, """SELECT
  (SELECT count(*) FROM bronze WHERE orig_balance_after > 0) AS bronze_count,
  (SELECT count(*) FROM silver) AS silver_count,
  (SELECT CAST(coalesce(sum(total_accounts), 0) AS BIGINT) FROM gold) AS gold_count"""),
        "diag_rate_by_delinquency": _sql(_TO_SILVER, """SELECT delinquency_status, provision_rate,
  count(*) AS row_count FROM silver GROUP BY delinquency_status, provision_rate"""),
        "diag_default_audit": _sql(_TO_SILVER, """SELECT delinquency_status, target_credit_default, provision_rate,
  loan_status, count(*) AS row_count FROM silver WHERE target_credit_default
GROUP BY delinquency_status, target_credit_default, provision_rate, loan_status"""),
        "runlog_current": _sql([_cte_runs], "SELECT * FROM runs"),
        "runlog_recent": _sql([_cte_runs], f"""SELECT run_date, pipeline_name, step_name, status, duration_sec,
  rows_processed, error_message FROM runs WHERE run_date >= DATE '{given.RUN_LOG_AS_OF}' - INTERVAL 7 DAY
ORDER BY run_id DESC LIMIT 50"""),
        "rule_npl_alert": _sql(_TO_GOLD, """SELECT report_month, npl_ratio_pct, CASE WHEN npl_ratio_pct < 3
  THEN 'normal' WHEN npl_ratio_pct <= 5 THEN 'watch' WHEN npl_ratio_pct > 5 THEN 'critical' END AS alert_level
FROM gold"""),
        "rule_fx_complete": _sql([*_TO_BRONZE, _cte_fx], """SELECT strftime(txn_timestamp, '%Y-%m') AS txn_month,
  txn_currency, count(*) AS row_count FROM bronze b
WHERE orig_balance_after > 0 AND NOT EXISTS (SELECT 1 FROM fx WHERE fx.currency_code = b.txn_currency
  AND fx.rate_month = strftime(b.txn_timestamp, '%Y-%m')) GROUP BY 1, 2"""),
        "rule_month_end_snapshot": _sql(_TO_SILVER, """SELECT account_id, txn_month, txn_id, txn_timestamp,
  orig_balance_thb, loan_status FROM silver QUALIFY row_number() OVER (
  PARTITION BY account_id, txn_month ORDER BY txn_timestamp DESC, txn_id DESC) = 1"""),
        "rule_npl_anomaly": _sql(
            _TO_GOLD, "SELECT report_month, total_accounts, npl_accounts, npl_ratio_pct FROM gold "
            "WHERE npl_ratio_pct > 20"),
    }
    # The same checks over the spoilt layers: each of them fails there.
    def spoilt(sql: str) -> str:
        return sql.replace("FROM silver", "FROM bad_silver").replace("FROM gold", "FROM bad_gold")
    to_spoilt = [*_TO_GOLD, _cte_spoilt]
    queries["dq_results_spoilt"] = _sql(to_spoilt, "\nUNION ALL\n".join(map(spoilt, _DQ.values())) + "\nORDER BY layer, check_name")
    queries["recon_results_spoilt"] = _sql(to_spoilt, "\nUNION ALL\n".join(map(spoilt, _RECON.values())) + "\nORDER BY check_name")
    queries["rule_npl_anomaly_critical"] = _sql(
        _TO_GOLD, "SELECT report_month, total_accounts, npl_accounts, npl_ratio_pct FROM gold WHERE npl_ratio_pct > 5")
    queries.update({name: _sql(_TO_GOLD, sql) for name, sql in {**_DQ, **_RECON}.items()})
    return queries
