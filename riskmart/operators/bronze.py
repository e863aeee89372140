"""Raw text to typed rows: convert, set bad rows aside with a reason, keep the first row per transaction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions import convert
from riskmart.operators import firsts
from riskmart.spec import DELINQUENCY_CODES, KEY, LOAD_SEQ, TRANSACTION_COLUMNS, TRANSACTION_SPEC, ColumnSpec

RULE = "_rule"
REJECT = "_reject"
_TASK = "_task"
_TEXT = "_text_"

# A broken rule is numbered 100 * class + column position, in judging order: conversions in column order first, then
# the delinquency code, then what a typed table refuses. The first broken rule counts.
_CLASS = 100
_UNKNOWN_CODE, _OUT_OF_RANGE, _NULL_KEY = 1, 2, 3


def broken_rule(spec: list[ColumnSpec] = TRANSACTION_SPEC) -> str:
    """SQL for the number of the first broken rule of a row, NULL for a good row; over texts and typed values."""
    position = {c.name: i for i, c in enumerate(spec, 1)}
    delinquency = _TEXT + "delinquency_status"
    conversions, ranges = [], []
    for c in spec:
        if c.kind == "text":
            continue
        unreadable = f"{_TEXT}{c.name} <> '' and {c.name} is null"
        form = convert.number_form(c, _TEXT + c.name)
        if form:
            conversions.append((position[c.name], f"{unreadable} and not {form}"))
            ranges.append((_OUT_OF_RANGE * _CLASS + position[c.name], unreadable))
        else:
            conversions.append((position[c.name], unreadable))
    known = convert.text_list(list(DELINQUENCY_CODES))
    rules = [
        *conversions,
        (_UNKNOWN_CODE * _CLASS + position["delinquency_status"],
         f"{delinquency} is null or {delinquency} not in ({known})"),
        *ranges,
        (_NULL_KEY * _CLASS + position[KEY], f"{KEY} is null"),
    ]
    return "case " + " ".join(f"when {condition} then {number}" for number, condition in rules) + " end"


def _reason(spec: list[ColumnSpec]) -> str:
    """SQL for the reason code of a broken rule."""
    by_column = convert.text_list([convert.REASONS.get(c.kind, "") for c in spec])
    return (f"case {RULE} div {_CLASS} when 0 then element_at(array({by_column}), {RULE}) "
            f"when {_UNKNOWN_CODE} then 'UNKNOWN_DELINQUENCY' when {_OUT_OF_RANGE} then 'OUT_OF_RANGE' "
            f"else 'NULL_KEY' end")


def judge(raw: DataFrame, spec: list[ColumnSpec] = TRANSACTION_SPEC) -> DataFrame:
    """Type every column and judge every row.

    Gives the typed columns, `_load_seq`, `_rule` (number of the broken rule, NULL for a good row), `_reject` (what
    quarantine keeps of the row, NULL for a good row) and `_task`. Column-wise work only: no shuffle, no Python. Each
    text is converted once. A column that the source lacks is NULL in every row.
    """
    present = set(raw.columns)
    names = [c.name for c in spec]
    extra = [c for c in raw.columns if c not in names and c != LOAD_SEQ]
    texts = raw.selectExpr(
        *[f"{n if n in present else 'cast(null as string)'} as {_TEXT}{n}" for n in names],
        *[f"`{n}`" for n in extra], LOAD_SEQ)
    values = texts.selectExpr("*", *[f"{convert.typed(c, _TEXT + c.name)} as {c.name}" for c in spec])

    code = convert.delinquency_code(_TEXT + "delinquency_status", "target_credit_default")
    typed = [f"{code} as {n}" if n == "delinquency_status" else n for n in names]
    ruled = values.selectExpr(*typed, *[_TEXT + n for n in names], *[f"`{n}`" for n in extra], LOAD_SEQ,
                              f"{broken_rule(spec)} as {RULE}", f"spark_partition_id() as {_TASK}")

    row = ", ".join([f"'{n}', {_TEXT}{n}" for n in names if n in present] + [f"'{n}', `{n}`" for n in extra])
    reject = f"""case when {RULE} is not null then named_struct(
        'cust_id', {_TEXT}cust_id,
        'txn_id', {_TEXT}txn_id,
        'failed_column', element_at(array({convert.text_list(names)}), {RULE} % {_CLASS}),
        'failed_value', element_at(array({", ".join(_TEXT + n for n in names)}), {RULE} % {_CLASS}),
        'failure_reason', {_reason(spec)},
        'raw_row_data', to_json(named_struct({row}), map('ignoreNullFields', 'false'))) end as {REJECT}"""
    return ruled.selectExpr(*names, LOAD_SEQ, RULE, reject, _TASK)


def _where(judged: DataFrame, condition: str) -> DataFrame:
    """Filter judged rows above the judging.

    Catalyst would push the filter below and convert every text in both places. It does not move a filter past a
    projection that gives the number of the task, so the condition names it; a stored table has no such column.
    """
    return judged.where(f"{condition} and {_TASK} >= 0" if _TASK in judged.columns else condition)


def passed(judged: DataFrame) -> DataFrame:
    """The good rows: typed columns and `_load_seq`, copies of a transaction still in."""
    return _where(judged, f"{RULE} is null").drop(RULE, REJECT, _TASK)


def good(judged: DataFrame) -> DataFrame:
    """Bronze: the 50 typed columns, one row per transaction, the first good one that was loaded.

    Bad rows leave first, so a bad first copy does not block a later good one. Spark keeps one row per key and task
    before it shuffles (a window group limit), so a key with very many copies sends at most one row per task. For
    queries that ask for few columns; `build` and `without_copies` are for all of them.
    """
    return firsts.by_window(passed(judged), [KEY], [F.col(LOAD_SEQ)]).drop(LOAD_SEQ)


def build(raw: DataFrame) -> DataFrame:
    """The same rows as `good(judge(raw))` by a plan for all 50 columns: rows whose transaction has no copy in the raw
    layer are judged without a shuffle. Each row is judged once."""
    found = firsts.first_rows(raw, [KEY], [F.col(LOAD_SEQ)], lambda rows: passed(judge(rows)))
    return found.selectExpr(*TRANSACTION_COLUMNS)


def without_copies(good_rows: DataFrame) -> DataFrame:
    """The same for stored good rows (see `passed`)."""
    return firsts.first_rows(good_rows, [KEY], [F.col(LOAD_SEQ)]).selectExpr(*TRANSACTION_COLUMNS)


def quarantine(judged: DataFrame, quarantined_at: str) -> DataFrame:
    """Rejected rows with the first failing column, its text, a reason code and the whole raw row as JSON."""
    bad = _where(judged, f"{RULE} is not null")
    # The id is a digest of the row's key and load position: repeatable, and needs no global counter.
    row_id = F.md5(F.concat_ws("|", F.col(f"{REJECT}.txn_id"), _as_text(judged, LOAD_SEQ)))
    return bad.select(row_id.alias("quarantine_id"), f"{REJECT}.*",
                      F.lit(quarantined_at).cast("timestamp_ntz").alias("quarantined_at"))


def _as_text(df: DataFrame, column: str):
    nested = df.schema[column].dataType.simpleString().startswith("struct")
    return F.to_json(column) if nested else F.col(column).cast("string")


def split_counts(judged: DataFrame) -> DataFrame:
    """One row: good rows, quarantined rows, later copies among the good rows, rows kept in Bronze."""
    per_key = (judged.groupBy(F.when(F.col(RULE).isNull(), F.col(KEY)).alias("_key"), F.col(RULE).isNull().alias("_ok"))
               .agg(F.count(F.lit(1)).alias("rows")))
    ok = F.col("_ok")
    return per_key.agg(
        F.coalesce(F.sum(F.when(ok, F.col("rows"))), F.lit(0)).alias("good_rows"),
        F.coalesce(F.sum(F.when(~ok, F.col("rows"))), F.lit(0)).alias("quarantined_rows"),
        F.coalesce(F.sum(F.when(ok, F.col("rows") - 1)), F.lit(0)).alias("duplicate_rows"),
        F.count_if(ok).alias("bronze_rows"))

