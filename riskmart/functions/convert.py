"""Text to typed value, as SQL expressions that Catalyst compiles.

Every converter gives NULL for a missing text (NULL or '') and NULL for a text it cannot read; the text
tells the two apart. `try_cast` alone is not strict enough for dates and times (it also reads
`2024-01` or a `T` separator), so their form is checked first. None of the expressions depends on the session's ANSI
mode or time zone.

Differences from a Python reader, all of which end in quarantine: `1_000`, `inf`, `nan` and digits outside ASCII in
integers are not numbers here.
"""

from __future__ import annotations

from riskmart.spec import DEFAULT_CODE, DELINQUENCY_CODES, ColumnSpec

# The accepted texts and forms.
TRUE_TEXTS = ["True", "true", "1"]
FALSE_TEXTS = ["False", "false", "0"]
DATE_FORM = r"^(?!0000)\d{4}-\d{1,2}-\d{1,2}\z"
TIMESTAMP_FORM = r"^(?!0000)\d{4}-\d{1,2}-\d{1,2}\s+\d{1,2}:\d{1,2}:\d{1,2}\z"
INT_FORM = r"^\s*[+-]?\d+\s*\z"
DECIMAL_FORM = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*\z"

REASONS = {
    "int": "INVALID_INT",
    "decimal": "INVALID_DECIMAL",
    "boolean": "INVALID_BOOLEAN",
    "date": "INVALID_DATE",
    "timestamp": "INVALID_TIMESTAMP",
}


def text_list(texts: list[str]) -> str:
    """The texts as a SQL list of literals."""
    return ", ".join("'" + t.replace("'", "\\'") + "'" for t in texts)


def typed(column: ColumnSpec, text: str) -> str:
    """The value of `text` (a column name) in the type of `column`."""
    if column.kind == "text":
        return f"nullif({text}, '')"
    if column.kind == "boolean":
        return (f"case when {text} in ({text_list(TRUE_TEXTS)}) then true "
                f"when {text} in ({text_list(FALSE_TEXTS)}) then false end")
    if column.kind == "date":
        return f"case when {text} rlike r'{DATE_FORM}' then try_cast({text} as date) end"
    if column.kind == "timestamp":
        # Most texts have one blank; only the others pay for collapsing them.
        return (f"case when {text} rlike r'{TIMESTAMP_FORM}' then coalesce(try_cast({text} as timestamp_ntz), "
                f"try_cast(regexp_replace({text}, r'\\s+', ' ') as timestamp_ntz)) end")
    return f"try_cast(nullif({text}, '') as {column.sql_type})"


def number_form(column: ColumnSpec, text: str) -> str | None:
    """True where `text` is written as a number of the column's kind, whatever its size; None for other kinds."""
    forms = {"int": INT_FORM, "decimal": DECIMAL_FORM}
    return f"{text} rlike r'{forms[column.kind]}'" if column.kind in forms else None


def delinquency_code(text: str, in_default: str) -> str:
    """Standard code of a source text: default lifts any known text, unknown or blank text gives NULL."""
    codes = " ".join(f"when '{source}' then '{code}'" for source, code in DELINQUENCY_CODES.items())
    known = text_list(list(DELINQUENCY_CODES))
    return f"case when {in_default} and {text} in ({known}) then '{DEFAULT_CODE}' else case {text} {codes} end end"
