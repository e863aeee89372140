"""Declared constraints of the layer tables, checked on the write, before a table is published.

Conditions on rows are counted while the rows are written; a unique key costs one aggregate over the key columns as
stored. A table that breaks a constraint stays unpublished, so readers keep what they had.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.operators.runlog import FAILED, RUNNING, SUCCESS
from riskmart.sources import tables
from riskmart.sources.landing import repeated_keys


@dataclass(frozen=True)
class NotNull:
    column: str

    @property
    def broken(self) -> Column:
        return F.col(self.column).isNull()

    def __str__(self) -> str:
        return f"{self.column} is null"


@dataclass(frozen=True)
class OneOf:
    """A column has one of the values, or none."""

    column: str
    values: tuple[str, ...]

    @property
    def broken(self) -> Column:
        return F.col(self.column).isNotNull() & ~F.col(self.column).isin(*self.values)

    def __str__(self) -> str:
        return f"{self.column} is not one of {', '.join(self.values)}"


@dataclass(frozen=True)
class Unique:
    columns: tuple[str, ...]

    def __str__(self) -> str:
        return f"{', '.join(self.columns)} not unique"


def key(*columns: str) -> list:
    """A primary key: present and unique."""
    return [*map(NotNull, columns), Unique(columns)]


# What the tables declare.
CONSTRAINTS = {
    tables.BRONZE: key("txn_id"),
    tables.QUARANTINE: [NotNull("quarantine_id"), NotNull("failure_reason")],
    tables.SILVER: key("txn_id"),
    tables.GOLD: key("report_month"),
    tables.RUN_LOG: [*map(NotNull, ("run_id", "pipeline_name", "step_name", "status", "started_at", "run_date")),
                     OneOf("status", (RUNNING, SUCCESS, FAILED))],
}


class Violated(ValueError):
    """Rows break a table's constraints."""


def _metric(i: int) -> str:
    return f"broken_{i}"


def metrics(constraints: list) -> list[Column]:
    """Aggregates that count the rows, and those that break each condition on rows; for one observation of a write."""
    conditions = [c for c in constraints if not isinstance(c, Unique)]
    return [F.count(F.lit(1)).alias("rows"), *(F.count_if(c.broken).alias(_metric(i)) for i, c in enumerate(conditions))]


def broken(constraints: list, counted: dict, stored: DataFrame) -> dict[str, int]:
    """How many rows break each condition, and how many keys repeat, of those that do."""
    conditions = [c for c in constraints if not isinstance(c, Unique)]
    found = {str(c): counted[_metric(i)] for i, c in enumerate(conditions)}
    for c in constraints:
        if isinstance(c, Unique):
            found[str(c)] = repeated_keys(stored, list(c.columns)).count()
    return {name: number for name, number in found.items() if number}


def require(table: str, constraints: list, counted: dict, stored: DataFrame) -> None:
    found = broken(constraints, counted, stored)
    if found:
        raise Violated(f"{table}: " + "; ".join(f"{name} ({number})" for name, number in found.items()))


def report(df: DataFrame, constraints: list) -> DataFrame:
    """One row per constraint: rule, broken (rows, or keys that repeat), status; for tables that are stored already."""
    conditions = [c for c in constraints if not isinstance(c, Unique)]
    named = [F.struct(F.lit(str(c)).alias("rule"), F.count_if(c.broken).alias("broken")) for c in conditions]
    parts = [df.agg(F.array(*named).alias("all")).select(F.inline("all"))] if named else []
    parts += [repeated_keys(df, list(c.columns)).agg(F.lit(str(c)).alias("rule"), F.count(F.lit(1)).alias("broken"))
              for c in constraints if isinstance(c, Unique)]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.withColumn("status", F.when(F.col("broken") == 0, "PASS").otherwise("FAIL"))
