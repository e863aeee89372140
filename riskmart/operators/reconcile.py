"""Five reconciliations between layers, as rows (check_name, source_value, target_value, difference, status, detail).

Bronze yields one row of totals; Silver and, unless a stored Gold table is given, Gold yield theirs from one monthly
aggregate of Silver. Totals become one row per check and side; the two sides of a check then meet by name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.operators import gold as gold_layer
from riskmart.spec import NPL

VALUE = "decimal(22,2)"
BRONZE_SILVER = "count_bronze_to_silver"
SILVER_GOLD = "count_silver_to_gold"
BALANCE = "amount_balance_silver_vs_gold"
PROVISION = "amount_provision_silver_vs_gold"
NPL_COUNT = "count_npl_silver_vs_gold"

# The text shown with each reconciliation.
DETAILS = {
    BRONZE_SILVER: "จำนวนแถว Bronze (balance>0) vs Silver",
    SILVER_GOLD: "จำนวนแถวรวมใน Silver vs SUM(total_accounts) ใน Gold",
    BALANCE: "SUM(orig_balance_thb) Silver vs SUM(outstanding_balance_thb) Gold",
    PROVISION: "SUM(provision_amount_thb) Silver vs SUM(total_provision_thb) Gold",
    NPL_COUNT: "COUNT(NPL) ใน Silver vs SUM(npl_accounts) ใน Gold",
}
AMOUNTS = [BALANCE, PROVISION]
NPL_ROWS = "_npl_rows"

# (check, side) -> total over a layer. An empty layer gives 0, not NULL.
_BRONZE = {(BRONZE_SILVER, "source"): "count_if(orig_balance_after > 0)"}
_SILVER = {
    (BRONZE_SILVER, "target"): "coalesce(sum(total_accounts), 0)",
    (SILVER_GOLD, "source"): "coalesce(sum(total_accounts), 0)",
    (BALANCE, "source"): "coalesce(sum(outstanding_balance_thb), 0)",
    (PROVISION, "source"): "coalesce(sum(total_provision_thb), 0)",
    (NPL_COUNT, "source"): f"coalesce(sum({NPL_ROWS}), 0)",
}
_GOLD = {
    (SILVER_GOLD, "target"): "coalesce(sum(total_accounts), 0)",
    (BALANCE, "target"): "coalesce(sum(outstanding_balance_thb), 0)",
    (PROVISION, "target"): "coalesce(sum(total_provision_thb), 0)",
    (NPL_COUNT, "target"): "coalesce(sum(npl_accounts), 0)",
}


def _sides(layer: DataFrame, totals: dict[tuple[str, str], str], names: list[str]) -> DataFrame | None:
    """One row per wanted check and side, with the value of this layer."""
    wanted = {side: sql for side, sql in totals.items() if side[0] in names}
    if not wanted:
        return None
    one_row = layer.agg(*[F.expr(sql).cast(VALUE).alias(f"{name}_{side}") for (name, side), sql in wanted.items()])
    rows = ", ".join(f"named_struct('check_name', '{name}', 'side', '{side}', 'value', {name}_{side})"
                     for name, side in wanted)
    return one_row.selectExpr(f"inline(array({rows}))")


def checks(bronze: DataFrame, silver: DataFrame, gold: DataFrame | None = None, tolerance: str = "1.00",
           names: list[str] | None = None) -> DataFrame:
    """The reconciliations (all, or the named ones), ordered by name. Counts must be equal, amounts may differ by the
    tolerance. `gold` is the stored table, else Gold is what Silver gives."""
    names = names or list(DETAILS)
    facts = gold_layer.facts(silver, {NPL_ROWS: f"loan_status = '{NPL}'"})
    parts = [_sides(bronze, _BRONZE, names)]
    parts += [_sides(facts, _SILVER | _GOLD, names)] if gold is None else [_sides(facts, _SILVER, names), _sides(gold, _GOLD, names)]
    sides = reduce(DataFrame.unionByName, [p for p in parts if p is not None])
    paired = sides.groupBy("check_name").agg(
        F.max(F.when(F.col("side") == "source", F.col("value"))).alias("source_value"),
        F.max(F.when(F.col("side") == "target", F.col("value"))).alias("target_value"))
    allowed = F.when(F.col("check_name").isin(AMOUNTS), F.lit(tolerance).cast(VALUE)).otherwise(F.lit(0).cast(VALUE))
    detail = F.element_at(F.create_map(*[F.lit(t) for pair in DETAILS.items() for t in pair]), F.col("check_name"))
    return (paired.withColumn("difference", (F.col("source_value") - F.col("target_value")).cast(VALUE))
            .withColumn("status", F.when(F.abs("difference") <= allowed, "PASS").otherwise("FAIL"))
            .withColumn("detail", detail)
            .orderBy("check_name"))
