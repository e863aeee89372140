"""Amount, ratio and month expressions with exact decimals; rounding is half away from zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskmart.spec import MONEY, MONEY_SUM, RATIO


def month_of(timestamp: Column | str) -> Column:
    """Month key yyyy-MM of a timestamp without zone; the session's time zone plays no part."""
    return F.substring(F.to_date(timestamp).cast("string"), 1, 7)


def money(amount: Column) -> Column:
    """Amount rounded once, to two decimals."""
    return F.round(amount, 2).cast(MONEY)


def total(amount: Column | str) -> Column:
    """Sum as stored in reports; NULL when there is no row."""
    return F.round(F.sum(amount), 2).cast(MONEY_SUM)


def total_where(condition: Column, amount: Column | str) -> Column:
    """Sum over the rows that meet the condition; NULL when none does."""
    value = F.col(amount) if isinstance(amount, str) else amount
    return total(F.when(condition, value))


def count_rows() -> Column:
    return F.count(F.lit(1))


def percent_of(part: Column | str, whole: Column | str) -> Column:
    """Share of two counts in percent with four decimals; NULL when the whole is 0."""
    def exact(c):
        return (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)")
    return F.round(exact(part) / F.nullif(exact(whole), F.lit(0)) * 100, 4).cast(RATIO)


def percent_of_money(part: Column | str, whole: Column | str) -> Column:
    """Share of two amounts in percent with four decimals; NULL when the whole is 0."""
    def exact(c):
        return (F.col(c) if isinstance(c, str) else c).cast(MONEY_SUM)
    return F.round(exact(part) / F.nullif(exact(whole), F.lit(0)) * 100, 4)
