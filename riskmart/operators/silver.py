"""Bronze to Silver: keep positive balances, convert to THB, derive loan status and provision."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.amounts import count_rows, money, month_of, total
from riskmart.spec import (
    DEFAULT_CODE, DEFAULT_PROVISION_RATE, FX_DECIMALS, FX_RATE, NPL, OTHER_PROVISION_RATE, PERFORMING, PROVISION_RATES,
    STORED_FX_RATE, STORED_PROVISION_RATE, TRANSACTION_COLUMNS, UNDER_PERFORMING, UNKNOWN,
)

JOIN_KEYS = ["txn_month", "txn_currency"]
ADDED_COLUMNS = ["txn_month", "fx_rate_to_thb", "txn_amount_thb", "orig_balance_thb",
                 "loan_status", "provision_rate", "provision_amount_thb"]


def rates(fx: DataFrame) -> DataFrame:
    """Typed rates under the names of the join keys. A rate that is no number, or has more digits than the type holds,
    ends the run with an error that names its month and currency."""
    text, typed = F.trim("rate_to_thb"), F.col("rate_to_thb").try_cast(FX_RATE)
    decimals = F.length(F.regexp_extract(text, r"\.([0-9]*?)0*$", 1))
    fits = typed.isNotNull() & (decimals <= FX_DECIMALS) & ~F.lower(text).contains("e")
    problem = F.concat(F.lit("rate that cannot be held exactly: "), F.concat_ws(" ", "rate_month", "currency_code", text))
    return fx.select(F.col("rate_month").alias("txn_month"), F.col("currency_code").alias("txn_currency"),
                     F.when(F.col("rate_to_thb").isNull() | fits, typed).otherwise(F.raise_error(problem)).alias("_rate"))


def eligible(bronze: DataFrame) -> DataFrame:
    """Rows with a positive balance, with their month. Overdrafts and missing balances are no debt."""
    return bronze.where("orig_balance_after > 0").withColumn("txn_month", month_of("txn_timestamp"))


def with_fx(bronze: DataFrame, fx: DataFrame) -> DataFrame:
    """Join each row to the rate of its month and currency; rows without a rate leave (see `unmatched`).

    The keys are few and very uneven, so the rates should be broadcast: Spark does it for a stored rate table, whose
    size it sees; a caller that can bound the size may pass a broadcast hint. A rate table too large for that is joined
    by shuffle with skewed keys split.

    Amounts use the full rate; only the stored rate is cut to four decimals. `txn_amount_usd` is multiplied by the rate
    of `txn_currency`, whatever its name says.
    """
    return (eligible(bronze).join(rates(fx), JOIN_KEYS, "inner")
            .withColumns({
                "fx_rate_to_thb": F.col("_rate").cast(STORED_FX_RATE),
                "txn_amount_thb": money(F.col("txn_amount_usd") * F.col("_rate")),
                "orig_balance_thb": money(F.col("orig_balance_after") * F.col("_rate")),
            }))


def fx_join(bronze: DataFrame, fx: DataFrame) -> DataFrame:
    """Transaction, source balance and full rate of every matched row."""
    return (eligible(bronze).join(rates(fx), JOIN_KEYS, "inner")
            .select("txn_id", "orig_balance_after", F.col("_rate").alias("rate_to_thb")))


def unmatched(bronze: DataFrame, fx: DataFrame) -> DataFrame:
    """Eligible rows without a rate, which Silver lacks."""
    return eligible(bronze).join(rates(fx), JOIN_KEYS, "left_anti")


def classify(converted: DataFrame) -> DataFrame:
    """Add loan status, provision rate and provision.

    The status looks at the code before the default flag, the provision rate at the flag first; both agree because
    Bronze lifts every default to the default code, and a quality check guards it. The provision is rounded once, on
    the full product.
    """
    code, in_default = F.col("delinquency_status"), F.col("target_credit_default")
    status = (F.when(code == "M0", PERFORMING)
              .when(code.isin("M1", "M2", "M3"), UNDER_PERFORMING)
              .when((code == DEFAULT_CODE) | in_default, NPL)
              .otherwise(UNKNOWN))
    rate = F.when(in_default, F.lit(DEFAULT_PROVISION_RATE).cast("decimal(3,2)"))
    for known, value in PROVISION_RATES.items():
        rate = rate.when(code == known, F.lit(value).cast("decimal(3,2)"))
    rate = rate.otherwise(F.lit(OTHER_PROVISION_RATE).cast("decimal(3,2)"))
    return converted.withColumns({
        "loan_status": status,
        "provision_rate": rate.cast(STORED_PROVISION_RATE),
        "provision_amount_thb": money(F.col("orig_balance_after") * F.col("_rate") * rate),
    })


def build(bronze: DataFrame, fx: DataFrame) -> DataFrame:
    """Silver: the 50 Bronze columns and seven derived ones, one row per transaction with debt and a rate."""
    return classify(with_fx(bronze, fx)).selectExpr(*TRANSACTION_COLUMNS, *ADDED_COLUMNS)


def status_distribution(silver: DataFrame) -> DataFrame:
    return (silver.groupBy("loan_status").agg(count_rows().alias("total"))
            .orderBy(F.desc("total"), F.asc_nulls_last("loan_status")))


def provision_summary(silver: DataFrame) -> DataFrame:
    """Average balance and provision per code, status and rate."""
    return (silver.groupBy("delinquency_status", "loan_status", "provision_rate")
            .agg(_average("orig_balance_thb").alias("avg_balance_thb"),
                 _average("provision_amount_thb").alias("avg_provision_thb"),
                 count_rows().alias("total"))
            .orderBy(F.asc_nulls_last("provision_rate"), F.asc_nulls_last("delinquency_status")))


def _average(amount: str):
    """Exact mean: the sum keeps its digits, so the one rounding is the last step."""
    return F.round(F.sum(amount).cast("decimal(30,6)") / F.count(amount), 2).cast("decimal(20,2)")


def npl_accounts(silver: DataFrame) -> DataFrame:
    return (silver.where(F.col("loan_status") == NPL)
            .select("cust_id", "txn_id", "loan_status", "orig_balance_thb", "provision_amount_thb"))


def monthly_totals(silver: DataFrame) -> DataFrame:
    """Row count and balance by the month of the transaction time."""
    return (silver.groupBy(month_of("txn_timestamp").alias("txn_month"))
            .agg(count_rows().alias("total"), total("orig_balance_thb").alias("total_balance")))
