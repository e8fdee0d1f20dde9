"""Daily turnover per currency in one base currency."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.operators.select import slice_by_date


def global_metrics(
    transactions: DataFrame, rates: DataFrame, base_currency: int, day: date | None = None
) -> DataFrame:
    """Metrics per (day, currency): one business day, or all days for a backfill.

    A rate is constant within (day, currency), so amounts are summed first and
    converted afterwards; the transactions themselves never meet the rates.
    """
    rows = transactions if day is None else slice_by_date(transactions, "transaction_dt", day)
    per_currency = (
        rows.where((F.col("status") == "done") & (F.col("account_number_from") >= 0))
        .groupBy(F.to_date("transaction_dt").alias("date_update"), "currency_code")
        .agg(
            F.sum("amount").cast("decimal(20,2)").alias("amount"),
            F.count("*").alias("cnt_transactions"),
            F.count_distinct("account_number_from").alias("cnt_accounts_make_transactions"),
        )
    )
    to_base = rates.where(F.col("currency_code_with") == base_currency).select(
        "date_update", "currency_code", "currency_with_div"
    )
    total = F.col("amount_total").cast("double")
    return (
        per_currency.join(to_base, ["date_update", "currency_code"])
        .withColumn("amount_total", F.col("amount") * F.col("currency_with_div"))
        .select(
            "date_update",
            F.col("currency_code").alias("currency_from"),
            "amount_total",
            "cnt_transactions",
            (total / F.col("cnt_transactions")).alias("avg_transaction_amount"),
            "cnt_accounts_make_transactions",
            (total / F.col("cnt_accounts_make_transactions")).alias("avg_amount_per_account"),
        )
    )
