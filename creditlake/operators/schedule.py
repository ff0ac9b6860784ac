"""Loan schedules and batch movement rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import due_date, is_large_movement, parse_decimal, round_money

# Fixed value: days from one instalment to the next.
INSTALMENT_DAYS = 30


def instalment_schedule(loans: DataFrame) -> DataFrame:
    """Equal instalments every thirty days up to the loan's own due date, which the last one falls on.

    As many as fit, one at least; a loan without a due date has one without a date.
    """
    fitting = F.floor(F.date_diff("due_date", "disbursement_date") / INSTALMENT_DAYS).cast("int")
    count = F.greatest(F.coalesce(fitting, F.lit(1)), F.lit(1))
    counted = loans.select("loan_id", "disbursement_date", "due_date", "loan_amount", count.alias("_count"))
    each = round_money(F.col("loan_amount") / F.col("_count").cast("decimal(10,0)"))
    rows = counted.withColumn("amount_due", each).withColumn("instalment", F.explode(F.sequence(F.lit(1), "_count")))
    later = F.date_add("disbursement_date", F.col("instalment") * INSTALMENT_DAYS)
    due = F.when(F.col("instalment") == F.col("_count"), F.col("due_date")).otherwise(later)
    return rows.select("loan_id", "instalment", due.alias("due_date"), "amount_due")


def with_due_date(loans: DataFrame) -> DataFrame:
    """The due date that the extract delivers; where it has none, thirty days per month of the term."""
    return loans.withColumn("due_date", F.coalesce("due_date", due_date("disbursement_date", "term_months")))


def large_movements(transactions: DataFrame) -> DataFrame:
    """Transactions of 150000 or more, and cash-outs of 90000 or more."""
    return transactions.filter(is_large_movement(parse_decimal("amount"), "transaction_type"))
