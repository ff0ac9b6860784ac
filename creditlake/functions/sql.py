"""The analytical functions for SQL users, as temporary SQL functions.

Catalyst inlines their bodies, so they cost what the Column forms cost.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from . import scalars as S

_FUNCTIONS = {
    "customer_segment(income DECIMAL(38,2), defaulted_loans BIGINT)": (
        "STRING",
        f"""CASE WHEN defaulted_loans > 0 THEN 'high_risk'
                 WHEN income >= {S.PREMIUM_INCOME} THEN 'premium'
                 WHEN income >= {S.MASS_AFFLUENT_INCOME} THEN 'mass_affluent'
                 ELSE 'emerging' END""",
    ),
    "loan_utilization_band(total_disbursed DECIMAL(38,2))": (
        "STRING",
        f"""CASE WHEN total_disbursed >= {S.HIGH_UTILIZATION} THEN 'high_utilization'
                 WHEN total_disbursed >= {S.MODERATE_UTILIZATION} THEN 'moderate_utilization'
                 WHEN total_disbursed > 0 THEN 'low_utilization'
                 ELSE 'no_loans' END""",
    ),
    "transaction_risk_score(amount DECIMAL(38,2), transaction_type STRING, recent_alerts INT)": (
        "INT",
        f"""CAST(LEAST({S.BASE_SCORE}
              + CASE WHEN amount >= {S.VERY_LARGE_AMOUNT} THEN {S.VERY_LARGE_POINTS}
                     WHEN amount >= {S.LARGE_AMOUNT} THEN {S.LARGE_POINTS} ELSE 0 END
              + CASE WHEN lower(transaction_type) = 'cash_out' THEN {S.CASH_OUT_POINTS} ELSE 0 END
              + LEAST(recent_alerts * {S.POINTS_PER_ALERT}, {S.MAX_ALERT_POINTS}), {S.MAX_SCORE}) AS INT)""",
    ),
}


def register_sql_functions(spark: SparkSession) -> None:
    for signature, (returns, body) in _FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {returns} RETURN {body}")
