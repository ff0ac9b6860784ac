"""Schemas of the source extracts, the stream and the gold tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The columns of the source extracts.
SOURCE_COLUMNS: dict[str, tuple[str, ...]] = {
    "branches": ("branch_id", "branch_name", "region"),
    "products": ("product_id", "product_name", "product_type", "base_rate"),
    "customers": (
        "customer_id",
        "first_name",
        "last_name",
        "gender",
        "date_of_birth",
        "phone_number",
        "email",
        "national_id",
        "branch_id",
        "signup_date",
        "monthly_income",
        "employment_status",
    ),
    "loans": (
        "loan_id",
        "customer_id",
        "product_id",
        "branch_id",
        "application_date",
        "disbursement_date",
        "loan_amount",
        "interest_rate",
        "term_months",
        "loan_status",
        "due_date",
    ),
    "repayments": ("repayment_id", "loan_id", "customer_id", "repayment_date", "amount_paid", "payment_channel"),
    "mobile_transactions": (
        "transaction_id",
        "customer_id",
        "transaction_date",
        "transaction_type",
        "amount",
        "channel",
        "merchant_category",
    ),
    "collections": (
        "collection_id",
        "loan_id",
        "customer_id",
        "collector_id",
        "action_date",
        "action_type",
        "amount_recovered",
        "outcome",
    ),
    "fraud_alerts": (
        "alert_id",
        "transaction_id",
        "customer_id",
        "alert_timestamp",
        "rule_name",
        "risk_score",
        "alert_status",
    ),
}

STREAM_EVENT = (
    "event_id string, transaction_id string, customer_id string, event_time timestamp, "
    "transaction_type string, amount string, channel string, merchant_category string"
)
STREAM_ALERT = (
    "alert_id string, transaction_id string, customer_id string, alert_time timestamp, "
    "rule_name string, risk_score int, alert_status string"
)

# Column lists in DDL form; "not null" columns are checked by :func:`conform`.
GOLD: dict[str, str] = {
    "dim_customer": (
        "customer_key bigint not null, customer_id string not null, full_name string, gender string, "
        "branch_id string, signup_date date, monthly_income decimal(18,2), customer_segment string, "
        "loan_utilization_band string, effective_from date, effective_to date, is_current boolean"
    ),
    "dim_product": (
        "product_key bigint not null, product_id string not null, product_name string, "
        "product_type string, base_rate decimal(18,2)"
    ),
    "dim_branch": "branch_key bigint not null, branch_id string not null, branch_name string, region string",
    "dim_date": (
        "date_key int not null, full_date date not null, year int, quarter int, month int, day int, day_name string"
    ),
    "dim_loan_status": "loan_status_key bigint not null, loan_status string not null",
    "fact_loan_disbursement": (
        "loan_id string not null, customer_key bigint not null, product_key bigint not null, "
        "branch_key bigint not null, loan_status_key bigint not null, disbursement_date_key int not null, "
        "loan_amount decimal(18,2), amount_repaid decimal(28,2), amount_recovered decimal(28,2), "
        "outstanding_amount decimal(18,2), term_months bigint, interest_rate decimal(18,2)"
    ),
    "fact_repayments": (
        "repayment_id string not null, loan_id string not null, customer_key bigint not null, "
        "repayment_date_key int not null, amount_paid decimal(18,2), payment_channel string"
    ),
    "fact_collections": (
        "collection_id string not null, loan_id string not null, customer_key bigint not null, "
        "action_date_key int not null, collector_id string, action_type string, "
        "amount_recovered decimal(18,2), outcome string"
    ),
    "fact_transactions": (
        "transaction_id string not null, customer_key bigint not null, transaction_date_key int not null, "
        "transaction_type string, amount decimal(18,2), channel string, merchant_category string"
    ),
    "portfolio_summary": "metric string not null, value string",
}


def ddl_columns(ddl: str) -> list[tuple[str, str, bool]]:
    """(name, type, required) of every column in a DDL list."""
    found = []
    for part in re.split(r",\s+", ddl):
        name, kind, *rest = part.split()
        found.append((name, kind, rest == ["not", "null"]))
    return found


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """``df`` with the columns and types of ``ddl``; a NULL in a NOT NULL column fails the job."""

    def column(name: str, kind: str, required: bool) -> Column:
        value = F.col(name).cast(kind)
        if required:
            value = F.coalesce(value, F.raise_error(F.lit(f"{name} must not be NULL")).cast(kind))
        return value.alias(name)

    return df.select(*[column(*c) for c in ddl_columns(ddl)])
