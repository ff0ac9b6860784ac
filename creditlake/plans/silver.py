"""Silver layer: the rules and cleaned columns of the eight source tables."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import (
    clean,
    code,
    label,
    money,
    out_of_range,
    parse_date,
    parse_decimal,
    parse_timestamp,
    title,
    whole_number,
)
from ..operators.keys import latest_per_key
from ..operators.rules import (
    RuleSet,
    accept,
    accept_checked,
    as_silver,
    check,
    raw_columns,
    reject,
    to_silver,
    with_expected,
)
from ..operators.skew import stage

# The states a loan may be in.
LOAN_STATUSES = ("ACTIVE", "CLOSED", "OVERDUE", "DEFAULTED")

RULES: dict[str, RuleSet] = {
    "branches": RuleSet("branches", "branch_id", required=("branch_id",)),
    "products": RuleSet("products", "product_id", required=("product_id",)),
    "customers": RuleSet(
        "customers",
        "customer_id",
        required=("customer_id", "first_name", "last_name", "branch_id", "signup_date"),
        positive=("monthly_income",),
        columns={
            "customer_id": code,
            "first_name": title,
            "last_name": title,
            "gender": code,
            "date_of_birth": parse_date,
            "phone_number": clean,
            "email": label,
            "national_id": clean,
            "branch_id": code,
            "signup_date": parse_date,
            "monthly_income": money,
            "employment_status": label,
        },
    ),
    "loans": RuleSet(
        "loans",
        "loan_id",
        required=("loan_id", "customer_id", "product_id", "branch_id", "disbursement_date"),
        positive=("loan_amount", "interest_rate", "term_months"),
        allowed={"loan_status": LOAN_STATUSES},
        parents=(("customer_id", "customers"), ("product_id", "products"), ("branch_id", "branches")),
        event_date="disbursement_date",
        columns={
            "loan_id": code,
            "customer_id": code,
            "product_id": code,
            "branch_id": code,
            "application_date": parse_date,
            "disbursement_date": parse_date,
            "loan_amount": money,
            "interest_rate": money,
            "term_months": whole_number,
            "loan_status": code,
            "due_date": parse_date,
        },
    ),
    "repayments": RuleSet(
        "repayments",
        "repayment_id",
        required=("repayment_id", "loan_id", "customer_id", "repayment_date"),
        positive=("amount_paid",),
        parents=(("loan_id", "loans"), ("customer_id", "customers")),
        event_date="repayment_date",
        columns={
            "repayment_id": code,
            "loan_id": code,
            "customer_id": code,
            "repayment_date": parse_date,
            "amount_paid": money,
            "payment_channel": label,
        },
    ),
    "mobile_transactions": RuleSet(
        "mobile_transactions",
        "transaction_id",
        required=("transaction_id", "customer_id", "transaction_date", "transaction_type"),
        positive=("amount",),
        parents=(("customer_id", "customers"),),
        event_date="transaction_date",
        columns={
            "transaction_id": code,
            "customer_id": code,
            "transaction_date": parse_date,
            "transaction_type": label,
            "amount": money,
            "channel": label,
            "merchant_category": label,
        },
    ),
    "collections": RuleSet(
        "collections",
        "collection_id",
        required=("collection_id", "loan_id", "customer_id", "collector_id", "action_date"),
        checks=(("negative_amount_recovered", lambda: parse_decimal("amount_recovered") < 0),),
        parents=(("loan_id", "loans"), ("customer_id", "customers")),
        event_date="action_date",
        columns={
            "collection_id": code,
            "loan_id": code,
            "customer_id": code,
            "collector_id": code,
            "action_date": parse_date,
            "action_type": label,
            "amount_recovered": money,
            "outcome": label,
        },
    ),
    "fraud_alerts": RuleSet(
        "fraud_alerts",
        "alert_id",
        required=("alert_id", "transaction_id", "customer_id", "alert_timestamp", "rule_name"),
        checks=(("invalid_risk_score", lambda: parse_decimal("risk_score") <= 0),),
        parents=(("customer_id", "customers"),),
        columns={
            "alert_id": code,
            "transaction_id": code,
            "customer_id": code,
            "alert_timestamp": parse_timestamp,
            "rule_name": label,
            "risk_score": whole_number,
            "alert_status": code,
        },
    ),
}

# Parents come before the tables that refer to them.
SILVER_ORDER = tuple(RULES)
PARENTS = {parent for rules in RULES.values() for _, parent in rules.parents}


class SilverPlan:
    """Silver layer over bronze frames; nothing runs until a frame is used.

    Two ways to save work where one plan reads a table several times: ``keep``
    names silver tables that are staged when first asked for, and with
    ``staged`` the checked rows and the silver rows of every table are staged, but
    not the keys of a table of which only these are used and that is no parent.

    ``columns`` names the silver columns that the plan uses, for tables of which
    it does not use all; the others are not taken through the shuffles. Then the
    checked rows hold these instead of raw values, so there is no quarantine.
    """

    def __init__(
        self,
        bronze: Mapping[str, DataFrame],
        staged: bool = False,
        keep: tuple[str, ...] = (),
        columns: Mapping[str, Sequence[str]] | None = None,
    ):
        self.bronze = bronze
        self.staged = staged
        self.keep = keep
        self.used = columns
        self._checked: dict[str, DataFrame] = {}
        self._tables: dict[str, DataFrame] = {}

    def parents(self, table: str) -> dict[str, DataFrame]:
        return {parent: self.table(parent) for _, parent in RULES[table].parents}

    def stored(self) -> Collection[str]:
        """The silver tables that are read from files."""
        return SILVER_ORDER if self.staged else self.keep

    def columns(self, table: str) -> list[str]:
        """The silver columns of a table, in order: those used, and always the key."""
        rules = RULES[table]
        every = list(rules.columns or raw_columns(with_expected(self.bronze[table], rules.expected())))
        used = (self.used or {}).get(table, every)
        return [c for c in every if c in used or c == rules.key]

    def checked(self, table: str) -> DataFrame:
        if table not in self._checked:
            rules = RULES[table]
            columns = None if self.used is None else self.columns(table)
            checked = check(self.bronze[table], rules, self.parents(table), columns, self.stored())
            self._checked[table] = stage(checked) if self.staged else checked
        return self._checked[table]

    def table(self, table: str) -> DataFrame:
        if table not in self._tables:
            rules, columns = RULES[table], self.columns(table)
            if not self.staged:
                accepted = accept(self.bronze[table], rules, self.parents(table), columns, self.stored())
                silver = as_silver(accepted, rules, columns)
            elif self.used is None:
                silver = to_silver(accept_checked(self.checked(table), rules), rules)
            else:
                silver = as_silver(accept_checked(self.checked(table), rules, columns), rules, columns)
            # Keys that no table refers to are read once at most.
            once = columns == [rules.key] and table not in PARENTS
            self._tables[table] = stage(silver) if (self.staged and not once) or table in self.keep else silver
        return self._tables[table]

    def quarantine(self, table: str) -> DataFrame:
        if self.used is not None:
            raise ValueError("the checked rows hold no raw values")
        return reject(self.checked(table), RULES[table], self.staged)


# The warehouse form of silver: the newest version of each key, checked for the
# key and one amount only. The table's amount must be positive, or not negative.
LATEST_VERSION = {
    "customers": ("signup_date", None),
    "loans": ("disbursement_date", ("loan_amount", False)),
    "repayments": ("repayment_date", ("amount_paid", False)),
    "mobile_transactions": ("transaction_date", ("amount", False)),
    "collections": ("action_date", ("amount_recovered", True)),
}


def latest_version(bronze: DataFrame, table: str, *ties: str) -> DataFrame:
    """Newest row of every non-null key by its business date."""
    rules = RULES[table]
    moment, amount = LATEST_VERSION[table]
    rows = bronze.filter(F.col(rules.key).isNotNull())
    if amount:
        number = clean(amount[0]).try_cast("decimal(38,9)")
        rows = rows.filter((number >= 0 if amount[1] else number > 0) & ~out_of_range(amount[0]))
    dated = rows.withColumns({"_key": code(rules.key), "_moment": parse_date(moment)})
    return to_silver(latest_per_key(dated, "_key", "_moment", *ties), rules)


# The date by which each table is loaded incrementally.
INCREMENTAL_DATE = {
    "customers": "signup_date",
    "loans": "disbursement_date",
    "repayments": "repayment_date",
    "mobile_transactions": "transaction_date",
    "collections": "action_date",
    "fraud_alerts": "alert_timestamp",
}


def merge_increment(stored: DataFrame, incoming: DataFrame, table: str) -> DataFrame:
    """The stored table with an increment merged in: the newest row of every key.

    At equal dates the incoming row wins. Read the increment with
    :func:`~creditlake.operators.keys.newer_than`, or in full when rows may
    arrive late.
    """
    both = stored.withColumn("_age", F.lit(1)).unionByName(incoming.withColumn("_age", F.lit(0)))
    return latest_per_key(both, RULES[table].key, INCREMENTAL_DATE[table], "_age").drop("_age")
