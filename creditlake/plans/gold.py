"""Gold layer: star schema and portfolio KPIs over silver frames."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import (
    clean,
    customer_segment,
    date_key,
    day_name,
    optional_money,
    percent,
    utilization_band,
)
from ..operators.keys import dense_keys, small_dense_keys
from ..operators.skew import lookup_join, shuffled, stage
from .silver import LOAN_STATUSES

MONEY_TOTAL = "decimal(28,2)"
GRAND_TOTAL = "decimal(38,2)"

# The table and column of every date that a fact carries.
FACT_DATES = {
    "loans": "disbursement_date",
    "repayments": "repayment_date",
    "collections": "action_date",
    "mobile_transactions": "transaction_date",
}


def total_by(rows: DataFrame, key: str, amount: str, name: str) -> DataFrame:
    """Sum of ``amount`` per ``key``; partial sums are taken before the shuffle."""
    return rows.groupBy(key).agg(F.sum(amount).cast(MONEY_TOTAL).alias(name))


def loan_rollup(loans: DataFrame) -> DataFrame:
    return loans.groupBy("customer_id").agg(
        F.count_if(F.col("loan_status") == "DEFAULTED").alias("defaulted_loans"),
        F.sum("loan_amount").cast(MONEY_TOTAL).alias("total_disbursed"),
    )


def fixed_statuses(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(s,) for s in LOAN_STATUSES], "loan_status string")


def loan_status_names(loans: DataFrame) -> DataFrame:
    """Statuses in use together with the fixed ones, each once."""
    return loans.select("loan_status").distinct().union(fixed_statuses(loans.sparkSession)).distinct()


def loan_balances(loans: DataFrame, repayments: DataFrame, collections: DataFrame) -> DataFrame:
    """Loans with what was repaid, recovered and is outstanding (never below zero).

    Both children are summed per loan before the join, so loans do not fan out.
    """
    paid = total_by(repayments, "loan_id", "amount_paid", "amount_repaid")
    recovered = total_by(collections, "loan_id", "amount_recovered", "amount_recovered")
    joined = loans.join(shuffled(paid), "loan_id", "left").join(shuffled(recovered), "loan_id", "left")
    none = F.lit(0).cast(MONEY_TOTAL)
    with_sums = joined.withColumns(
        {
            "amount_repaid": F.coalesce("amount_repaid", none),
            "amount_recovered": F.coalesce("amount_recovered", none),
        }
    )
    left = F.col("loan_amount") - F.col("amount_repaid") - F.col("amount_recovered")
    return with_sums.withColumn("outstanding_amount", F.greatest(left, F.lit(0)).cast("decimal(18,2)"))


def portfolio_totals(balances: DataFrame) -> DataFrame:
    """All portfolio figures in one pass: a single row."""
    overdue = F.when(F.col("loan_status") == "OVERDUE", F.col("outstanding_amount")).otherwise(F.lit(0))
    sums = {
        "total_loan_book": F.col("outstanding_amount"),
        "total_disbursed": F.col("loan_amount"),
        "total_repaid": F.col("amount_repaid"),
        "total_recovered": F.col("amount_recovered"),
        "overdue_principal": overdue,
    }
    return balances.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast(GRAND_TOTAL).alias(n) for n, c in sums.items()],
        F.count_if(F.col("loan_status") == "ACTIVE").alias("active_loans"),
        F.count_if(F.col("loan_status") == "DEFAULTED").alias("defaulted_loans"),
    )


def portfolio_summary(balances: DataFrame) -> DataFrame:
    """Nine (metric, value) rows. With nothing outstanding the recovery rate is 0."""
    book, recovered = F.col("total_loan_book"), F.col("total_recovered")
    rates = portfolio_totals(balances).withColumns(
        {
            "repayment_rate_pct": percent(F.col("total_repaid"), F.col("total_disbursed")),
            "recovery_rate_pct": F.when(book == 0, F.lit(0).cast(GRAND_TOTAL)).otherwise(
                percent(recovered, recovered + book)
            ),
        }
    )
    metrics = (
        "total_loan_book",
        "total_disbursed",
        "total_repaid",
        "total_recovered",
        "overdue_principal",
        "repayment_rate_pct",
        "recovery_rate_pct",
        "active_loans",
        "defaulted_loans",
    )
    pairs = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("string").alias("value")) for m in metrics]
    return rates.select(F.inline(F.array(*pairs)))


class GoldPlan:
    """Gold tables over a function that returns a silver table by name.

    ``dimension`` may be replaced to read dimensions that are already stored.
    With ``staged``, every gold table is staged, for plans that read it several times.
    ``columns`` names the columns that the plan uses, for tables of which it does not
    use all; what only the others need is not made.
    """

    def __init__(
        self,
        silver: Callable[[str], DataFrame],
        dimension: Callable[[str], DataFrame] | None = None,
        staged: bool = False,
        columns: Mapping[str, Sequence[str]] | None = None,
    ):
        self.silver = silver
        self.used = columns or {}
        self.staged = staged
        self.stored_dimension = dimension
        self._made: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._made:
            made = getattr(self, name)()
            self._made[name] = stage(made) if self.staged else made
        return self._made[name]

    def dimension(self, name: str) -> DataFrame:
        return self.stored_dimension(name) if self.stored_dimension else self.table(name)

    def uses(self, table: str, *columns: str) -> bool:
        return table not in self.used or any(c in self.used[table] for c in columns)

    def chosen(self, table: str, columns: Mapping[str, Column]) -> list[Column]:
        return [made.alias(name) for name, made in columns.items() if self.uses(table, name)]

    def dim_customer(self) -> DataFrame:
        rows = self.silver("customers")
        if self.uses("dim_customer", "customer_segment", "loan_utilization_band"):
            rows = rows.join(shuffled(loan_rollup(self.silver("loans"))), "customer_id", "left")
        profile = {
            "customer_id": F.col("customer_id"),
            "full_name": F.concat_ws(" ", "first_name", "last_name"),
            "gender": F.col("gender"),
            "branch_id": F.col("branch_id"),
            "signup_date": F.col("signup_date"),
            "monthly_income": F.col("monthly_income"),
            "customer_segment": customer_segment("monthly_income", F.coalesce("defaulted_loans", F.lit(0))),
            "loan_utilization_band": utilization_band(F.coalesce("total_disbursed", F.lit(0))),
            "effective_from": F.col("signup_date"),
            "effective_to": F.lit(None).cast("date"),
            "is_current": F.lit(True),
        }
        return dense_keys(rows.select(*self.chosen("dim_customer", profile)), "customer_id", "customer_key")

    def dim_product(self) -> DataFrame:
        product = {
            "product_id": F.col("product_id"),
            "product_name": F.col("product_name"),
            "product_type": F.col("product_type"),
            "base_rate": optional_money("base_rate"),
        }
        return dense_keys(self.silver("products").select(*self.chosen("dim_product", product)), "product_id", "product_key")

    def dim_branch(self) -> DataFrame:
        branch = {"branch_id": F.col("branch_id"), "branch_name": clean("branch_name"), "region": F.col("region")}
        return dense_keys(self.silver("branches").select(*self.chosen("dim_branch", branch)), "branch_id", "branch_key")

    def dim_loan_status(self) -> DataFrame:
        # The status rule admits only the fixed statuses, so this is four rows.
        return small_dense_keys(loan_status_names(self.silver("loans")), "loan_status", "loan_status_key")

    def dim_date(self) -> DataFrame:
        days = None
        for table, column in FACT_DATES.items():
            some = self.silver(table).select(F.col(column).alias("full_date")).distinct()
            days = some if days is None else days.union(some)
        day = F.col("full_date")
        return (
            days.filter(day.isNotNull())
            .distinct()
            .select(
                date_key(day).alias("date_key"),
                day,
                F.year(day).alias("year"),
                F.quarter(day).alias("quarter"),
                F.month(day).alias("month"),
                F.dayofmonth(day).alias("day"),
                day_name(day).alias("day_name"),
            )
        )

    def customer_keys(self) -> DataFrame:
        """customer_id to customer_key. Without a stored dimension, only the ids are numbered."""
        if self.stored_dimension:
            return self.stored_dimension("dim_customer").select("customer_id", "customer_key")
        return dense_keys(self.silver("customers").select("customer_id"), "customer_id", "customer_key")

    def status_keys(self) -> DataFrame:
        """Key of each status: four rows. The status rule admits no others, so loans need not be read."""
        if self.stored_dimension:
            return self.stored_dimension("dim_loan_status")
        return small_dense_keys(fixed_statuses(self.silver("loans").sparkSession), "loan_status", "loan_status_key")

    def _with_customer_key(self, rows: DataFrame) -> DataFrame:
        joined = lookup_join(rows, self.table("customer_keys"), "customer_id", stored=True)
        return joined.filter(F.col("customer_key").isNotNull())

    def fact_loan_disbursement(self) -> DataFrame:
        rows = self.silver("loans")
        # The sums add no row and drop none.
        if self.uses("fact_loan_disbursement", "amount_repaid", "amount_recovered", "outstanding_amount"):
            rows = loan_balances(rows, self.silver("repayments"), self.silver("collections"))
        rows = self._with_customer_key(rows)
        for name in ("product", "branch"):
            keys = self.dimension(f"dim_{name}").select(f"{name}_id", f"{name}_key")
            rows = lookup_join(rows, keys, f"{name}_id", stored=True).filter(F.col(f"{name}_key").isNotNull())
        as_they_are = ("loan_amount", "amount_repaid", "amount_recovered", "outstanding_amount", "term_months", "interest_rate")
        fact = {
            **{c: F.col(c) for c in ("loan_id", "customer_key", "product_key", "branch_key", "loan_status_key")},
            "disbursement_date_key": date_key("disbursement_date"),
            **{c: F.col(c) for c in as_they_are},
        }
        return rows.join(F.broadcast(self.status_keys()), "loan_status").select(*self.chosen("fact_loan_disbursement", fact))

    def fact_repayments(self) -> DataFrame:
        return self._with_customer_key(self.silver("repayments")).select(
            "repayment_id",
            "loan_id",
            "customer_key",
            date_key("repayment_date").alias("repayment_date_key"),
            "amount_paid",
            "payment_channel",
        )

    def fact_collections(self) -> DataFrame:
        return self._with_customer_key(self.silver("collections")).select(
            "collection_id",
            "loan_id",
            "customer_key",
            date_key("action_date").alias("action_date_key"),
            "collector_id",
            "action_type",
            "amount_recovered",
            "outcome",
        )

    def fact_transactions(self) -> DataFrame:
        return self._with_customer_key(self.silver("mobile_transactions")).select(
            "transaction_id",
            "customer_key",
            date_key("transaction_date").alias("transaction_date_key"),
            "transaction_type",
            "amount",
            "channel",
            "merchant_category",
        )

    def portfolio_summary(self) -> DataFrame:
        return portfolio_summary(
            loan_balances(self.silver("loans"), self.silver("repayments"), self.silver("collections"))
        )
