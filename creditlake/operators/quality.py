"""Data-quality figures: counts, issues, run status and table constraints."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import clean

ISSUE_SCHEMA = "`table` string, check_name string, severity string, message string, failed_count bigint"

# The constraints of the gold tables.
NOT_NULL = (
    ("dim_customer", "customer_key"),
    ("dim_customer", "customer_id"),
    ("dim_product", "product_key"),
    ("dim_product", "product_id"),
    ("dim_branch", "branch_key"),
    ("dim_branch", "branch_id"),
    ("dim_loan_status", "loan_status_key"),
    ("fact_loan_disbursement", "loan_id"),
    ("fact_loan_disbursement", "customer_key"),
)
UNIQUE = tuple(pair for pair in NOT_NULL if pair != ("fact_loan_disbursement", "customer_key"))
RELATIONSHIPS = (("fact_loan_disbursement", "customer_key", "dim_customer", "customer_key"),)


def duplicate_key_count(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each non-blank key, as one row."""
    value = clean(key)
    return df.filter(value != "").agg(
        (F.count(F.lit(1)) - F.count_distinct(value)).alias("duplicate_count")
    )


def reconciles(source: Column, accepted: Column, rejected: Column) -> Column:
    return source == accepted + rejected


def layer_counts(checked_counts: DataFrame) -> DataFrame:
    """(name, row_count) rows from one (table, source, accepted, rejected) row per table."""
    pairs = [
        F.struct(F.concat(F.lit(f"{layer}."), F.col("table")).alias("name"), F.col(c).alias("row_count"))
        for layer, c in (("bronze", "source"), ("silver", "accepted"), ("quarantine", "rejected"))
    ]
    return checked_counts.select(F.inline(F.array(*pairs)))


def quality_issues(checked_counts: DataFrame) -> DataFrame:
    """Warnings for quarantined rows and errors for counts that do not add up."""
    fits = reconciles(F.col("source"), F.col("accepted"), F.col("rejected"))
    quarantined = F.struct(
        F.lit("records_quarantined").alias("check_name"),
        F.lit("warning").alias("severity"),
        F.concat(F.col("rejected").cast("string"), F.lit(" rejected records written to quarantine")).alias("message"),
        F.col("rejected").alias("failed_count"),
    )
    unbalanced = F.struct(
        F.lit("row_count_reconciliation").alias("check_name"),
        F.lit("error").alias("severity"),
        F.lit("Accepted plus rejected rows does not equal source rows").alias("message"),
        F.when(fits, 0).otherwise(1).cast("bigint").alias("failed_count"),
    )
    return checked_counts.select("table", F.inline(F.array(quarantined, unbalanced))).filter("failed_count > 0")


def quality_status(issues: DataFrame) -> DataFrame:
    """One row: failed with any error, passed_with_warnings with any issue, else passed."""
    errors = F.count_if(F.col("severity") == "error")
    return issues.agg(
        F.when(errors > 0, "failed").when(F.count(F.lit(1)) > 0, "passed_with_warnings").otherwise("passed").alias("status")
    )


def audit_record(
    issues: DataFrame, counts: DataFrame, run: Mapping[str, Column], layers: Mapping[str, str]
) -> DataFrame:
    """One row with run id, times, layer folders, status, counts and issues.

    ``issues`` and ``counts`` have a handful of rows per table, whatever the data size.
    """
    report = quality_status(issues).crossJoin(
        counts.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("name", "row_count")))).alias("row_counts"))
    ).crossJoin(
        issues.agg(
            F.sort_array(
                F.collect_list(F.struct("table", "check_name", "severity", "message", "failed_count"))
            ).alias("issues")
        )
    )
    folders = F.struct(*[F.lit(path).alias(name) for name, path in layers.items()])
    return report.select(
        run["run_id"].alias("run_id"),
        "status",
        run["started_at"].alias("started_at"),
        run["completed_at"].alias("completed_at"),
        folders.alias("layers"),
        F.struct(run["run_id"].alias("run_id"), "status", "row_counts", "issues").alias("quality"),
    )


def not_null_failures(df: DataFrame, *columns: str) -> DataFrame:
    """NULLs of each column, in one pass: (column, failures) rows."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("failures")) for c in columns]
    return counts.select(F.inline(F.array(*pairs)))


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """How many values occur more than once."""
    repeated = df.filter(F.col(column).isNotNull()).groupBy(column).count().filter("count > 1")
    return repeated.agg(F.count(F.lit(1)).alias("failures"))


def relationship_failures(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose value is missing from the parent, counted per value before the join."""
    values = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_value")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    orphans = values.join(parent.select(F.col(key).alias("_value")), "_value", "left_anti")
    return orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("failures"))


def constraint_tests(table: Callable[[str], DataFrame]) -> DataFrame:
    """One row per constraint of the gold tables with the number of failures.

    Every table is read several times: pass stored or staged tables.
    """

    def named(test: str, name: str, column: Column, result: DataFrame) -> DataFrame:
        return result.select(
            F.lit(test).alias("test"), F.lit(name).alias("table"), column.alias("column"), "failures"
        )

    results = []
    for name in dict.fromkeys(t for t, _ in NOT_NULL):
        columns = [c for t, c in NOT_NULL if t == name]
        results.append(named("not_null", name, F.col("column"), not_null_failures(table(name), *columns)))
    results += [named("unique", t, F.lit(c), unique_failures(table(t), c)) for t, c in UNIQUE]
    results += [
        named("relationships", t, F.lit(c), relationship_failures(table(t), c, table(parent), key))
        for t, c, parent, key in RELATIONSHIPS
    ]
    return union_all(results)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
