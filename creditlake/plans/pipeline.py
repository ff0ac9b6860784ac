"""The whole run: extracts to bronze, silver with quarantine, gold, and an audit record.

Each layer is written and read back, so a lost executor costs only the step it
was working on, both sides of every later join are plain scans (which lets AQE
split skewed partitions). Rows are counted by the tasks that write them.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import now
from ..operators.quality import (
    ISSUE_SCHEMA,
    audit_record,
    constraint_tests,
    layer_counts,
    quality_issues,
)
from ..operators.rules import accept_unshuffled, check, reject, repeated_keys, to_silver
from ..operators.skew import stage
from ..sources.io import empty_bronze, read_bronze_csv, write_counted, write_fact, write_json
from ..sources.schemas import GOLD, SOURCE_COLUMNS, conform
from .gold import GoldPlan, portfolio_summary
from .silver import RULES, SILVER_ORDER

DIMENSIONS = ("dim_customer", "dim_product", "dim_branch", "dim_date", "dim_loan_status")
FACTS = ("fact_loan_disbursement", "fact_repayments", "fact_collections", "fact_transactions")


@dataclass
class PipelineResult:
    run_id: str
    status: str
    audit_log: str
    row_counts: dict[str, int]
    issues: list[dict]
    tables: dict[str, DataFrame] = field(repr=False)

    def raise_on_failure(self) -> None:
        if self.status == "failed":
            raise RuntimeError(f"run {self.run_id} failed: {self.issues}")


Counts = dict[str, int]


def load_bronze(spark: SparkSession, source: str, target: str, multi_line: bool = False) -> tuple[dict, Counts, list]:
    """Stored bronze frames and their row counts by table, and the tables whose extract is missing."""
    ingested_at = F.lit(datetime.now(timezone.utc).replace(microsecond=0))
    bronze, counts, missing = {}, {}, []
    for table, columns in SOURCE_COLUMNS.items():
        rows = read_bronze_csv(spark, f"{source}/{table}.csv", columns, ingested_at, multi_line)
        if rows is None:
            missing.append(table)
            bronze[table], counts[table] = empty_bronze(spark, columns), 0
        else:
            bronze[table], counts[table] = write_counted(rows, f"{target}/bronze/{table}")
    return bronze, counts, missing


def build_silver(bronze: dict[str, DataFrame], target: str) -> tuple[dict, Counts, dict, Counts]:
    """Stored silver and quarantine frames by table, each with its row counts."""
    silver: dict[str, DataFrame] = {}
    quarantine: dict[str, DataFrame] = {}
    accepted: Counts = {}
    rejected: Counts = {}
    for table in SILVER_ORDER:
        rules = RULES[table]
        checked = stage(check(bronze[table], rules, silver, stored=SILVER_ORDER))
        firsts = stage(repeated_keys(checked))
        silver[table], accepted[table] = write_counted(
            to_silver(accept_unshuffled(checked, firsts), rules), f"{target}/silver/{table}"
        )
        quarantine[table], rejected[table] = write_counted(
            reject(checked, rules, staged=True, firsts=firsts), f"{target}/quarantine/{table}_errors"
        )
    return silver, accepted, quarantine, rejected


def build_gold(silver: dict[str, DataFrame], target: str) -> tuple[dict[str, DataFrame], Counts]:
    """Stored gold tables and their row counts. Facts and the summary start from stored tables."""
    gold: dict[str, DataFrame] = {}
    counts: Counts = {}
    dimensions = GoldPlan(silver.__getitem__)
    for name in DIMENSIONS:
        rows = conform(dimensions.table(name), GOLD[name])
        if name == "dim_date":
            rows = rows.orderBy("date_key")  # one row per day
        gold[name], counts[name] = write_counted(rows, f"{target}/gold/{name}")
    facts = GoldPlan(silver.__getitem__, gold.__getitem__)
    for name in FACTS:
        gold[name], counts[name] = write_fact(conform(facts.table(name), GOLD[name]), name, f"{target}/gold/{name}")
    named = gold["fact_loan_disbursement"].join(F.broadcast(gold["dim_loan_status"]), "loan_status_key")
    summary = conform(portfolio_summary(named), GOLD["portfolio_summary"])
    gold["portfolio_summary"], counts["portfolio_summary"] = write_counted(summary, f"{target}/gold/portfolio_summary")
    return gold, counts


def run_pipeline(spark: SparkSession, source: str, target: str, multi_line: bool = False) -> PipelineResult:
    """Read ``source``/<table>.csv, write all layers under ``target`` and return the report."""
    started = datetime.now(timezone.utc)
    run_id = started.strftime("%Y%m%dT%H%M%SZ")

    bronze, loaded, missing = load_bronze(spark, source, target, multi_line)
    silver, accepted, quarantine, rejected = build_silver(bronze, target)
    gold, stored = build_gold(silver, target)

    per_table = [(t, loaded[t], accepted[t], rejected[t]) for t in SOURCE_COLUMNS]
    checked = spark.createDataFrame(per_table, "`table` string, source bigint, accepted bigint, rejected bigint")
    gold_counts = spark.createDataFrame(
        [(f"gold.{name}", rows) for name, rows in stored.items()], "name string, row_count bigint"
    )
    absent = spark.createDataFrame(
        [(t, "source_file_exists", "error", f"Missing source file: {source}/{t}.csv", 1) for t in missing], ISSUE_SCHEMA
    )
    counts = layer_counts(checked).filter(~F.col("name").isin([f"bronze.{t}" for t in missing])).union(gold_counts)
    issues = absent.unionByName(quality_issues(checked))

    audit_log = f"{target}/logs/etl_runs/{run_id}-{uuid.uuid4().hex[:8]}"
    run = {"run_id": F.lit(run_id), "started_at": F.lit(run_id), "completed_at": now()}
    layers = {layer: f"{target}/{layer}" for layer in ("bronze", "silver", "gold", "quarantine")}
    record = audit_record(issues, counts, run, layers)
    write_json(record, audit_log)

    report = record.select("status", "quality.row_counts", "quality.issues").first()
    return PipelineResult(
        run_id,
        report["status"],
        audit_log,
        dict(report["row_counts"]),
        [issue.asDict() for issue in report["issues"]],
        {
            **{f"silver.{t}": df for t, df in silver.items()},
            **{f"quarantine.{t}": df for t, df in quarantine.items()},
            **{f"gold.{t}": df for t, df in gold.items()},
        },
    )


def gold_constraints(tables: dict[str, DataFrame]) -> DataFrame:
    return constraint_tests(lambda name: tables[f"gold.{name}"])
