"""The registered queries: every operator over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import (
    MONEY,
    alert_rule,
    customer_segment,
    now,
    padded_id,
    parse_decimal,
    risk_score,
    run_id,
    utilization_band,
)
from ..functions.sql import register_sql_functions
from ..operators.alerts import score_alerts
from ..operators.keys import dedupe_first, dedupe_rejects, dense_keys, latest_per_key, newer_than, upsert
from ..operators.quality import (
    NOT_NULL,
    audit_record,
    constraint_tests,
    duplicate_key_count,
    layer_counts,
    quality_issues,
    quality_status,
    union_all,
)
from ..operators.rules import count_rejected
from ..operators.schedule import instalment_schedule, large_movements, with_due_date
from ..operators.skew import lookup_join, shared_folder, stage
from ..sources.catalog import publish_bucketed, publish_tables, publish_views, read_raw
from ..sources.io import append_jsonl, fact_by_year, read_jsonl, with_metadata, write_csv, write_json
from ..sources.schemas import GOLD, SOURCE_COLUMNS, STREAM_ALERT, conform
from ..sources.tpch import LINE_ORDER, TpchExtracts, line_amount
from ..streaming.alerts import end_period, read_alerts, read_events, read_log, start_alerts, write_events
from ..streaming.log import runs
from .gold import GoldPlan, loan_balances, loan_rollup, loan_status_names, total_by
from .incremental import IncrementalStore
from .pipeline import PipelineResult, run_pipeline
from .silver import RULES, SILVER_ORDER, SilverPlan, latest_version, merge_increment

Query = Callable[[SparkSession, str], DataFrame]

SOURCES = ("branches", "products", "customers", "loans", "repayments", "mobile_transactions", "collections", "fraud_alerts")
GOLD_TABLES = tuple(GOLD)


def _silver(spark: SparkSession, folder: str) -> SilverPlan:
    return SilverPlan(TpchExtracts(spark, folder))


# The columns of loans that a query uses, where it does not use all.
_LOAN_COLUMNS = {
    "loan_balances": ("loan_amount",),
    "portfolio_summary": ("loan_amount", "loan_status"),
    "dim_date": ("disbursement_date",),
    "dim_customer": ("customer_id", "loan_amount", "loan_status"),
    "dim_loan_status": ("loan_status",),
    "fact_loan_disbursement": (
        "customer_id", "product_id", "branch_id", "disbursement_date", "loan_amount", "interest_rate", "term_months", "loan_status",
    ),
}

# The silver table that each gold query reads more than once: loans as rows and
# as parents of their children, the others for their hot keys and their rows.
_READ_TWICE = {
    "fact_repayments": "repayments",
    "fact_collections": "collections",
    "fact_transactions": "mobile_transactions",
}


def _kept_silver(spark: SparkSession, folder: str, table: str = "loans", query: str = "") -> SilverPlan:
    columns = {"loans": _LOAN_COLUMNS[query]} if query in _LOAN_COLUMNS else None
    return SilverPlan(TpchExtracts(spark, folder), keep=(table,), columns=columns)


def _silver_query(table: str) -> Query:
    return lambda spark, folder: _silver(spark, folder).table(table)


def _quarantine_query(table: str) -> Query:
    return lambda spark, folder: _silver(spark, folder).quarantine(table)


def _gold(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return GoldPlan(_kept_silver(spark, folder, _READ_TWICE.get(name, "loans"), name).table).table(name)


def _gold_query(name: str) -> Query:
    return lambda spark, folder: conform(_gold(spark, folder, name), GOLD[name])


def _latest_query(table: str) -> Query:
    return lambda spark, folder: latest_version(TpchExtracts(spark, folder)[table], table, "_row_seq")


def loan_rollup_query(spark: SparkSession, folder: str) -> DataFrame:
    return loan_rollup(_silver(spark, folder).table("loans"))


def repayments_by_loan(spark: SparkSession, folder: str) -> DataFrame:
    return total_by(_silver(spark, folder).table("repayments"), "loan_id", "amount_paid", "amount_repaid")


def recoveries_by_loan(spark: SparkSession, folder: str) -> DataFrame:
    return total_by(_silver(spark, folder).table("collections"), "loan_id", "amount_recovered", "amount_recovered")


def loan_balances_query(spark: SparkSession, folder: str) -> DataFrame:
    silver = _kept_silver(spark, folder, query="loan_balances")
    balances = loan_balances(silver.table("loans"), silver.table("repayments"), silver.table("collections"))
    return balances.select("loan_id", "loan_amount", "amount_repaid", "amount_recovered", "outstanding_amount")


def loan_statuses(spark: SparkSession, folder: str) -> DataFrame:
    return loan_status_names(_silver(spark, folder).table("loans"))


def segment_bands(spark: SparkSession, folder: str) -> DataFrame:
    """Customers per segment and utilization band."""
    silver = _silver(spark, folder)
    joined = silver.table("customers").join(loan_rollup(silver.table("loans")), "customer_id", "left")
    none = F.lit(0)
    return (
        joined.select(
            customer_segment("monthly_income", F.coalesce("defaulted_loans", none)).alias("customer_segment"),
            utilization_band(F.coalesce("total_disbursed", none)).alias("loan_utilization_band"),
        )
        .groupBy("customer_segment", "loan_utilization_band")
        .agg(F.count(F.lit(1)).alias("customers"))
    )


def risk_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Score and rule of every transaction with no earlier alerts, and with three."""
    amount = F.col("amount")
    return TpchExtracts(spark, folder).movements().select(
        "transaction_id",
        risk_score(amount, "transaction_type").alias("score_unaided"),
        risk_score(amount, "transaction_type", 3).alias("score_after_three"),
        alert_rule(amount, "transaction_type").alias("rule_name"),
    )


def sql_risk_score(spark: SparkSession, folder: str) -> DataFrame:
    """The same scores through the registered SQL functions."""
    register_sql_functions(spark)
    TpchExtracts(spark, folder).movements().createOrReplaceTempView("creditlake_movements")
    return spark.sql(
        """SELECT transaction_id, transaction_risk_score(amount, transaction_type, 0) AS score_unaided,
                  transaction_risk_score(amount, transaction_type, 3) AS score_after_three
           FROM creditlake_movements"""
    )


def large_movements_query(spark: SparkSession, folder: str) -> DataFrame:
    found = large_movements(TpchExtracts(spark, folder).mobile_transactions())
    return found.select("transaction_id", "customer_id", "transaction_type", parse_decimal("amount").cast(MONEY).alias("amount"))


def surrogate_key_range(spark: SparkSession, folder: str) -> DataFrame:
    orders = TpchExtracts(spark, folder).read("orders")
    return dense_keys(orders.select(padded_id("LN", "o_orderkey", 7).alias("loan_id")), "loan_id", "loan_key")


def _line_rows(spark: SparkSession, folder: str) -> DataFrame:
    lines = TpchExtracts(spark, folder).lines()
    key = F.concat(padded_id("LN", "l_orderkey", 7), F.lit("-"), F.col("l_linenumber").cast("string"))
    return lines.withColumn("line_key", key)


_LINE_OUT = ("line_key", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


def dedupe_first_by_key(spark: SparkSession, folder: str) -> DataFrame:
    return dedupe_first(_line_rows(spark, folder), "line_key", "_row_seq").select(*_LINE_OUT)


def dedupe_first_by_key_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return dedupe_rejects(_line_rows(spark, folder), "line_key", "_row_seq").select(*_LINE_OUT, "error_reason")


def duplicate_key_count_query(spark: SparkSession, folder: str) -> DataFrame:
    return duplicate_key_count(_line_rows(spark, folder), "line_key")


def latest_by_key(spark: SparkSession, folder: str) -> DataFrame:
    ties = (*LINE_ORDER[1:], "_row_seq")
    return latest_per_key(_line_rows(spark, folder), "line_key", "l_shipdate", *ties).select(*_LINE_OUT)


def incremental_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Lines shipped up to the mark are the current table; later ones arrive as an increment."""
    lines = _line_rows(spark, folder)
    mark = F.lit("1999-12-31").cast("timestamp_ntz")
    ties = (*LINE_ORDER[1:], "_row_seq")
    current = latest_per_key(lines.filter(F.col("l_shipdate") <= mark), "line_key", "l_shipdate", *ties)
    merged = upsert(current, newer_than(lines, "l_shipdate", mark), "line_key", "l_shipdate", *ties)
    return merged.select(*_LINE_OUT)


def incremental_collections(spark: SparkSession, folder: str) -> DataFrame:
    """Silver collections stored up to a date, merged with a later load that overlaps it."""
    collections = SilverPlan(TpchExtracts(spark, folder), keep=("collections",)).table("collections")
    stored = collections.filter(F.col("action_date") <= F.lit("2000-06-30").cast("date"))
    incoming = newer_than(collections, "action_date", F.lit("1999-12-31").cast("date"))
    return merge_increment(stored, incoming, "collections")


def _changed(collections: DataFrame) -> DataFrame:
    """Corrections of stored collections: some at the same date, some moved a year on, some too old to count."""
    number = F.substring("collection_id", 4, 20).cast("bigint")
    of = {"same": number % 7 == 0, "later": number % 11 == 3, "older": number % 13 == 5}
    one = F.lit(1).cast(MONEY)
    parts = {
        "same": collections.filter(of["same"]).withColumn("amount_recovered", (F.col("amount_recovered") * 2).cast(MONEY)),
        "later": collections.filter(of["later"]).withColumns(
            {"action_date": F.date_add("action_date", 400), "amount_recovered": (F.col("amount_recovered") + one).cast(MONEY)}
        ),
        "older": collections.filter(of["older"]).withColumns(
            {"action_date": F.date_add("action_date", -400), "outcome": F.lit("too_old")}
        ),
    }
    return union_all(parts.values())


def incremental_load(spark: SparkSession, folder: str) -> DataFrame:
    """Collections stored by year: a first load, an increment from its mark on, and one with changed rows."""
    collections = SilverPlan(TpchExtracts(spark, folder), keep=("collections",)).table("collections")
    store = IncrementalStore(spark, f"{shared_folder(spark)}/store-{uuid.uuid4().hex}")
    first = F.col("action_date") <= F.lit("2000-06-30").cast("date")
    store.load("collections", collections.filter(first))
    store.load("collections", store.fresh("collections", collections))
    store.load("collections", _changed(collections))
    return store.table("collections")


def _database(spark: SparkSession) -> str:
    """A new database in the shared folder."""
    name = f"creditlake_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_folder(spark)}/{name}'")
    return name


def bucketed_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Repayments per customer segment, from the stored fact and dimension that share their buckets."""
    database = _database(spark)
    gold = GoldPlan(_kept_silver(spark, folder, "repayments").table)
    # Both number the same customers, so keys agree.
    names = ("dim_customer", "fact_repayments")
    publish_bucketed({n: conform(gold.table(n), GOLD[n]) for n in names}, database, buckets=8)
    return segments_of_repayments(spark, database)


def segments_of_repayments(spark: SparkSession, database: str) -> DataFrame:
    fact, customers = spark.table(f"{database}.fact_repayments"), spark.table(f"{database}.dim_customer")
    joined = fact.select("customer_key", "amount_paid").join(customers.select("customer_key", "customer_segment"), "customer_key")
    return joined.groupBy("customer_segment").agg(
        F.count(F.lit(1)).alias("repayments"), F.sum("amount_paid").cast("decimal(38,2)").alias("amount_paid")
    )


def customer_statements(spark: SparkSession, folder: str) -> DataFrame:
    """Repayments of the first customers in two years, from the stored fact: partitions and row groups are skipped."""
    database = _database(spark)
    gold = GoldPlan(_kept_silver(spark, folder, "repayments").table)
    publish_tables({"fact_repayments": conform(gold.table("fact_repayments"), GOLD["fact_repayments"])}, database)
    return spark.sql(
        f"""SELECT customer_key, year, count(*) AS repayments, CAST(sum(amount_paid) AS DECIMAL(38,2)) AS amount_paid
            FROM {database}.fact_repayments WHERE year IN (1996, 1997, 2000, 2001) AND customer_key <= 100
            GROUP BY customer_key, year"""
    )


def catalog_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The whole way through named tables: raw tables, silver views over them, and a stored gold table."""
    database = _database(spark)
    extracts = TpchExtracts(spark, folder)
    used = ("branches", "products", "customers", "loans", "repayments", "collections")
    for name in used:
        extracts[name].select("*").write.format("parquet").saveAsTable(f"{database}.{name}")
    raw = {name: read_raw(spark, database, name, "_row_seq") for name in used}
    silver = SilverPlan(raw, keep=("loans",), columns={"loans": _LOAN_COLUMNS["portfolio_summary"]})
    publish_views({name: silver.table(name) for name in ("loans", "repayments", "collections")}, f"{database}_")
    summary = GoldPlan(lambda name: spark.table(f"{database}_{name}")).table("portfolio_summary")
    publish_tables({"portfolio_summary": conform(summary, GOLD["portfolio_summary"])}, database)
    return spark.table(f"{database}.portfolio_summary")


def faulty_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Rejected rows of extracts with faults put in: negative recoveries, scores of 0, repeated branches, blank products."""
    extracts = TpchExtracts(spark, folder)
    number = lambda column, prefix: F.substring(column, prefix + 1, 20).cast("bigint")
    recovered = F.col("amount_recovered").cast(MONEY)
    collections = extracts["collections"].withColumn(
        "amount_recovered",
        F.when(number("collection_id", 3) % 9 == 2, (-recovered - 1).cast(MONEY)).otherwise(recovered).cast("string"),
    )
    alerts = extracts["fraud_alerts"].withColumn(
        "risk_score", F.when(number("alert_id", 3) % 5 == 1, "0").otherwise(F.col("risk_score"))
    )
    again = extracts["branches"].filter(number("branch_id", 2) % 3 == 0)
    branches = extracts["branches"].unionByName(again.withColumn("_row_seq", F.col("_row_seq").withField("file_name", F.lit("~"))))
    products = extracts["products"].withColumn(
        "product_id", F.when(number("product_id", 3) % 50 == 0, " ").otherwise(F.col("product_id"))
    )
    children = SilverPlan({**extracts, "collections": collections, "fraud_alerts": alerts}, keep=("customers", "loans"))
    parents = SilverPlan({"branches": branches, "products": products})
    found = [(children, "collections"), (children, "fraud_alerts"), (parents, "branches"), (parents, "products")]
    return union_all(
        plan.quarantine(t).select(F.lit(t).alias("table"), F.col(RULES[t].key).alias("key"), "error_reason") for plan, t in found
    )


# What the constraint tests read of gold, and the silver columns that this takes.
_TESTED = {table: [c for t, c in NOT_NULL if t == table] for table, _ in NOT_NULL}
_TESTED_SILVER = {
    "branches": ("branch_id",),
    "products": ("product_id",),
    "customers": ("customer_id",),
    "loans": ("customer_id", "product_id", "branch_id", "loan_status"),
}


def _tested_gold(spark: SparkSession, folder: str) -> GoldPlan:
    silver = SilverPlan(TpchExtracts(spark, folder), keep=("loans",), columns=_TESTED_SILVER)
    return GoldPlan(silver.table, staged=True, columns=_TESTED)


def broken_constraints(spark: SparkSession, folder: str) -> DataFrame:
    """The constraint tests over gold tables with missing keys, repeated products and unknown customers."""
    gold = _tested_gold(spark, folder)
    key = F.col("customer_key")

    def table(name: str) -> DataFrame:
        rows = gold.table(name)
        if name == "dim_customer":
            return rows.withColumn("customer_key", F.when(key % 10 != 0, key))
        if name == "dim_product":
            return rows.unionByName(rows.filter("product_key <= 5"))
        if name == "fact_loan_disbursement":
            return rows.withColumn("customer_key", F.when(key % 4 == 0, key + 1000000).otherwise(key))
        return rows

    return constraint_tests(table)


def audit_issues(spark: SparkSession, folder: str) -> DataFrame:
    """The stored audit of a run that has lost a repayment: its status and issues, read back from JSON."""
    lost = F.when(F.col("table") == "repayments", 1).otherwise(0)
    checked = stage(_checked_counts(_staged_silver(spark, folder, _KEYS)).withColumn("accepted", F.col("accepted") - lost))
    path = f"{shared_folder(spark)}/audit-{uuid.uuid4().hex}"
    run = {"run_id": run_id(now()), "started_at": run_id(now()), "completed_at": now()}
    write_json(audit_record(quality_issues(checked), layer_counts(checked), run, {"silver": f"{path}/silver"}), path)
    schema = "status string, quality struct<row_counts: map<string, bigint>, issues: array<struct<`table`: string, check_name: string, severity: string, message: string, failed_count: bigint>>>"
    audit = spark.read.schema(schema).json(path)
    issues = audit.select("status", "quality.row_counts", F.inline("quality.issues"))
    return issues.withColumn("bronze_rows", F.col("row_counts")[F.concat(F.lit("bronze."), F.col("table"))]).drop("row_counts")


def jsonl_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts appended to JSON lines in two runs, and read back."""
    extracts = TpchExtracts(spark, folder)
    found = stage(score_alerts(_of_known_customers(extracts.stream_events(), extracts), 60))
    path = f"{shared_folder(spark)}/alerts-{uuid.uuid4().hex}"
    first = F.col("risk_score") >= 75
    append_jsonl(found.filter(first), path)
    append_jsonl(found.filter(~first), path)
    return read_jsonl(spark, path, STREAM_ALERT).select(*_ALERT_OUT)


def sql_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Segment and band of every customer through the registered SQL functions."""
    register_sql_functions(spark)
    silver = _silver(spark, folder)
    rolled = silver.table("customers").join(loan_rollup(silver.table("loans")), "customer_id", "left")
    rolled.createOrReplaceTempView("creditlake_customers")
    return spark.sql(
        """SELECT customer_id, customer_segment(monthly_income, coalesce(defaulted_loans, 0)) AS customer_segment,
                  loan_utilization_band(coalesce(total_disbursed, 0)) AS loan_utilization_band
           FROM creditlake_customers"""
    )


def line_amounts_half_even(spark: SparkSession, folder: str) -> DataFrame:
    lines = TpchExtracts(spark, folder).read("lineitem")
    return lines.select("l_orderkey", "l_linenumber", line_amount().alias("amount"))


def instalment_schedule_query(spark: SparkSession, folder: str) -> DataFrame:
    return instalment_schedule(_silver(spark, folder).table("loans"))


def loan_due_dates(spark: SparkSession, folder: str) -> DataFrame:
    return with_due_date(_silver(spark, folder).table("loans")).select("loan_id", "disbursement_date", "term_months", "due_date")


_ALERT_OUT = ("alert_id", "transaction_id", "customer_id", "rule_name", "risk_score", "alert_status")


def _of_known_customers(events: DataFrame, extracts: TpchExtracts) -> DataFrame:
    """Events whose customer is in the silver layer."""
    customers = SilverPlan(extracts).table("customers").select("customer_id", F.lit(True).alias("_known"))
    return lookup_join(events, customers, "customer_id").filter("_known").drop("_known")


def _alerts(threshold: int) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        extracts = TpchExtracts(spark, folder)
        events = _of_known_customers(extracts.stream_events(), extracts)
        return score_alerts(events, threshold).select(*_ALERT_OUT)

    return query


def alerts_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """A second run over a log whose unaided alerts are already known: they are skipped."""
    events = TpchExtracts(spark, folder).stream_events()
    scored = risk_score(parse_decimal("amount"), "transaction_type")
    known = events.filter(scored >= 80).select(F.concat(F.lit("STREAM-"), "event_id").alias("alert_id"))
    return score_alerts(events, 60, known=known).select(*_ALERT_OUT)


def repeated_events(spark: SparkSession, folder: str) -> DataFrame:
    """The events, and every third of them once more: an hour later, at twice the amount, as cash-out."""
    events = TpchExtracts(spark, folder).stream_events()
    again = events.filter(F.col("event_id").cast("bigint") % 3 == 0).withColumns(
        {
            "event_time": F.col("event_time") + F.expr("INTERVAL 1 HOUR"),
            "amount": (F.col("amount").cast("decimal(18,2)") * 2).cast("decimal(18,2)").cast("string"),
            "transaction_type": F.lit("cash_out"),
        }
    )
    return events.unionByName(again)


def alerts_repeated_events(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts where event ids come again with other amounts: the first occurrence that alerts counts."""
    return score_alerts(repeated_events(spark, folder), 60).select(*_ALERT_OUT)


# The events are streamed as two periods, the second of which starts here.
SECOND_PERIOD = datetime(2024, 1, 16, tzinfo=timezone.utc)


def _streamed_alerts(spark: SparkSession, folder: str) -> str:
    """The streaming job over the events as JSON lines, one run per period; the folder of its output.

    Each period is four files, written by as many tasks in whatever order these
    end, and read two at a time.
    """
    extracts = TpchExtracts(spark, folder)
    work = f"{shared_folder(spark)}/alerts-{uuid.uuid4().hex}"
    known = stage(_of_known_customers(extracts.stream_events(), extracts)).withColumn("event_time", F.col("event_time").cast("timestamp"))
    second = F.col("event_time") >= F.lit(SECOND_PERIOD)
    for period, until in ((~second, SECOND_PERIOD), (second, datetime(2100, 1, 1, tzinfo=timezone.utc))):
        write_events(known.filter(period).repartitionByRange(4, "event_time"), f"{work}/in")
        end_period(spark, f"{work}/in", until, "31 days")
        events = read_events(spark, f"{work}/in", files_per_batch=2)
        start_alerts(events, f"{work}/out", f"{work}/progress", delay="31 days", partitions=4).awaitTermination()
    return f"{work}/out"


def alerts_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The alerts of the streaming job."""
    return read_alerts(spark, _streamed_alerts(spark, folder)).select(*_ALERT_OUT)


def alerts_stream_log(spark: SparkSession, folder: str) -> DataFrame:
    """The log of the streaming job: events, alerts and threshold of its two runs."""
    lines = runs(read_log(spark, _streamed_alerts(spark, folder)))
    run = F.row_number().over(W.orderBy("first_batch"))  # a row per run
    return lines.select(run.alias("run"), "events_processed", "alerts_emitted", "threshold")


def _checked_counts(silver: SilverPlan) -> DataFrame:
    """Source, accepted and rejected rows of every table, each taken on its own."""

    def counts(table: str) -> DataFrame:
        one = F.count(F.lit(1))
        return (
            silver.bronze[table].agg(one.alias("source"))
            .crossJoin(silver.table(table).agg(one.alias("accepted")))
            .crossJoin(count_rejected(silver.checked(table)))
            .select(F.lit(table).alias("table"), "source", "accepted", "rejected")
        )

    return union_all(counts(t) for t in SILVER_ORDER)


def _staged_silver(spark: SparkSession, folder: str, columns: Mapping[str, Sequence[str]]) -> SilverPlan:
    """Silver that is staged without raw values, for queries that count its rows several times."""
    return SilverPlan(TpchExtracts(spark, folder), staged=True, columns=columns)


# Counting the rows of silver takes their keys alone.
_KEYS = {table: (RULES[table].key,) for table in SILVER_ORDER}


def quality_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per layer and table, gold included."""
    silver = _staged_silver(spark, folder, {})
    gold = GoldPlan(silver.table)  # over staged rows
    one = F.count(F.lit(1)).alias("row_count")
    stored = [gold.table(n).agg(one).select(F.lit(f"gold.{n}").alias("name"), "row_count") for n in GOLD_TABLES]
    return layer_counts(_checked_counts(silver)).unionByName(union_all(stored))


def quality_issues_query(spark: SparkSession, folder: str) -> DataFrame:
    return quality_issues(_checked_counts(_staged_silver(spark, folder, _KEYS)))


def quality_status_query(spark: SparkSession, folder: str) -> DataFrame:
    return quality_status(quality_issues_query(spark, folder))


def gold_constraint_tests(spark: SparkSession, folder: str) -> DataFrame:
    return constraint_tests(_tested_gold(spark, folder).table)


def bronze_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Every line item with its ingest metadata; the time of the run is dropped from the result."""
    raw = with_metadata(TpchExtracts(spark, folder).read("lineitem"), now())
    return raw.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", F.col("_source_file").alias("source_file"))


def fact_repayments_by_year(spark: SparkSession, folder: str) -> DataFrame:
    """The stored layout of the repayment fact, summed per year."""
    laid_out = fact_by_year(_gold(spark, folder, "fact_repayments"), "fact_repayments")
    return laid_out.groupBy("year").agg(
        F.count(F.lit(1)).alias("repayments"), F.sum("amount_paid").cast("decimal(38,2)").alias("amount_paid")
    )


def _csv_run(spark: SparkSession, folder: str) -> PipelineResult:
    """The whole run over CSV extracts of the given tables, written to the shared folder first."""
    work = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"
    extracts = TpchExtracts(spark, folder)
    for name in SOURCES:
        write_csv(extracts[name].orderBy("_row_seq"), f"{work}/in/{name}.csv", SOURCE_COLUMNS[name], "gzip")
    return run_pipeline(spark, f"{work}/in", f"{work}/lake")


def csv_run_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per layer and table that the run reports."""
    counts = _csv_run(spark, folder).row_counts
    return spark.createDataFrame(sorted(counts.items()), "name string, row_count bigint")


def csv_run_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _csv_run(spark, folder).tables["gold.portfolio_summary"]


def csv_run_repayments_by_year(spark: SparkSession, folder: str) -> DataFrame:
    """The stored repayment fact, per year of its partitions."""
    return _csv_run(spark, folder).tables["gold.fact_repayments"].groupBy("year").agg(
        F.count(F.lit(1)).alias("repayments"), F.sum("amount_paid").cast("decimal(38,2)").alias("amount_paid")
    )


QUERIES: dict[str, Query] = {
    **{f"silver_{t}": _silver_query(t) for t in SOURCES},
    **{f"quarantine_{t}": _quarantine_query(t) for t in SOURCES},
    **{f"latest_{t}": _latest_query(t) for t in ("customers", "loans", "repayments", "mobile_transactions", "collections")},
    **{name: _gold_query(name) for name in GOLD_TABLES},
    "dedupe_first_by_key": dedupe_first_by_key,
    "dedupe_first_by_key_rejects": dedupe_first_by_key_rejects,
    "duplicate_key_count": duplicate_key_count_query,
    "latest_by_key": latest_by_key,
    "incremental_upsert": incremental_upsert,
    "incremental_collections": incremental_collections,
    "loan_rollup": loan_rollup_query,
    "repayments_by_loan": repayments_by_loan,
    "recoveries_by_loan": recoveries_by_loan,
    "loan_balances": loan_balances_query,
    "loan_statuses": loan_statuses,
    "surrogate_key_range": surrogate_key_range,
    "segment_bands": segment_bands,
    "risk_score": risk_scores,
    "sql_risk_score": sql_risk_score,
    "large_movements": large_movements_query,
    "alerts_batch": _alerts(75),
    "alerts_batch_60": _alerts(60),
    "alerts_incremental": alerts_incremental,
    "alerts_repeated_events": alerts_repeated_events,
    "alerts_stream": alerts_stream,
    "alerts_stream_log": alerts_stream_log,
    "quality_row_counts": quality_row_counts,
    "quality_issues": quality_issues_query,
    "quality_status": quality_status_query,
    "gold_constraint_tests": gold_constraint_tests,
    "bronze_metadata": bronze_metadata,
    "fact_repayments_by_year": fact_repayments_by_year,
    "csv_run_counts": csv_run_counts,
    "csv_run_summary": csv_run_summary,
    "csv_run_repayments_by_year": csv_run_repayments_by_year,
    "faulty_rejects": faulty_rejects,
    "broken_constraints": broken_constraints,
    "audit_issues": audit_issues,
    "jsonl_alerts": jsonl_alerts,
    "sql_segments": sql_segments,
    "incremental_load": incremental_load,
    "bucketed_segments": bucketed_segments,
    "customer_statements": customer_statements,
    "catalog_summary": catalog_summary,
    "line_amounts_half_even": line_amounts_half_even,
    "instalment_schedule": instalment_schedule_query,
    "loan_due_dates": loan_due_dates,
}
