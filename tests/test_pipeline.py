import csv
import json
import random
from collections import defaultdict
from datetime import date, timedelta
from decimal import Decimal
from pathlib import Path

import pytest

from creditlake.operators.quality import reconciles, quality_status, ISSUE_SCHEMA
from creditlake.plans.pipeline import gold_constraints, run_pipeline
from creditlake.sources.io import read_csv, write_csv
from creditlake.sources.schemas import GOLD, SOURCE_COLUMNS, conform
from pyspark.sql import functions as F


def extracts(folder: Path, customers=25, seed=7):
    """A small set of consistent extracts with one duplicate, one blank id and one negative amount."""
    rng = random.Random(seed)
    day = lambda n: (date(2024, 1, 1) + timedelta(days=n)).isoformat()
    t = defaultdict(list)
    t["branches"] = [dict(branch_id=f"BR{i:03d}", branch_name=f"Branch, {i}", region="R") for i in range(1, 6)]
    t["products"] = [dict(product_id=f"PRD{i:03d}", product_name=f"P {i}", product_type="x", base_rate="12.50") for i in range(1, 5)]
    for i in range(1, customers + 1):
        t["customers"].append(
            dict(customer_id=f"CUST{i:06d}", first_name="ann", last_name=f"o'hara\n{i}", gender="f", date_of_birth="1990-01-01",
                 phone_number="+1", email="A@B.c", national_id="1", branch_id="BR001", signup_date=day(i),
                 monthly_income=str(rng.randrange(28000, 220000)), employment_status="Salaried")
        )
    t["customers"] += [{**t["customers"][3], "email": "again"}, {**t["customers"][8], "customer_id": ""}]
    for i in range(1, int(customers * 1.15) + 1):
        status = rng.choice(["ACTIVE", "CLOSED", "OVERDUE", "DEFAULTED"])
        amount = rng.randrange(10000, 750000)
        base = dict(loan_id=f"LN{i:07d}", customer_id=f"CUST{rng.randrange(1, customers + 1):06d}")
        t["loans"].append(
            dict(**base, product_id="PRD002", branch_id="BR003", application_date=day(i), disbursement_date=day(i + 3),
                 loan_amount=str(amount), interest_rate="14", term_months="6", loan_status=status, due_date=day(i + 183))
        )
        for k in (1, 2):
            t["repayments"].append(
                dict(repayment_id=f"RP{i:07d}{k:02d}", **base, repayment_date=day(i + 30 * k),
                     amount_paid=f"{Decimal(amount) / 3:.2f}", payment_channel="MPESA")
            )
        if status in ("OVERDUE", "DEFAULTED"):
            t["collections"].append(
                dict(collection_id=f"COL{i:07d}", **base, collector_id="agt1", action_date=day(i + 90),
                     action_type="Call", amount_recovered="0" if i % 2 else "1000", outcome="Contacted")
            )
    t["loans"].append({**t["loans"][0], "loan_id": "LN_BAD", "loan_amount": "-2500.00"})
    for i in range(1, customers * 4 + 1):
        t["mobile_transactions"].append(
            dict(transaction_id=f"TXN{i:08d}", customer_id=f"CUST{rng.randrange(1, customers + 1):06d}", transaction_date=day(i % 60),
                 transaction_type="CASH_OUT", amount=str(rng.randrange(100, 180000)), channel="USSD", merchant_category="Retail")
        )
    t["fraud_alerts"] = [
        dict(alert_id="ALT1", transaction_id="TXN1", customer_id="CUST000001", alert_timestamp=day(1), rule_name="R", risk_score="80", alert_status="open")
    ]
    folder.mkdir(parents=True)
    for name, rows in t.items():
        with open(folder / f"{name}.csv", "w", newline="", encoding="utf-8") as out:
            writer = csv.DictWriter(out, SOURCE_COLUMNS[name])
            writer.writeheader()
            writer.writerows(rows)
    return t


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("lake")
    rows = extracts(folder / "source")
    return rows, folder, run_pipeline(spark, str(folder / "source"), str(folder / "out"), multi_line=True)


def test_counts_status_and_audit(spark, run):
    rows, folder, result = run
    assert result.status == "passed_with_warnings"
    counts = result.row_counts
    assert (counts["bronze.customers"], counts["silver.customers"], counts["quarantine.customers"]) == (27, 25, 2)
    assert (counts["silver.loans"], counts["quarantine.loans"]) == (28, 1)
    assert (counts["silver.branches"], counts["silver.products"], counts["silver.mobile_transactions"]) == (5, 4, 100)
    for table in ("repayments", "collections", "fraud_alerts"):
        assert (counts[f"silver.{table}"], counts[f"quarantine.{table}"]) == (len(rows[table]), 0)
    assert {f"gold.{t}" for t in GOLD} <= set(counts) and counts["gold.portfolio_summary"] == 9
    assert counts["gold.fact_loan_disbursement"] == 28
    assert sorted((i["table"], i["failed_count"]) for i in result.issues) == [("customers", 2), ("loans", 1)]

    audit = json.loads(next(Path(result.audit_log).glob("*.json")).read_text())
    assert audit["run_id"] == audit["quality"]["run_id"] == result.run_id
    assert audit["quality"]["row_counts"] == counts and audit["status"] == "passed_with_warnings"
    assert audit["layers"]["silver"].endswith("/silver")


def test_quarantine_keeps_raw_values(run):
    found = {r["error_reason"]: r for r in run[2].tables["quarantine.customers"].collect()}
    assert set(found) == {"duplicate_customer_id", "customer_id"}
    assert found["duplicate_customer_id"]["email"] == "again"
    assert found["duplicate_customer_id"]["first_name"] == "ann"


def test_quoted_line_breaks_and_commas_survive(run):
    tables = run[2].tables
    assert tables["silver.customers"].filter("customer_id = 'CUST000001'").first()["last_name"] == "O'Hara\n1"
    assert "Branch, 1" in [r["branch_name"] for r in tables["gold.dim_branch"].collect()]


def test_gold_values(run):
    rows, _, result = run
    loans = [r for r in rows["loans"] if Decimal(r["loan_amount"]) > 0]
    paid, recovered = defaultdict(Decimal), defaultdict(Decimal)
    for r in rows["repayments"]:
        paid[r["loan_id"]] += Decimal(r["amount_paid"])
    for r in rows["collections"]:
        recovered[r["loan_id"]] += Decimal(r["amount_recovered"])
    left = {l["loan_id"]: max(Decimal(l["loan_amount"]) - paid[l["loan_id"]] - recovered[l["loan_id"]], Decimal(0)) for l in loans}
    disbursed, book = sum(Decimal(l["loan_amount"]) for l in loans), sum(left.values())
    summary = {r["metric"]: r["value"] for r in result.tables["gold.portfolio_summary"].collect()}
    total_paid, total_recovered = sum(paid.values()), sum(recovered.values())
    assert summary == {
        "total_loan_book": f"{book:.2f}",
        "total_disbursed": f"{disbursed:.2f}",
        "total_repaid": f"{total_paid:.2f}",
        "total_recovered": f"{total_recovered:.2f}",
        "overdue_principal": f"{sum(left[l['loan_id']] for l in loans if l['loan_status'] == 'OVERDUE'):.2f}",
        "repayment_rate_pct": f"{total_paid / disbursed * 100:.2f}",
        "recovery_rate_pct": f"{total_recovered / (total_recovered + book) * 100:.2f}",
        "active_loans": str(sum(l["loan_status"] == "ACTIVE" for l in loans)),
        "defaulted_loans": str(sum(l["loan_status"] == "DEFAULTED" for l in loans)),
    }
    keys = {r["customer_id"]: r["customer_key"] for r in result.tables["gold.dim_customer"].collect()}
    assert keys == {f"CUST{i:06d}": i for i in range(1, 26)}
    statuses = [tuple(r) for r in result.tables["gold.dim_loan_status"].orderBy("loan_status_key").collect()]
    assert statuses == [(1, "ACTIVE"), (2, "CLOSED"), (3, "DEFAULTED"), (4, "OVERDUE")]


def test_facts_are_partitioned_by_year_and_constraints_hold(run):
    _, folder, result = run
    assert [p.name for p in (folder / "out/gold/fact_repayments").glob("year=*")] == ["year=2024"]
    assert gold_constraints(result.tables).agg(F.sum("failures")).first()[0] == 0


def test_dates_are_stored_in_order(spark, run):
    days = []
    for path in sorted((run[1] / "out/gold/dim_date").glob("*.parquet")):
        days += [r["date_key"] for r in spark.read.parquet(str(path)).coalesce(1).collect()]
    assert len(days) > 60 and days == sorted(days)


def test_bronze_metadata(spark, run):
    rows = spark.read.parquet(str(run[1] / "out/bronze/loans"))
    assert {r["_source_file"] for r in rows.collect()} == {"loans.csv"}
    assert rows.select("_ingested_at").distinct().count() == 1


def test_missing_extract_fails_the_run(spark, tmp_path):
    extracts(tmp_path / "source", customers=9)
    (tmp_path / "source/collections.csv").unlink()
    result = run_pipeline(spark, str(tmp_path / "source"), str(tmp_path / "out"))
    assert result.status == "failed" and "bronze.collections" not in result.row_counts
    assert ("collections", "source_file_exists", "error") in [(i["table"], i["check_name"], i["severity"]) for i in result.issues]
    with pytest.raises(RuntimeError):
        result.raise_on_failure()


def test_status_and_reconciliation(spark):
    issue = lambda severity: ("t", "c", severity, "m", 1)
    for issues, status in (([], "passed"), ([issue("warning")], "passed_with_warnings"), ([issue("warning"), issue("error")], "failed")):
        assert quality_status(spark.createDataFrame(issues, ISSUE_SCHEMA)).first()[0] == status
    row = spark.range(1).select(reconciles(F.lit(10), F.lit(8), F.lit(2)), reconciles(F.lit(10), F.lit(7), F.lit(2))).first()
    assert tuple(row) == (True, False)


def test_csv_round_trip_and_not_null(spark, tmp_path):
    frame = spark.createDataFrame([('say "hi", you', None, 1)], "a string, b string, c int")
    write_csv(frame, str(tmp_path / "t"), ["b", "a"])
    back = read_csv(spark, str(tmp_path / "t"), ("a", "z"))
    assert back.columns == ["b", "a", "z"] and back.first()["a"] == 'say "hi", you'
    assert read_csv(spark, str(tmp_path / "none")) is None
    with pytest.raises(Exception, match="must not be NULL"):
        conform(frame.select(F.col("a").alias("metric"), "b").withColumn("metric", F.lit(None)).withColumn("value", F.lit("")), GOLD["portfolio_summary"]).collect()


def test_folders_with_two_header_orders_fail(spark, tmp_path):
    (tmp_path / "t.csv").mkdir()
    (tmp_path / "t.csv" / "a.csv").write_text("id,name,amount\n1,Ann,5\n")
    (tmp_path / "t.csv" / "b.csv").write_text("name,id,amount\nBo,2,6\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path / "t.csv")).collect()


def test_csv_files_are_split(spark, tmp_path):
    lines = "\n".join(f"{i},{'x' * 200}" for i in range(5000))
    (tmp_path / "t.csv").write_text(f"id,name\n{lines}\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        rows = read_csv(spark, str(tmp_path / "t.csv"))
        assert rows.rdd.getNumPartitions() > 4
        assert rows.count() == 5000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
