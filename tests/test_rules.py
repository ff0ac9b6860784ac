import random
from datetime import date
from decimal import Decimal

import pytest

from creditlake.functions.scalars import clean, code, money
from creditlake.operators.quality import duplicate_key_count, not_null_failures, relationship_failures, unique_failures
from creditlake.operators.rules import RuleSet, accept, accept_checked, check, explain_rows, reject, to_silver
from creditlake.plans.silver import RULES, SilverPlan, latest_version, merge_increment
from creditlake.sources.schemas import SOURCE_COLUMNS


def bronze(spark, table, rows):
    columns = SOURCE_COLUMNS[table]
    data = [(*[row.get(c) for c in columns], n) for n, row in enumerate(rows)]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in columns) + ", _row_seq bigint")


def customer(**changes):
    row = dict(customer_id="c1", first_name="amina", last_name="o'neil", branch_id="b1", signup_date="2024-01-02", monthly_income="10")
    return {**row, **changes}


def loan(**changes):
    row = dict(
        loan_id="l1",
        customer_id="c1",
        product_id="p1",
        branch_id="b1",
        disbursement_date="2024-01-02",
        loan_amount="100",
        interest_rate="12.345",
        term_months="12.7",
        loan_status=" active ",
    )
    return {**row, **changes}


def lake(spark, **tables):
    defaults = {
        "branches": [dict(branch_id="B1", branch_name=" Main ", region="R")],
        "products": [dict(product_id="P1", product_name="n", product_type="t", base_rate="12.5")],
        "customers": [customer()],
        "loans": [loan()],
    }
    rows = {t: [] for t in SOURCE_COLUMNS} | defaults | tables
    return SilverPlan({t: bronze(spark, t, r) for t, r in rows.items()})


def reasons(plan, table):
    return sorted(r["error_reason"] for r in plan.quarantine(table).collect())


def test_blank_required_fields_are_named_in_order(spark):
    plan = lake(spark, customers=[customer(customer_id=" \t", last_name=None, monthly_income="0")])
    assert reasons(plan, "customers") == ["customer_id|last_name|monthly_income"]


def test_first_valid_row_wins(spark):
    rows = [customer(first_name=""), customer(email="1"), customer(email="2"), customer(first_name="")]
    plan = lake(spark, customers=rows)
    assert reasons(plan, "customers") == [
        "duplicate_customer_id",
        "first_name",
        "first_name|duplicate_customer_id",
    ]
    assert [r["email"] for r in plan.table("customers").collect()] == ["1"]


def test_loan_reason_order_and_cascade(spark):
    rows = [loan(), loan(customer_id="", loan_amount="-1", loan_status="X")]
    assert reasons(lake(spark, loans=rows), "loans") == [
        "customer_id|loan_amount|loan_status|duplicate_loan_id|unknown_customer_id"
    ]
    plan = lake(spark, customers=[customer(monthly_income="-1")])
    assert reasons(plan, "loans") == ["unknown_customer_id"]


def test_unknown_parents_do_not_reserve_a_key(spark):
    rows = [loan(product_id="P9", branch_id="zz"), loan()]
    plan = lake(spark, loans=rows)
    assert reasons(plan, "loans") == ["unknown_product_id|unknown_branch_id"]
    assert plan.table("loans").count() == 1


def test_loan_is_cleaned_and_typed(spark):
    row = lake(spark).table("loans").first()
    assert (row["loan_id"], row["loan_status"], str(row["interest_rate"]), row["term_months"]) == ("L1", "ACTIVE", "12.34", 12)
    assert lake(spark, loans=[loan(term_months="0.5")]).table("loans").first()["term_months"] == 0


def test_unreadable_fact_date_is_quarantined_last(spark):
    plan = lake(spark, loans=[loan(disbursement_date="2024-2-3", product_id="none")])
    assert reasons(plan, "loans") == ["unknown_product_id|invalid_disbursement_date"]


def test_collections_take_unreadable_amounts_as_zero(spark):
    row = dict(collection_id="k1", loan_id="l1", customer_id="c1", collector_id="a", action_date="2024-01-01")
    plan = lake(spark, collections=[{**row, "amount_recovered": "abc"}, {**row, "collection_id": "k2", "amount_recovered": "-1"}])
    assert [str(r["amount_recovered"]) for r in plan.table("collections").collect()] == ["0.00"]
    assert reasons(plan, "collections") == ["negative_amount_recovered"]


def test_fraud_alert_score_rule(spark):
    row = dict(alert_id="a1", transaction_id="t", customer_id="c1", alert_timestamp="2024-01-01", rule_name="R", risk_score="0")
    plan = lake(spark, fraud_alerts=[row, {**row, "risk_score": "72.9", "alert_timestamp": "2024-01-01T10:00:00+00:00"}])
    assert reasons(plan, "fraud_alerts") == ["invalid_risk_score"]
    kept = plan.table("fraud_alerts").first()
    assert (kept["risk_score"], kept["rule_name"], str(kept["alert_timestamp"])) == (72, "r", "2024-01-01 10:00:00")


def test_reference_tables_are_trimmed_but_keep_their_case(spark):
    row = lake(spark, branches=[dict(branch_id=" b1 ", branch_name=" Main St ", region=None)]).table("branches").first()
    assert tuple(row) == ("B1", "Main St", "")


def test_missing_columns_count_as_blank(spark):
    rows = spark.createDataFrame([("c1", 1)], "customer_id string, _row_seq bigint")
    rejected = reject(check(rows, RULES["customers"], {}), RULES["customers"]).first()
    assert rejected["error_reason"] == "first_name|last_name|branch_id|signup_date|monthly_income"


def sequential(rows):
    """One pass in order: the definition of "first valid row wins"."""
    seen, out = set(), []
    for key, amount, parent in rows:
        before = ([] if key.strip() else ["id"]) + ([] if amount > 0 else ["amount"])
        duplicate = ["duplicate_id"] if key.strip().upper() in seen else []
        after = [] if parent in ("A", "B") else ["unknown_parent"]
        if not (before + duplicate + after):
            seen.add(key.strip().upper())
        out.append("|".join(before + duplicate + after))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_duplicate_rule_matches_a_sequential_pass(spark, seed):
    random.seed(seed)
    keys = ["x", " X", "y", "Y ", "z", "", "hot", "hot", "hot"]
    rows = [(random.choice(keys), random.choice([0, 1, 1]), random.choice("AABC")) for _ in range(400)]
    frame = spark.createDataFrame(
        [(n, k, str(a), p, n) for n, (k, a, p) in enumerate(rows)],
        "n int, id string, amount string, parent string, _row_seq bigint",
    ).repartition(7)
    rules = RuleSet("t", "id", required=("id",), positive=("amount",), parents=(("parent", "parents"),))
    parents = {"parents": spark.createDataFrame([("A",), ("B",)], "parent string")}
    checked = check(frame, rules, parents)
    found = {r["n"]: r["error_reason"] for r in explain_rows(checked, rules).collect()}
    expected = sequential(rows)
    assert [found[n] for n in range(len(rows))] == expected
    kept = sorted(n for n, reason in enumerate(expected) if not reason)
    assert sorted(int(r["n"]) for r in to_silver(accept(frame, rules, parents), rules).collect()) == kept
    assert sorted(int(r["n"]) for r in accept_checked(checked).collect()) == kept


def test_exact_copies_are_kept_once(spark):
    plan = lake(spark, customers=[customer()] * 50)
    assert plan.table("customers").count() == 1
    assert reasons(plan, "customers") == ["duplicate_customer_id"] * 49


def test_duplicate_key_count_ignores_blanks(spark):
    rows = spark.createDataFrame([("LN1",), ("LN1",), ("",), (None,), ("LN2",)], "loan_id string")
    assert duplicate_key_count(rows, "loan_id").first()[0] == 1


def test_latest_version_takes_the_newest_row(spark):
    rows = [
        loan(disbursement_date="2024-01-02", due_date="2024-03-01"),
        loan(disbursement_date="2024-02-02", loan_amount="0"),
        loan(disbursement_date="2024-01-09", loan_id=" L1"),
        loan(disbursement_date="bad", loan_id="l1"),
    ]
    found = latest_version(bronze(spark, "loans", rows), "loans", "_row_seq").collect()
    assert [str(r["disbursement_date"]) for r in found] == ["2024-01-09"]


def test_increment_replaces_older_and_equal_dates(spark):
    make = lambda rows: spark.createDataFrame(rows, "loan_id string, disbursement_date date, loan_status string")
    day = [date(2024, 1, n) for n in range(1, 4)]
    stored = make([("a", day[0], "old"), ("b", day[1], "old"), ("c", day[2], "old")])
    incoming = make([("a", day[1], "new"), ("b", day[1], "new"), ("c", day[0], "late"), ("d", day[0], "new")])
    merged = merge_increment(stored, incoming, "loans").collect()
    assert sorted((r["loan_id"], r["loan_status"]) for r in merged) == [("a", "new"), ("b", "new"), ("c", "old"), ("d", "new")]


def test_numbers_too_large_are_rejected_and_never_become_zero(spark):
    rules = RuleSet("t", "id", required=("id",), columns={"id": code, "amount": money, "note": clean})
    texts = ["999999999999999.99", "1000000000000000", "-1e20", "abc", "", None, "NaN", "Infinity"]
    rows = spark.createDataFrame([(f"K{i}", t, "n", i) for i, t in enumerate(texts)], "id string, amount string, note string, _row_seq bigint")
    kept = {r["id"]: r["amount"] for r in to_silver(accept(rows, rules, {}), rules).collect()}
    assert set(kept) == {"K0", "K3", "K4", "K5", "K6"} and kept["K0"] == Decimal("999999999999999.99")
    reasons = {r["id"]: r["error_reason"] for r in reject(check(rows, rules, {}), rules).collect()}
    assert reasons == {k: "out_of_range_amount" for k in ("K1", "K2", "K7")}


def test_constraints_count_what_is_broken(spark):
    rows = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "zz")], "id int, ref string")
    assert {tuple(r) for r in not_null_failures(rows, "id", "ref").collect()} == {("id", 1), ("ref", 1)}
    assert unique_failures(rows, "id").first()[0] == 1
    parents = spark.createDataFrame([("a",), ("c",)], "name string")
    assert relationship_failures(rows, "ref", parents, "name").first()[0] == 2


def test_dirty_branches_go_to_quarantine(spark):
    rows = [dict(branch_id="B1", branch_name="x"), dict(branch_id=" b1 ", branch_name="y"), dict(branch_name="z")]
    plan = SilverPlan({"branches": bronze(spark, "branches", rows)})
    assert [r["branch_id"] for r in plan.table("branches").collect()] == ["B1"]
    reasons = sorted(r["error_reason"] for r in plan.quarantine("branches").collect())
    assert reasons == ["branch_id", "duplicate_branch_id"]
