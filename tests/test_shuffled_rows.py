"""What the extracts and the silver layer take through their shuffles."""

from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from creditlake.operators.keys import first_per_key
from creditlake.operators.quality import constraint_tests
from creditlake.operators.rules import (
    RuleSet,
    accept,
    accept_checked,
    accept_unshuffled,
    check,
    count_rejected,
    explain_rows,
    reject,
    repeated_keys,
)
from creditlake.operators.skew import lookup_join, stage
from creditlake.plans.gold import GoldPlan, loan_balances
from creditlake.plans.queries import _TESTED, _TESTED_SILVER
from creditlake.plans.silver import RULES, SilverPlan
from creditlake.sources.io import read_csv, write_csv
from creditlake.sources.tpch import LINE_ORDER, TpchExtracts

LINE = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
)


def line(order, number, day, part=1, price=10.5, flag="N"):
    when = None if day is None else datetime(1997, 1, day)
    return (order, part, 1, number, 2.0, price, 0.1, 0.05, flag, "O", when)


@pytest.fixture
def extracts(spark, tmp_path):
    rows = [
        line(1, 1, 3),
        line(1, 2, 3),
        line(2, 1, 9), line(2, 1, 4, part=9),  # another date
        line(3, 1, 5, price=20.0), line(3, 1, 5, price=None), line(3, 1, 5, price=7.25),  # one date
        line(4, 1, 5), line(4, 1, 5),  # the same row twice
        line(5, 1, None, part=8), line(5, 1, None, part=6),
        line(None, 1, 5), line(None, 2, 5),
        line(1234567, 801, 6, part=5), line(12345678, 1, 6, part=4),  # one id
    ]
    spark.createDataFrame(rows, LINE).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    return TpchExtracts(spark, str(tmp_path))


def test_only_lines_that_tie_take_their_whole_order_along(extracts):
    lines = extracts.lines().select("l_orderkey", "l_linenumber", F.col("_row_seq.later").isNotNull().alias("whole"))
    found = Counter((r["l_orderkey"], r["whole"]) for r in lines.collect())
    assert found == {
        (1, False): 2, (2, False): 2, (3, True): 3, (4, True): 2, (5, True): 2,
        (None, True): 2, (1234567, True): 1, (12345678, True): 1,
    }


def test_first_line_of_an_id_is_the_one_of_the_whole_order(extracts):
    lines = extracts.lines().withColumn("id", extracts._line_id("RP")).filter("id is not null")
    place = (F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    whole = extracts.read("lineitem").select("*", *place).withColumn("id", extracts._line_id("RP")).filter("id is not null")
    columns = ["id", *LINE_ORDER]
    found = first_per_key(lines, "id", "_row_seq").select(*columns).collect()
    expected = first_per_key(whole, "id", *LINE_ORDER, "file", "row").select(*columns).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, expected))
    assert len(found) == 7


def test_loans_of_orders_that_come_twice_or_lack_lines(spark, tmp_path):
    day = datetime(1997, 1, 10)
    orders = [(1, 1, "F", 10.5, day, "2-HIGH"), (1, 1, "O", 11.5, day, "3-LOW"), (2, 7, "P", 12.0, day, "1-URGENT"), (None, 1, "F", None, None, None)]
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    spark.createDataFrame(orders, schema).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([line(1, 1, 3, part=5), line(1, 2, 3, part=4), line(None, 1, 3)], LINE).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(4, 40), (4, 41)], "p_partkey bigint, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(1, 3)], "c_custkey bigint, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    found = TpchExtracts(spark, str(tmp_path)).loans().drop("_row_seq", "application_date").collect()
    paid = ("1997-01-10", "1997-03-11"), ("1997-01-10", "1997-04-10"), ("1997-01-10", "1997-02-09")
    assert Counter(map(tuple, found)) == Counter(
        [
            *[("LN0000001", "CUST000001", "PRD000004", "BR003", paid[0][0], "10.50", s, "6", "CLOSED", "1997-07-09") for s in ("40", "41")],
            *[("LN0000001", "CUST000001", "PRD000004", "BR003", paid[1][0], "11.50", s, "9", "ACTIVE", "1997-10-07") for s in ("40", "41")],
            ("LN0000002", "CUST000007", None, None, paid[2][0], "12.00", None, "3", "OVERDUE", "1997-04-10"),
            (None, "CUST000001", None, "BR003", None, None, None, None, "CLOSED", None),
        ]
    )


PLAIN = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_lookups_are_shuffled_once(spark):
    for name, value in PLAIN.items():
        spark.conf.set(name, value)
    try:
        rows = spark.range(1000).select((F.col("id") % 7).alias("k"))
        kept = stage(spark.range(5).select(F.col("id").alias("k"), F.lit(True).alias("known")))
        joined = lookup_join(rows, kept, "k", stored=True)
        assert executed(joined).count("Exchange") + 1 == executed(lookup_join(rows, kept, "k")).count("Exchange")
        assert joined.filter("known").count() == sum(1 for i in range(1000) if i % 7 < 5)
    finally:
        for name in PLAIN:
            spark.conf.unset(name)


RULE = RuleSet(
    "things", "id", required=("id", "parent"), positive=("amount",), parents=(("parent", "parents"),),
    columns={**{c: RULES["loans"].columns["loan_id"] for c in ("id", "parent")}, "amount": RULES["loans"].columns["loan_amount"]},
)


def things(spark):
    rows = [("a", "p", "1"), ("A ", "p", "2"), ("a", "q", "0"), ("b", "q", "3"), ("b", "p", "4"), ("c", "p", "x"), ("c", "q", "1"), ("", "p", "1"), ("d", "p", "5")]
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "id string, parent string, amount string, _row_seq bigint")


def test_cleaning_comes_before_the_lookups(spark):
    parents = {"parents": spark.createDataFrame([("P",)], "parent string")}
    cleaned = accept(things(spark), RULE, parents, ["id", "amount"])
    assert dict(cleaned.dtypes) == {"amount": "decimal(18,2)", "_row_seq": "bigint", "_key": "string", "_ref_parent": "string"}
    assert sorted((r["_key"], float(r["amount"])) for r in cleaned.collect()) == [("A", 1.0), ("B", 4.0), ("D", 5.0)]
    checked = check(things(spark), RULE, parents, ["id"])
    assert checked.columns == ["_row_seq", "_key", "_before", "_after"]
    reasons = [r["error_reason"] for r in explain_rows(checked, RULE).collect()]
    assert Counter(reasons) == Counter(r["error_reason"] for r in explain_rows(check(things(spark), RULE, parents), RULE).collect())
    assert Counter(reasons) == Counter(
        ["", "duplicate_id", "amount|duplicate_id|unknown_parent", "unknown_parent", "", "amount", "unknown_parent", "id", ""]
    )


def test_plans_without_raw_values(spark):
    rows = [("P1", "name", "kind", "1.5"), ("p1", "again", "kind", "2"), (" ", "none", "kind", "3")]
    raw = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "product_id string, product_name string, product_type string, base_rate string, _row_seq bigint")
    plan = SilverPlan({"products": raw}, staged=True, columns={"products": ("product_id",)})
    assert [tuple(r) for r in plan.table("products").collect()] == [("P1",)]
    assert set(plan.checked("products").columns) == {"_row_seq", "_key", "_before", "_after"}
    with pytest.raises(ValueError):
        plan.quarantine("products")
    every = SilverPlan({"products": raw}, staged=True, columns={})
    assert every.table("products").columns == SilverPlan({"products": raw}).table("products").columns
    assert every.table("products").collect() == SilverPlan({"products": raw}).table("products").collect()


def test_constraint_tests_make_only_what_they_test(spark):
    """The same figures as over whole gold tables, without the silver rows that only sums need."""
    text = lambda rows, *names: spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    money = lambda rows, *names: rows.withColumns({n: F.col(n).cast("decimal(18,2)") for n in names})
    silver = {
        "branches": text([("B1", "Main", "East")], "branch_id", "branch_name", "region"),
        "products": text([("P1", "One", "loan", "5"), ("P2", "Two", "loan", None)], "product_id", "product_name", "product_type", "base_rate"),
        "customers": money(
            text([(f"C{i}", "A", "B", "F", "B1", "2024-01-01", "900") for i in range(4)],
                 "customer_id", "first_name", "last_name", "gender", "branch_id", "signup_date", "monthly_income"),
            "monthly_income",
        ).withColumn("signup_date", F.col("signup_date").cast("date")),
        "loans": money(
            text([(f"L{i}", f"C{i % 5}", f"P{i % 3}", "B1", "2024-02-01", "100", "5", "12", ("ACTIVE", "CLOSED")[i % 2]) for i in range(20)],
                 "loan_id", "customer_id", "product_id", "branch_id", "disbursement_date", "loan_amount", "interest_rate", "term_months", "loan_status"),
            "loan_amount",
        ).withColumn("disbursement_date", F.col("disbursement_date").cast("date")),
        "repayments": money(text([("R1", "L1", "10"), ("R2", "L1", "5")], "repayment_id", "loan_id", "amount_paid"), "amount_paid"),
        "collections": money(text([("K1", "L2", "3")], "collection_id", "loan_id", "amount_recovered"), "amount_recovered"),
    }
    asked = set()

    def used(table):
        asked.add(table)
        key = {"branches": "branch_id", "products": "product_id", "customers": "customer_id", "loans": "loan_id"}[table]
        return silver[table].select(key, *[c for c in _TESTED_SILVER[table] if c != key])

    whole = GoldPlan(silver.__getitem__, staged=True)
    short = GoldPlan(used, staged=True, columns=_TESTED)
    rows = lambda gold: Counter(map(tuple, constraint_tests(gold.table).collect()))
    assert rows(short) == rows(whole) and len(rows(whole)) == 18
    assert asked == {"branches", "products", "customers", "loans"}
    for table, columns in _TESTED.items():
        status = ["loan_status"] if table == "dim_loan_status" else []  # numbered by it
        assert sorted(short.table(table).columns) == sorted([*columns, *status])
        assert Counter(short.table(table).collect()) == Counter(whole.table(table).select(*short.table(table).columns).collect())
    assert short.table("fact_loan_disbursement").count() > 0


def rows_of(df):
    return Counter(tuple(str(v) for v in r) for r in df.collect())


def test_only_rows_of_repeated_keys_are_shuffled(spark):
    """Accepted and rejected rows are those of the plain forms, without a shuffle of rows whose key comes once."""
    parents = {"parents": spark.createDataFrame([("P",)], "parent string")}
    checked = stage(check(things(spark), RULE, parents))
    firsts = stage(repeated_keys(checked))
    assert sorted(r["_key"] for r in firsts.collect()) == ["A", "B"]
    accepted, rejected = accept_unshuffled(checked, firsts), reject(checked, RULE, staged=True)
    assert rows_of(accepted) == rows_of(accept_checked(checked)) and accepted.count() == 3
    plain = explain_rows(checked, RULE).filter("error_reason != ''")
    assert rejected.columns == plain.columns and rows_of(rejected) == rows_of(plain) and rejected.count() == 6
    for found in (accepted, rejected):
        plan = executed(found)
        assert "Union" in plan and "Exchange" not in plan[plan.index("Union") :].split("FileScan")[0]
    [counted] = count_rejected(checked).collect()
    assert counted["rejected"] == 6 and count_rejected(checked.limit(0)).first()["rejected"] == 0


def test_keys_alone_need_no_order(spark):
    parents = {"parents": spark.createDataFrame([("P",)], "parent string")}
    whole, keys = accept(things(spark), RULE, parents), accept(things(spark), RULE, parents, ["id"])
    assert keys.columns == ["_key"] and "Window" not in executed(keys)
    assert sorted(r["_key"] for r in keys.collect()) == sorted(r["_key"] for r in whole.collect()) == ["A", "B", "D"]
    checked = stage(check(things(spark), RULE, parents, ["id"]))
    assert rows_of(accept_checked(checked, RULE, ["id"])) == rows_of(keys)


def test_compressed_extracts_keep_their_rows(spark, tmp_path):
    rows = spark.createDataFrame([("a", 'say "x", y'), ("b", None), ("c", " z ")], "id string, note string")
    write_csv(rows, f"{tmp_path}/plain.csv")
    write_csv(rows, f"{tmp_path}/packed.csv", compression="gzip")
    assert list(tmp_path.glob("packed.csv/*.csv.gz")) and list(tmp_path.glob("plain.csv/*.csv"))
    assert rows_of(read_csv(spark, f"{tmp_path}/packed.csv")) == rows_of(read_csv(spark, f"{tmp_path}/plain.csv"))


def test_what_grows_with_the_data_is_not_broadcast(spark):
    """Rows of a fact, sums per loan and first rows per key would be broadcast by the size of their files."""
    customers = stage(spark.range(90_000).select(F.concat(F.lit("C"), F.col("id").cast("string")).alias("customer_id")))
    paid = stage(
        spark.range(100).select(
            F.concat(F.lit("R"), F.col("id").cast("string")).alias("repayment_id"), F.concat(F.lit("L"), (F.col("id") % 9).cast("string")).alias("loan_id"),
            F.concat(F.lit("C"), F.col("id").cast("string")).alias("customer_id"), F.lit("2024-01-01").cast("date").alias("repayment_date"),
            F.lit(1).cast("decimal(18,2)").alias("amount_paid"), F.lit("x").alias("payment_channel"),
        )
    )
    fact = GoldPlan({"customers": customers, "repayments": paid}.__getitem__).table("fact_repayments")
    assert fact.count() == 100 and "SortMergeJoin" in executed(fact) and "BuildLeft" not in executed(fact)
    loans = stage(spark.range(9).select(F.concat(F.lit("L"), F.col("id").cast("string")).alias("loan_id"), F.lit(50).cast("decimal(18,2)").alias("loan_amount")))
    recovered = paid.select("loan_id", F.lit(1).cast("decimal(18,2)").alias("amount_recovered")).limit(3)
    balances = loan_balances(loans, paid, recovered)
    assert "BroadcastHashJoin" not in executed(balances)
    assert balances.agg(F.sum("outstanding_amount")).first()[0] == 450 - 100 - 3
    checked = stage(check(things(spark), RULE, {"parents": spark.createDataFrame([("P",)], "parent string")}))
    assert "BroadcastHashJoin" not in executed(count_rejected(checked)) and count_rejected(checked).first()["rejected"] == 6
