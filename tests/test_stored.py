"""Incremental loads, bucketed tables and counted writes."""

import random
import subprocess
import sys
import textwrap
from datetime import date, timedelta
from decimal import Decimal
from pathlib import Path

from creditlake.plans.incremental import IncrementalStore
from creditlake.plans.queries import segments_of_repayments
from creditlake.sources.catalog import publish_bucketed, publish_tables
from creditlake.sources.io import write_counted, write_fact
from creditlake.sources.schemas import GOLD, conform
from pyspark.sql import functions as F

COLUMNS = "collection_id string, loan_id string, customer_id string, collector_id string, action_date date, action_type string, amount_recovered decimal(18,2), outcome string"


def collections(spark, rows):
    return spark.createDataFrame([(f"COL{i}", "LN", "CU", "AGT", day, "call", Decimal(amount), "x") for i, day, amount in rows], COLUMNS)


def content(store):
    return {int(r["collection_id"][3:]): (r["action_date"], int(r["amount_recovered"]), r["year"]) for r in store.table("collections").collect()}


def merged(stored, rows):
    """Newest date first; at equal dates the incoming row."""
    for i, day, amount in sorted(rows, key=lambda r: r[1] or date.min):
        if i not in stored or (day or date.min) >= (stored[i][0] or date.min):
            stored[i] = (day, amount, day.year if day else 0)
    return stored


def files(folder):
    return {p: p.stat().st_mtime_ns for p in Path(folder).glob("collections/year=*/*.parquet")}


def test_loads_match_a_plain_merge_and_touch_only_their_years(spark, tmp_path):
    rng = random.Random(1)
    store, plain = IncrementalStore(spark, str(tmp_path)), {}
    day = lambda: date(2020, 1, 1) + timedelta(days=rng.randrange(1400))
    assert store.mark("collections") is None
    first = [(i, day(), rng.randrange(100)) for i in range(200)]
    store.load("collections", collections(spark, first))
    assert content(store) == merged(plain, first) and store.mark("collections") == max(r[1] for r in first)

    changed = [(i, day(), 1000 + i) for i in range(0, 200, 9)] + [(i, plain[i][0], 2000 + i) for i in range(1, 200, 9)] + [(300, None, 7)]
    store.load("collections", collections(spark, changed))
    assert content(store) == merged(plain, changed)

    before = files(tmp_path)
    some = [(400, date(2021, 5, 5), 1), (next(i for i, r in plain.items() if r[2] == 2021), date(2021, 12, 31), 2)]
    assert store.load("collections", collections(spark, some)) == [2021]
    assert content(store) == merged(plain, some)
    after = files(tmp_path)
    assert {p for p in after if "year=2021" not in str(p)} == {p for p in before if "year=2021" not in str(p)}
    assert all(after[p] == before[p] for p in after.keys() & before.keys() if "year=2021" not in str(p))

    # Loading the same once more changes nothing.
    store.load("collections", collections(spark, some))
    assert content(store) == plain
    plan = store.table("collections").filter(F.col("year").isin([2021]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan or "PartitionFilters: [(year" in plan


def test_a_year_whose_rows_have_moved_is_gone(spark, tmp_path):
    store = IncrementalStore(spark, str(tmp_path))
    store.load("collections", collections(spark, [(1, date(2019, 3, 1), 1), (2, date(2020, 3, 1), 2)]))
    assert store.load("collections", collections(spark, [(1, date(2021, 3, 1), 3)])) == [2019, 2021]
    assert content(store) == {1: (date(2021, 3, 1), 3, 2021), 2: (date(2020, 3, 1), 2, 2020)}
    assert not (tmp_path / "collections/year=2019").exists()
    assert store.mark("collections") == date(2021, 3, 1)
    new = store.fresh("collections", collections(spark, [(5, date(2021, 3, 1), 1), (6, date(2021, 2, 28), 1)]))
    assert [r["collection_id"] for r in new.collect()] == ["COL5"]


def gold_tables(spark):
    """A fact half of which belongs to one customer."""
    fact = spark.range(20000).select(
        F.concat(F.lit("RP"), "id").alias("repayment_id"),
        F.lit("LN").alias("loan_id"),
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 500).alias("customer_key"),
        (F.lit(20200101) + (F.col("id") % 3) * 10000).cast("int").alias("repayment_date_key"),
        F.lit(2).alias("amount_paid"),
        F.lit("mpesa").alias("payment_channel"),
    )
    customers = spark.range(500).select(
        F.col("id").alias("customer_key"), F.concat(F.lit("C"), "id").alias("customer_id"), F.lit("n").alias("full_name"), F.lit("F").alias("gender"),
        F.lit("BR").alias("branch_id"), F.lit(None).alias("signup_date"), F.lit(1).alias("monthly_income"),
        F.when(F.col("id") % 3 == 0, "premium").otherwise("emerging").alias("customer_segment"), F.lit("x").alias("loan_utilization_band"),
        F.lit(None).alias("effective_from"), F.lit(None).alias("effective_to"), F.lit(True).alias("is_current"),
    )
    return {"fact_repayments": conform(fact, GOLD["fact_repayments"]), "dim_customer": conform(customers, GOLD["dim_customer"])}


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    spark.sql(f"CREATE DATABASE bucketed LOCATION '{tmp_path}/bucketed'")
    publish_bucketed(gold_tables(spark), "bucketed", 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = segments_of_repayments(spark, "bucketed")
        rows = {r["customer_segment"]: (r["repayments"], r["amount_paid"]) for r in found.collect()}
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    premium = sum((i % 500) % 3 == 0 for i in range(1, 20000, 2))
    assert rows == {"premium": (premium, 2 * premium), "emerging": (20000 - premium, 2 * (20000 - premium))}
    final = plan.split("== Initial Plan ==")[0]
    join = final.index("SortMergeJoin")
    assert "Exchange" in final[:join] and "Exchange" not in final[join:]
    # The hot customer's bucket is written by several tasks.
    per_bucket = {}
    for path in (tmp_path / "bucketed/fact_repayments").glob("year=2020/*.parquet"):
        bucket = path.name.split("_")[-1].split(".")[0]
        per_bucket[bucket] = per_bucket.get(bucket, 0) + 1
    assert len(per_bucket) == 8 and max(per_bucket.values()) >= 3


def _rows_read(frame):
    frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    plan = leaves.head()
    while plan.nodeName().startswith("AdaptiveSpark") or "QueryStage" in plan.nodeName():
        plan = plan.plan() if hasattr(plan, "plan") and "QueryStage" in plan.nodeName() else plan.executedPlan()
        plan = plan.collectLeaves().head()
    return plan.metrics().apply("numOutputRows").value()


def test_clustered_facts_skip_partitions_and_row_groups(spark, tmp_path):
    spark.sql(f"CREATE DATABASE clustered LOCATION '{tmp_path}/clustered'")
    fact = gold_tables(spark)["fact_repayments"]
    spark.conf.set("parquet.block.size", "4096")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    spark._jsc.hadoopConfiguration().set("parquet.block.size", "16384")
    try:
        publish_tables({"fact_repayments": fact}, "clustered")
    finally:
        spark._jsc.hadoopConfiguration().unset("parquet.block.size")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("parquet.block.size")
    few = spark.table("clustered.fact_repayments").filter("year = 2021 AND customer_key > 450")
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(customer_key,450)" in plan and "PartitionFilters: [isnotnull(year" in plan
    assert few.count() == sum(i % 2 == 1 and i % 500 > 450 and i % 3 == 1 for i in range(20000))
    assert _rows_read(few) < 20000 / 3 / 2  # of a third of the rows, in the year


def test_writes_count_their_rows(spark, tmp_path):
    frame, rows = write_counted(spark.range(1000).repartition(7).filter("id % 3 = 0"), str(tmp_path / "a"))
    assert rows == frame.count() == 334
    assert write_counted(spark.createDataFrame([], "a int"), str(tmp_path / "b"))[1] == 0
    assert write_counted(spark.range(10).filter("id < 0"), str(tmp_path / "c"))[1] == 0
    fact, rows = write_fact(gold_tables(spark)["fact_repayments"], "fact_repayments", str(tmp_path / "d"))
    assert rows == fact.count() == 20000


def test_a_task_that_runs_again_is_counted_once(tmp_path):
    """In a session of its own, which retries tasks: every first attempt writes its rows and then fails."""
    script = f"""
        import sys
        sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})
        from pathlib import Path
        from pyspark import TaskContext
        from pyspark.sql import SparkSession
        from creditlake.sources.io import write_counted
        spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").getOrCreate()
        def failing(batches):
            yield from batches
            mark = Path({str(tmp_path)!r}) / f"failed-{{TaskContext.get().partitionId()}}"
            if not mark.exists():
                mark.touch()
                raise RuntimeError("lost")
        rows = spark.range(0, 1000, 1, 4).mapInArrow(failing, "id bigint")
        frame, counted = write_counted(rows, {str(tmp_path / "out")!r})
        print("COUNTED", counted, frame.count())
    """
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(script)], capture_output=True, text=True, timeout=200)
    assert "COUNTED 1000 1000" in done.stdout, done.stderr[-2000:]
    assert len(list(tmp_path.glob("failed-*"))) == 4
