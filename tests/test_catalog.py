from pyspark.sql import functions as F

from creditlake.functions.sql import register_sql_functions
from creditlake.plans.silver import SilverPlan
from creditlake.sources.catalog import publish_tables, publish_views, raw_tables, read_raw
from creditlake.sources.io import fact_by_year
from creditlake.sources.schemas import SOURCE_COLUMNS


def test_raw_tables_feed_silver_views_and_gold_tables(spark, tmp_path):
    spark.sql(f"CREATE DATABASE raw_lending LOCATION '{tmp_path}/raw'")
    try:
        for table, columns in SOURCE_COLUMNS.items():
            rows = spark.range(1).select(*[F.lit("1").alias(c) for c in columns])
            rows.write.saveAsTable(f"raw_lending.{table}")
        silver = SilverPlan(raw_tables(spark, "raw_lending"))
        publish_views({"customers": silver.table("customers")})
        assert spark.sql("SELECT customer_id, first_name FROM silver_customers").collect() == [("1", "1")]
        assert read_raw(spark, "raw_lending", "loans", "loan_id").count() == 1

        fact = spark.range(100).select(
            F.concat(F.lit("R"), "id").alias("repayment_id"),
            F.lit(1).alias("customer_key"),
            (F.lit(20230101) + (F.col("id") % 2) * 10000).alias("repayment_date_key"),
            F.lit("cash").alias("payment_channel"),
        )
        publish_tables({"fact_repayments": fact, "dim_branch": spark.range(3)}, "raw_lending")
        assert spark.table("raw_lending.dim_branch").count() == 3
        year = spark.table("raw_lending.fact_repayments").filter("year = 2024")
        assert year.count() == 50
        assert "PartitionFilters: [isnotnull(year" in year._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.sql("DROP DATABASE raw_lending CASCADE")


def test_one_year_and_one_customer_still_split_between_tasks(spark):
    fact = spark.range(20000).select(
        F.format_string("R%08d", "id").alias("repayment_id"),
        F.lit(1).alias("customer_key"),
        F.lit(20240101).alias("repayment_date_key"),
        F.lit("cash").alias("payment_channel"),
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in fact_by_year(fact, "fact_repayments").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(sizes) == 8 and max(sizes) < 5000


def test_sql_functions(spark):
    register_sql_functions(spark)
    row = spark.sql(
        "SELECT customer_segment(150000, 0), customer_segment(150000, 1), loan_utilization_band(0.01), "
        "transaction_risk_score(150000, 'CASH_OUT', 9), transaction_risk_score(80000, NULL, 0)"
    ).first()
    assert tuple(row) == ("premium", "high_risk", "low_utilization", 99, 45)
