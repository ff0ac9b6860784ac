"""Named tables: raw tables in a database, silver as views, gold as stored tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .io import FACT_LAYOUT, fact_by_year
from .schemas import SOURCE_COLUMNS


def read_raw(spark: SparkSession, database: str, table: str, order: str | None = None) -> DataFrame:
    """A raw warehouse table as bronze rows. ``order`` names a column that orders its rows.

    Without one the place of the row in the table's files is the order.
    """
    if order:
        return spark.table(f"{database}.{table}").withColumn("_row_seq", F.struct(order))
    place = F.struct(F.col("_metadata.file_name"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    return spark.table(f"{database}.{table}").withColumn("_row_seq", place)


def raw_tables(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    return {table: read_raw(spark, database, table) for table in SOURCE_COLUMNS}


def publish_views(tables: Mapping[str, DataFrame], prefix: str = "silver_") -> None:
    """Silver tables as temporary views: nothing is computed until they are read."""
    for name, rows in tables.items():
        rows.createOrReplaceTempView(f"{prefix}{name}")


def publish_tables(tables: Mapping[str, DataFrame], database: str) -> None:
    """Gold tables as stored tables; facts are partitioned by year and clustered within."""
    for name, rows in tables.items():
        if name in FACT_LAYOUT:
            writer = fact_by_year(rows, name).write.partitionBy("year")
        else:
            writer = rows.write
        writer.mode("overwrite").format("parquet").saveAsTable(f"{database}.{name}")


def publish_bucketed(tables: Mapping[str, DataFrame], database: str, buckets: int, key: str = "customer_key") -> None:
    """Gold tables as stored tables bucketed by ``key``, those that have it, so that they join on it without a shuffle.

    Facts are also partitioned by year. Rows are sorted by ``key`` and then by the
    clustering columns, so that readers skip row groups. A bucket with more than
    its share of the rows is written by several tasks, dealt by row id. It is
    still read by one task: where one key holds much of a fact, join with
    ``spark.sql.sources.bucketing.enabled`` off, and Spark splits it.
    """
    for name, rows in tables.items():
        if key not in rows.columns:
            publish_tables({name: rows}, database)
            continue
        order, row_id = [key], key
        if name in FACT_LAYOUT:
            date_column, clustering, row_id = FACT_LAYOUT[name]
            rows = rows.withColumn("year", F.floor(F.col(date_column) / 10000).cast("int"))
            order = ["year", key, *[c for c in clustering if c != key], row_id]
        # The bucket that Spark's writer gives a row.
        rows = rows.withColumn("_bucket", F.pmod(F.hash(key), F.lit(buckets)))
        sizes = rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows"))
        share = sizes.agg(F.greatest(F.sum("_rows") / buckets, F.lit(1)).alias("_share"))
        tasks = sizes.crossJoin(F.broadcast(share)).select("_bucket", F.ceil(F.col("_rows") / F.col("_share")).alias("_tasks"))
        dealt = rows.join(F.broadcast(tasks), "_bucket")  # a row per bucket
        dealt = dealt.withColumn("_task", F.pmod(F.xxhash64(row_id), F.col("_tasks")))
        laid_out = dealt.repartition(buckets, "_bucket", "_task").drop("_bucket", "_task", "_tasks").sortWithinPartitions(*order)
        writer = laid_out.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(*[c for c in order if c != "year"])
        if "year" in order:
            writer = writer.partitionBy("year")
        writer.saveAsTable(f"{database}.{name}")
