"""Readers and writers: CSV extracts, bronze, JSON lines, and partitioned facts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The date key and clustering columns of the stored facts, with the row's own
# id last so that equal clustering values can still be split between tasks.
FACT_LAYOUT: dict[str, tuple[str, tuple[str, ...], str]] = {
    "fact_loan_disbursement": ("disbursement_date_key", ("branch_key", "product_key", "loan_status_key"), "loan_id"),
    "fact_repayments": ("repayment_date_key", ("customer_key", "payment_channel"), "repayment_id"),
    "fact_collections": ("action_date_key", ("collector_id", "outcome"), "collection_id"),
    "fact_transactions": ("transaction_date_key", ("customer_key", "transaction_type"), "transaction_id"),
}


def _or_none(read, path: str) -> DataFrame | None:
    try:
        return read(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error.getCondition()):
            return None
        raise


def _empty(spark: SparkSession, columns: Iterable[str]) -> DataFrame:
    return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))


def read_csv(
    spark: SparkSession, path: str, columns: Sequence[str] = (), multi_line: bool = False
) -> DataFrame | None:
    """A CSV extract with a header, every column as text. None when the path is missing.

    Columns come from the header; those of ``columns`` that it lacks are NULL.
    The files of a folder must have the same header; another order or name fails
    the read instead of moving values between columns. With ``multi_line`` a
    quoted field may hold line breaks, and then a file is read by one task;
    without it files are split.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    reader = reader.option("enforceSchema", False)
    rows = _or_none(reader.csv, path)
    if rows is None:
        return None
    missing = [c for c in columns if c not in rows.columns]
    return rows.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else rows


def file_order() -> Column:
    """The place of a row: file, block, and position within the block."""
    return F.struct(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def with_metadata(rows: DataFrame, ingested_at: Column) -> DataFrame:
    """Raw rows with ingest time, source file and row order. ``rows`` comes straight from files."""
    return rows.withColumns(
        {"_ingested_at": ingested_at, "_source_file": F.col("_metadata.file_name"), "_row_seq": file_order()}
    )


def read_bronze_csv(
    spark: SparkSession, path: str, columns: Sequence[str], ingested_at: Column, multi_line: bool = False
) -> DataFrame | None:
    rows = read_csv(spark, path, (), multi_line)
    if rows is None:
        return None
    rows = with_metadata(rows, ingested_at)
    missing = [c for c in columns if c not in rows.columns]
    return rows.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else rows


def empty_bronze(spark: SparkSession, columns: Sequence[str]) -> DataFrame:
    order = F.struct(F.lit("").alias("file"), F.lit(0).cast("bigint").alias("block"), F.lit(0).cast("bigint").alias("row"))
    return _empty(spark, columns).withColumns(
        {"_ingested_at": F.lit(None).cast("timestamp"), "_source_file": F.lit(""), "_row_seq": order}
    )


def write_csv(rows: DataFrame, path: str, columns: Sequence[str] | None = None, compression: str = "none") -> None:
    """A CSV extract with a header. A compressed file is read by one task; each task that writes makes one."""
    rows.select(*(columns or rows.columns)).write.mode("overwrite").option("header", True).option(
        "escape", '"'
    ).option("compression", compression).csv(path)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON objects, one per line; blank lines are skipped, a malformed line fails the read."""
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    rows = _or_none(reader.json, path)
    return spark.createDataFrame([], schema) if rows is None else rows


def append_jsonl(rows: DataFrame, path: str) -> None:
    """Append objects with sorted keys."""
    rows.select(*sorted(rows.columns)).write.mode("append").json(path)


def write_json(record: DataFrame, path: str) -> None:
    """A one-row frame as one JSON object."""
    record.coalesce(1).write.mode("overwrite").json(path)


def _counted(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """``rows``, and their number once they have been written.

    The rows are counted in the tasks that write them; of a task that runs again
    only the attempt that succeeds counts.
    """
    observation = Observation()
    return rows.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def write_counted(rows: DataFrame, path: str) -> tuple[DataFrame, int]:
    """Store a frame and read it back, so that later steps start from the files; with its number of rows."""
    counted, observation = _counted(rows)
    counted.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path), observation.get["rows"]


def write_table(rows: DataFrame, path: str) -> DataFrame:
    """Store a frame and read it back."""
    return write_counted(rows, path)[0]


def fact_by_year(fact: DataFrame, name: str) -> DataFrame:
    """A fact laid out for storage: by year, then in the order of its clustering columns.

    Range partitioning on (year, clustering, id) gives even tasks although years
    and clustering values are skewed, few files per year, and files with narrow
    ranges, so that readers skip row groups.
    """
    key, clustering, row_id = FACT_LAYOUT[name]
    order = ("year", *clustering, row_id)
    with_year = fact.withColumn("year", F.floor(F.col(key) / 10000).cast("int"))
    return with_year.repartitionByRange(*order).sortWithinPartitions(*order)


def write_fact(fact: DataFrame, name: str, path: str) -> tuple[DataFrame, int]:
    """Store a fact partitioned by year, and count it. Filter on ``year`` to prune partitions."""
    laid_out = fact_by_year(fact, name)
    counted, observation = _counted(laid_out)
    counted.write.mode("overwrite").option("compression", "zstd").partitionBy("year").parquet(path)
    return fact.sparkSession.read.schema(laid_out.schema).parquet(path), observation.get["rows"]
