"""Incremental loads into stored tables: partitions by year, and a mark per table.

A load merges new and changed rows by key. The newest row of a key by the table's
date wins, and at equal dates the incoming one. Only the years that the increment
touches are read in full and written, by dynamic partition overwrite; of other
years the key column is read, as a row whose date has moved to another year must
leave its old one.

A load that is lost half-way is run again with the same rows: merging is
idempotent, and the mark moves last.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import latest_per_key, newer_than
from ..operators.rules import RuleSet
from ..operators.skew import lookup_join, stage
from .silver import INCREMENTAL_DATE, RULES, merge_increment


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error.getCondition()):
            return None
        raise


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of the store that Spark writes to."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


class IncrementalStore:
    """Tables under ``folder``/<table>/year=..., and their marks under ``folder``/_marks."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def table(self, table: str) -> DataFrame | None:
        """The stored rows; filter on ``year`` to prune partitions."""
        return _stored(self.spark, self.path(table))

    def mark(self, table: str) -> date | datetime | None:
        """The newest date of the loads so far."""
        marks = _stored(self.spark, f"{self.folder}/_marks/{table}")
        return None if marks is None else marks.agg(F.max("mark")).first()[0]

    def fresh(self, table: str, source: DataFrame) -> DataFrame:
        """The rows of ``source`` from the mark on: those of the mark's own date may have grown."""
        mark = self.mark(table)
        return source if mark is None else newer_than(source, INCREMENTAL_DATE[table], F.lit(mark))

    def touched(self, table: str, incoming: DataFrame) -> list[int]:
        """The years that ``incoming`` (with ``year``) brings rows to or takes rows from."""
        years = incoming.select("year").distinct()
        stored = self.table(table)
        if stored is not None:
            rules: RuleSet = RULES[table]
            keys = incoming.select(rules.key, F.lit(True).alias("_comes"))
            found = lookup_join(stored.select(rules.key, "year"), keys, rules.key).filter("_comes")
            years = years.union(found.select("year").distinct()).distinct()
        return sorted(row["year"] for row in years.collect())  # years, not rows

    def load(self, table: str, incoming: DataFrame) -> list[int]:
        """Merge ``incoming`` into the table; returns the years that were written or emptied.

        Of several versions of a key in ``incoming`` the newest counts; they must
        differ in their date. Rows without a date belong to year 0.
        """
        moment = INCREMENTAL_DATE[table]
        year = F.coalesce(F.year(moment), F.lit(0)).alias("year")
        rows = stage(latest_per_key(incoming, RULES[table].key, moment).select("*", year))
        years = self.touched(table, rows)
        stored = self.table(table)
        merged = rows
        if stored is not None:
            before = stored.filter(F.col("year").isin(years)).select(*rows.columns)
            merged = merge_increment(before, rows, table)
        merged = stage(merged)
        writer = merged.repartitionByRange("year", RULES[table].key).sortWithinPartitions("year", RULES[table].key).write
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(self.path(table))
        left = {row["year"] for row in merged.select("year").distinct().collect()}
        for gone in set(years) - left:
            drop_folder(self.spark, f"{self.path(table)}/year={gone}")
        # The newest date of what has come, also of rows that lost against a stored one.
        rows.agg(F.max(moment).alias("mark")).filter("mark IS NOT NULL").coalesce(1).write.mode("append").parquet(
            f"{self.folder}/_marks/{table}"
        )
        return years
