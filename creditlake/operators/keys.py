"""One row per key, and dense surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .skew import lookup_join, stage

_PARTITION_BITS = 33


def first_per_key(df: DataFrame, key: str, *order: Column | str) -> DataFrame:
    """The first row of every key in the given total order.

    ``row_number() = 1`` lets Spark keep one row per key and task before the
    shuffle (WindowGroupLimit), so a hot key costs no more than any other.
    """
    numbered = df.withColumn("_rank", F.row_number().over(W.partitionBy(key).orderBy(*order)))
    return numbered.filter("_rank = 1").drop("_rank")


def latest_per_key(df: DataFrame, key: str, moment: str, *ties: Column | str) -> DataFrame:
    """The row of every key with the greatest ``moment``; ``ties`` make the order total."""
    return first_per_key(df, key, F.col(moment).desc_nulls_last(), *ties)


def upsert(current: DataFrame, incoming: DataFrame, key: str, moment: str, *ties: Column | str) -> DataFrame:
    """Incremental load: the newest version of every key out of both frames."""
    return latest_per_key(current.unionByName(incoming), key, moment, *ties)


def newer_than(df: DataFrame, moment: str, high_water: Column) -> DataFrame:
    """Rows from the high-water mark of the last load on.

    Rows of the mark itself come again, as more of them may have arrived since;
    a merge by key takes them once.
    """
    return df.filter(F.col(moment) >= high_water)


def dedupe_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of every non-blank key. ``key`` holds cleaned text."""
    return first_per_key(df.filter(F.col(key) != ""), key, order)


def dedupe_rejects(df: DataFrame, key: str, order: str) -> DataFrame:
    """What :func:`dedupe_first` leaves out, with the reason. ``order`` is unique per row."""
    firsts = dedupe_first(df, key, order).select(key, F.col(order).alias("_first"))
    marked = lookup_join(df, firsts, key)
    kept = F.coalesce(F.col(order) == F.col("_first"), F.lit(False))
    return (
        marked.filter(~kept)
        .drop("_first")
        .withColumn("error_reason", F.lit(f"duplicate_or_missing_{key.lstrip('_')}"))
    )


def dense_keys(df: DataFrame, id_column: str, key_name: str) -> DataFrame:
    """Number the rows 1..n in the order of ``id_column``, without a single-task sort.

    Rows are range-partitioned and sorted, then staged with their partition and
    place in it, which therefore cannot change between the two readings that
    follow: the sizes of the partitions, and the rows. Only one number per
    partition is broadcast.
    """
    ranged = stage(
        df.repartitionByRange(id_column)
        .sortWithinPartitions(id_column)
        .withColumn("_position", F.monotonically_increasing_id())
    )
    part = F.shiftright("_position", _PARTITION_BITS)
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = F.col("_position").bitwiseAND(F.lit((1 << _PARTITION_BITS) - 1))
    numbered = ranged.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return numbered.select(
        (F.col("_offset") + inside + 1).alias(key_name), *[F.col(c) for c in df.columns]
    )


def small_dense_keys(df: DataFrame, id_column: str, key_name: str) -> DataFrame:
    """The same numbering in one task, for frames whose size is fixed by a rule."""
    return df.select(F.row_number().over(W.orderBy(id_column)).cast("bigint").alias(key_name), "*")
