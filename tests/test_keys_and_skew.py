import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from creditlake.operators.keys import dedupe_first, dedupe_rejects, dense_keys, latest_per_key, newer_than, small_dense_keys, upsert
from creditlake.operators.skew import broadcast_limit, lookup_join


def skewed(spark, n=30000):
    """A third of the rows share one key, a third have none; some keys are missing from the lookup."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 5000).cast("string"))
    )
    return spark.range(n).select("id", key.alias("key"))


def lookup(spark):
    some = spark.range(4000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"), F.col("id").alias("value"))
    return some.union(spark.createDataFrame([("hot", -1)], "key string, value bigint"))


SPLITTING = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


def test_lookup_splits_a_key_with_a_third_of_the_rows(spark):
    """Also where the lookup comes from an aggregate, which leaves it partitioned by the key."""
    for name, value in SPLITTING.items():
        spark.conf.set(name, value)
    try:
        rows = skewed(spark, 90000).repartition(12)
        found = lookup(spark).groupBy("key").agg(F.max("value").alias("value"))
        plain = rows.join(found, "key", "left")
        joined = lookup_join(rows, found, "key")
        assert joined.columns == plain.columns
        assert Counter(map(tuple, joined.collect())) == Counter(map(tuple, plain.collect()))
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in SPLITTING:
            spark.conf.unset(name)


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_dense_keys_number_in_order(spark, n):
    ids = [f"C{i:05d}" for i in range(n)]
    random.Random(1).shuffle(ids)
    frame = spark.createDataFrame([(i, i.lower()) for i in ids], "cid string, low string").repartition(5)
    found = sorted((r["key"], r["cid"], r["low"]) for r in dense_keys(frame, "cid", "key").collect())
    assert found == [(k, i, i.lower()) for k, i in enumerate(sorted(ids), start=1)]


def test_small_dense_keys(spark):
    frame = spark.createDataFrame([("b",), ("a",)], "s string")
    assert sorted(map(tuple, small_dense_keys(frame, "s", "k").collect())) == [(1, "a"), (2, "b")]


def test_dedupe_splits_all_rows(spark):
    rows = [("a", 3), ("a", 1), ("", 2), ("b", 4), ("a", 5)]
    frame = spark.createDataFrame(rows, "code string, seq int")
    assert sorted(map(tuple, dedupe_first(frame, "code", "seq").collect())) == [("a", 1), ("b", 4)]
    rejects = dedupe_rejects(frame, "code", "seq").collect()
    assert sorted(map(tuple, rejects)) == [(k, s, "duplicate_or_missing_code") for k, s in [("", 2), ("a", 3), ("a", 5)]]


def test_latest_and_upsert(spark):
    frame = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", None, "z")], "k string, day int, v string")
    assert sorted(r["v"] for r in latest_per_key(frame, "k", "day").collect()) == ["y", "z"]
    newer = newer_than(spark.createDataFrame([("a", 3, "n"), ("b", 0, "o")], "k string, day int, v string"), "day", F.lit(1))
    assert sorted(r["v"] for r in upsert(frame, newer, "k", "day").collect()) == ["n", "z"]


def test_one_row_per_key_is_cut_before_the_shuffle(spark):
    plan = latest_per_key(skewed(spark), "key", "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_lookups_are_broadcast_by_their_rows_not_by_their_files(spark, tmp_path):
    """The files of all three lookups are far below the limit for broadcasts, the rows of the long one are not."""
    rows = spark.range(300).select((F.col("id") * 1000).alias("k"), (F.col("id") % 3).alias("x"))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for n, hint in ((250_000, "SortMergeJoin"), (10, "BroadcastHashJoin")):
        path = f"{tmp_path}/{n}"
        spark.range(0, n, 1, 2).select(F.col("id").alias("k"), F.lit(True).alias("known")).write.option("compression", "zstd").parquet(path)
        assert sum(f.stat().st_size for f in tmp_path.glob(f"{n}/*.parquet")) < broadcast_limit(spark) / 5
        joined = lookup_join(rows, spark.read.parquet(path), "k", stored=True)
        for found in (joined, joined.filter("known")):
            assert hint in plan(found) and "BuildLeft" not in plan(found)
        assert joined.count() == 300 and joined.filter("known").count() == -(-min(n, 300_000) // 1000)
    grown = lookup_join(rows, rows.groupBy("k").agg(F.count("*").alias("n")), "k", grows=True)
    assert "BroadcastHashJoin" not in plan(grown) and grown.filter("n = 1").count() == 300


@pytest.mark.parametrize("limit, expected", [("-1", -1), ("10485760b", 10 << 20), ("256k", 256 << 10), ("10MB", 10 << 20), ("7", 7)])
def test_broadcast_limit_reads_sizes(spark, limit, expected):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        assert broadcast_limit(spark) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
