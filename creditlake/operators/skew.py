"""N:1 joins that survive hot keys, and staging of intermediate results.

A key may hold a third of all rows, and hash partitioning sends them to one
partition. Adaptive execution splits such a partition and repeats the matching
rows of the other side, but only where both sides of the join come straight from
an exchange of their own. A lookup that an aggregate or window has already
partitioned by the key has none, so it is dealt out evenly first; a stored lookup
is a scan and needs no such step. That is one way for every size; small lookups are
broadcast.

How small is a matter of rows. Spark takes the size of compressed files for that of
their rows, and the driver builds the table that it broadcasts: keys that fill 10 MB
of Parquet are hundreds of MB there. So stored lookups are counted.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bits of the map by which tasks tell most rows that a join cannot meet.
MAP_BITS = 1 << 24

# What a row of a lookup takes in the hash table of a broadcast, about.
ROW_BYTES = 128


def shuffled(side: DataFrame) -> DataFrame:
    """``side`` of a join that grows with the data on both sides, which must not be broadcast by the size of its files."""
    return side.hint("merge")


def broadcast_limit(spark: SparkSession) -> int:
    """The session's limit for the sides of a join that are broadcast, in bytes; below 0 none is."""
    number, unit = re.fullmatch(r"(-?\d+)([kmgt]?)b?", spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def lookup_join(rows: DataFrame, lookup: DataFrame, on: str, stored: bool = False, grows: bool = False) -> DataFrame:
    """Left join of ``rows`` to ``lookup``, which holds every value of ``on`` at most once.

    ``stored`` says that the lookup is read from files, with no aggregate, window or shuffled join
    since. It is counted: its rows, not its files, decide whether it is broadcast. ``grows`` says that
    it is made from tables that grow with the rows, so it is shuffled at every size. In both cases
    ``rows`` are never broadcast, not even where a filter makes the join an inner one.
    """
    if grows:
        return rows.join(shuffled(lookup if stored else lookup.hint("rebalance")), on, "left")
    if not stored:
        return rows.join(lookup.hint("rebalance"), on, "left")
    fits = lookup.count() * ROW_BYTES <= broadcast_limit(rows.sparkSession)
    return rows.join(F.broadcast(lookup) if fits else shuffled(lookup), on, "left")


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` of a scan, dealt out to all cores if the scan has fewer tasks than there are cores.

    A file of one row group is read by one task, which would also do all the work
    up to the first shuffle. A scan with a task for every core stays as it is.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate results that all executors can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session
    without the setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="creditlake-checkpoint-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from there.

    That cuts the lineage: a lost executor never brings the earlier work back,
    later passes read only the columns they need, and the true size is known.
    """
    path = f"{shared_folder(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bit_words(keys: DataFrame, bits: int = MAP_BITS) -> DataFrame:
    """A map of the 64-bit hashes in the column ``key``, as words: (at, bits), at most ``bits`` / 64 rows."""
    place = F.pmod("key", F.lit(bits))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 64).cast("int"))
    return keys.groupBy(F.shiftright(place, 6).cast("int").alias("at")).agg(F.bit_or(bit).alias("bits"))


def mark_possible(
    rows: DataFrame, keys: DataFrame, key: Column, name: str = "_possible", at: str = "_at", word: str = "_word"
) -> DataFrame:
    """``rows`` with a flag that is true for every row whose hash ``key`` is in the column ``key`` of ``keys``, and for few others.

    Only rows with the flag need meet ``keys`` in an exact join, so the others are not
    shuffled. The words of the map are broadcast, whatever the number of keys. ``rows``
    has no column called ``name``, ``at`` or ``word``.
    """
    words = F.broadcast(stage(bit_words(keys)).toDF(at, word))
    place = F.pmod(key, F.lit(MAP_BITS))
    found = rows.withColumn(at, F.shiftright(place, 6).cast("int")).join(words, at, "left")
    flag = F.coalesce(F.getbit(word, (place % 64).cast("int")) == 1, F.lit(False))
    return found.withColumn(name, flag).drop(at, word)
