"""Temporal list join: every capture against the list entries in force when it was fetched.

A list is a history of dated changes: on a day a host (with its subdomains) or a
URL prefix is added or removed. Changes become validity intervals, from the day
of an addition to the day of the next removal, and an as-of join finds for each
capture the entries of its host, parent hosts and path whose interval holds its
fetch time. The most specific one decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import stage
from .common import unused
from .sitetree import host_of

OPEN_END = "9999-12-31"
# Intervals and captures meet by target and by this many days, so that a target
# with a long history is not joined whole with each of its captures.
BUCKET_DAYS = 64


def intervals(changes: DataFrame) -> DataFrame:
    """(list, target, valid_from, valid_to) from ``changes`` (``list``, ``target``, ``action``, ``at``).

    ``action`` is ``add`` or ``remove``, ``at`` a date. Of several changes of a
    target on one day, a removal wins. Repeated additions extend the interval;
    removals of what is not on the list do nothing. Rows with a null or another
    action are ignored. ``valid_to`` is exclusive.
    """
    valid = changes.filter(
        F.col("list").isNotNull() & F.col("target").isNotNull() & F.col("at").isNotNull() & F.col("action").isin("add", "remove")
    ).select("list", F.lower("target").alias("target"), F.to_date("at").alias("at"), (F.col("action") == "add").alias("added"))
    # One row per target and day first, which partial sums keep small.
    daily = valid.groupBy("list", "target", "at").agg(F.min("added").alias("added"))
    history = Window.partitionBy("list", "target").orderBy("at")
    turns = daily.withColumn("before", F.lag("added").over(history)).filter(
        F.col("added") != F.coalesce("before", F.lit(False))
    )
    spans = turns.withColumn("valid_to", F.coalesce(F.lead("at").over(history), F.lit(OPEN_END).cast("date")))
    return spans.filter("added").select("list", "target", F.col("at").alias("valid_from"), "valid_to")


def targets_of(url: Column) -> Column:
    """What a list may name of a URL: its host, every parent host, and host with each leading part of the path."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    hosts = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.concat(host, F.lit("/"), F.lower(F.array_join(F.slice(parts, F.lit(1), i), "/"))),
    )
    none = F.array().cast("array<string>")
    found = F.concat(hosts, F.when(F.size(parts) > 0, prefixes).otherwise(none))
    return F.when(host.isNotNull(), F.array_distinct(found)).otherwise(none)


def bucket_of(day: Column) -> Column:
    return F.floor(F.unix_date(day) / BUCKET_DAYS)


def temporal_list_join(captures: DataFrame, changes: DataFrame, url: str = "url", fetched: str = "fetch_time") -> DataFrame:
    """Every row of ``captures`` with the entry that holds at its fetch time.

    New columns ``entry_list``, ``entry_target``, ``entry_from``, ``entry_to``
    (null without an entry) and ``blocked``; a column of that name in ``captures``
    is kept, and the new one then starts with an underscore. The longest target
    decides, then the list's name. Captures without a host or a fetch time match
    nothing. Repeated captures stay repeated.
    """
    spans = stage(intervals(changes))
    a, b, day = unused(captures.columns, "_row_a", "_row_b", "_day")
    named = captures.withColumn(day, F.to_date(F.col(fetched)))
    # What a capture matches depends on its URL and day alone: those few values are joined, then looked up.
    keys = named.select(F.col(url).alias("u"), F.col(day).alias("d")).filter("u IS NOT NULL AND d IS NOT NULL").distinct()
    end = keys.agg(F.max("d")).first()[0]
    cut = F.least(F.date_sub("valid_to", 1), F.lit(end).cast("date"))
    if end is None:
        spans = spans.limit(0)
    pieces = spans.filter(F.col("valid_from") <= cut).withColumn(
        "bucket", F.explode(F.sequence(bucket_of(F.col("valid_from")), bucket_of(cut)))
    )
    asked = keys.select("u", "d", F.explode(targets_of(F.col("u"))).alias("target"), bucket_of(F.col("d")).alias("bucket"))
    met = asked.join(stage(pieces), ["target", "bucket"]).filter("d >= valid_from AND d < valid_to")
    rank = F.struct(F.length("target").alias("n"), F.col("list"), F.col("target"), F.col("valid_from"), F.col("valid_to"))
    best = stage(met.groupBy("u", "d").agg(F.max(rank).alias("e")))
    best = best.select(F.col("u").alias(a), F.col("d").alias(b), "e")
    joined = named.join(best, (F.col(url) == F.col(a)) & (F.col(day) == F.col(b)), "left")
    names = unused(captures.columns, "entry_list", "entry_target", "entry_from", "entry_to", "blocked")
    values = [F.col("e.list"), F.col("e.target"), F.col("e.valid_from"), F.col("e.valid_to"), F.col("e").isNotNull()]
    return joined.select(*[F.col(f"`{c}`") for c in captures.columns], *[v.alias(n) for v, n in zip(values, names, strict=True)])


def allowed_captures(captures: DataFrame, changes: DataFrame, url: str = "url", fetched: str = "fetch_time") -> DataFrame:
    """The rows of ``captures`` that no entry blocked when they were fetched."""
    found = temporal_list_join(captures, changes, url, fetched)
    blocked = found.columns[-1]
    return found.filter(~F.col(blocked)).select(*[F.col(f"`{c}`") for c in captures.columns])
