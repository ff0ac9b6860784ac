"""Connected components of a link table, in a number of steps logarithmic in its size."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import stage
from .common import arrow_map

# Links that a task contracts at once.
MOST_LINKS = 1 << 17


def contracted(links: DataFrame, most: int = MOST_LINKS) -> DataFrame:
    """Links (``u``, ``v``) of every node, itself included, to the smallest one that the links of its batch reach.

    A batch has about ``most`` links (``u``, ``v``). That keeps what is connected.
    """
    kind = links.schema["u"].dataType.simpleString()

    def work(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= most:
                yield forest(pa.Table.from_batches(held))
                held, rows = [], 0
        if held:
            yield forest(pa.Table.from_batches(held))

    return arrow_map(links.select("u", "v"), work, f"u {kind}, v {kind}")


def forest(links: pa.Table) -> pa.RecordBatch:
    above: dict = {}

    def root(x):
        top = x
        while (up := above.setdefault(top, top)) != top:
            top = up
        while above[x] != top:
            above[x], x = top, above[x]
        return top

    for a, b in zip(links.column(0).to_pylist(), links.column(1).to_pylist(), strict=True):
        a, b = root(a), root(b)
        if a != b:
            above[max(a, b)] = min(a, b)
    nodes = list(above)
    kind = links.schema.field(0).type
    return pa.RecordBatch.from_arrays([pa.array(nodes, kind), pa.array(map(root, nodes), kind)], ["u", "v"])


def connected_components(links: DataFrame, most: int = MOST_LINKS) -> DataFrame:
    """(node, component) of every node in ``links`` (``a``, ``b``): the smallest node it can reach.

    Alternating large-star and small-star steps, until every node has one link, to
    the smallest node of its component. Each step takes the smallest neighbour per
    node with partial sums, so a node with very many links is never gathered; its
    rows are split when they are joined back. Tasks contract what they hold between
    the steps; at most ``most`` links are one batch, which needs no step.
    """
    edges = stage(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        if edges.count() <= most:
            return stage(contracted(edges.coalesce(1), 2 * most)).toDF("node", "component")
        edges = stage(contracted(edges, most)).filter("u <> v")
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = stage(both.groupBy("u").agg(F.min("v").alias("low"), F.max("v").alias("high")))
        lowest = near.select("u", F.least("low", "u").alias("m"))
        if near.filter("low < u AND high <> low").isEmpty():
            return lowest.toDF("node", "component")
        large = both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.filter("u <> v").distinct())
        least = stage(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(least.select("u", F.col("m").alias("v"))).filter("u <> v")
        edges = stage(small.distinct())


def joined_components(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, component) of the nodes of ``labels``, an earlier result or None, and of ``links``, by both."""
    if labels is None:
        return connected_components(links)
    of = lambda side: labels.select(F.col("node").alias(side), F.col("component").alias(f"_{side}"))
    merged = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    moved = connected_components(merged.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")))
    to = moved.select(F.col("node").alias("component"), F.col("component").alias("_to"))
    kept = labels.join(to, "component", "left").select("node", F.coalesce("_to", "component").alias("component"))
    return stage(kept.union(moved.join(labels, "node", "left_anti")))
