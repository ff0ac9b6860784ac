"""Near copies among vectors: spherical k-means cells, blocked cosine products, one vector kept per group.

1. *Exact copies* of a vector with the same label are counted and compared as one.
2. *Cells.* Spherical k-means is fitted on a sample of at most ``Cells.sample``
   vectors (and ``SAMPLE_BYTES``), taken by a hash of the vector; every vector is
   then put into the cell of its nearest centroid.
3. *Visits.* Two vectors at the threshold differ by a step of length
   ``chord = sqrt(2 - 2 * cosine)``. A vector x with home cell i can have such a
   partner in cell j only if ``x . (ci - cj) <= chord * |ci - cj|``. It then also
   visits j, if j comes before i, so that each pair meets in one cell. ``reach``
   is the share of the chord that counts: at 1 no pair can be missed. The default
   of 0.6 misses a pair only if over 0.6 of its difference points straight at
   another centroid; in 64 dimensions that is about five standard deviations for
   a difference without preferred direction, and visits fall to a quarter.
   Recall on the given tables is 1, see the tests.
4. *Blocks.* The vectors of a label in a cell are dealt into blocks of some
   ``Cells.block`` rows, and one task multiplies one pair of blocks. So a hot label
   or cell is many tasks, and a task holds two blocks. A block pair gives the
   number of links per vector and a spanning forest of them, never the pairs.
5. *Groups* are the connected components of the forests.

A group of m vectors that are near but not equal takes m * m / 2 products, in
blocks: how many of them pass the threshold is part of the result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import lookup_join, stage
from .common import arrow_map, send
from .components import connected_components

SAMPLE_BYTES = 64_000_000


@dataclass(frozen=True)
class Cells:
    cosine: float = 0.98
    reach: float = 0.6
    per_cell: int = 2000  # vectors that a cell should have
    most_cells: int = 4096  # of centroids; beyond that cells get more blocks
    sample: int = 65536  # vectors that centroids are fitted on, at most
    rounds: int = 8
    block: int = 4096


def spherical_kmeans(vectors: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """``k`` unit centroids of unit ``vectors``; empty cells take the worst placed vectors."""
    centroids = vectors[np.linspace(0, len(vectors) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        home = np.empty(len(vectors), int)
        score = np.empty(len(vectors))
        for at in range(0, len(vectors), 4096):
            products = vectors[at : at + 4096] @ centroids.T
            home[at : at + 4096] = products.argmax(1)
            score[at : at + 4096] = products.max(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, vectors)
        length = np.linalg.norm(sums, axis=1)
        empty = np.flatnonzero(length < 1e-12)
        sums[empty] = vectors[np.argsort(score)[: len(empty)]]
        length[empty] = 1
        centroids = sums / length[:, None]
    return centroids


def unit(flat: np.ndarray, dim: int) -> np.ndarray:
    rows = flat.reshape(-1, dim)
    rows = rows / np.abs(rows).max(1)[:, None]  # so that squares stay in range
    return rows / np.sqrt((rows * rows).sum(1))[:, None]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def distinct_vectors(rows: DataFrame, vector: str, label: str, vec_id: str) -> DataFrame:
    """(id, label, hash, dim, vector, copies, first) of every usable vector, equal ones once."""
    values = F.transform(vector, lambda x: x.cast("double") + F.lit(0.0))  # -0.0 becomes 0.0
    usable = (
        F.col("label").isNotNull()
        & F.col("vector").isNotNull()
        & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    ready = rows.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), values.alias("vector")).filter(usable)
    once = ready.groupBy("label", "vector").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"))
    return stage(
        once.select(
            F.monotonically_increasing_id().alias("id"),
            "label",
            F.xxhash64("label", "vector").alias("hash"),
            F.size("vector").alias("dim"),
            "vector",
            "copies",
            "first",
        )
    )


def fit_centroids(once: DataFrame, how: Cells) -> tuple[int, np.ndarray | None]:
    """The commonest length of a vector, and centroids for that length."""
    top = once.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").first()
    if top is None:
        return 0, None
    dim, n = top["dim"], top["n"]
    k = max(1, min(how.most_cells, -(-n // how.per_cell)))
    most = max(k, min(how.sample, SAMPLE_BYTES // (8 * dim)))
    share = min(1.0, most / n)
    spread = F.pmod(F.xxhash64("hash", F.lit(17)), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = once.filter((F.col("dim") == dim) & spread).orderBy(F.xxhash64("hash", F.lit(3))).limit(most)
    flat = sample.select("vector").toArrow().column("vector")
    if len(flat) < k:
        k = max(1, len(flat))
    if not len(flat):
        return dim, None
    return dim, spherical_kmeans(unit(_matrix(flat, dim), dim), k, how.rounds)


def cell_members(once: DataFrame, dim: int, centroids: np.ndarray | None, how: Cells) -> DataFrame:
    """(id, label, dim, cell, home, vector, copies): every vector in its home cell and in those it visits.

    Vectors of another length than ``dim`` share cell 0 of their length.
    """
    schema = T.StructType(
        [
            T.StructField("id", T.LongType()),
            once.schema["label"],
            T.StructField("dim", T.IntegerType()),
            T.StructField("cell", T.IntegerType()),
            T.StructField("home", T.BooleanType()),
            T.StructField("vector", T.ArrayType(T.DoubleType())),
            T.StructField("copies", T.LongType()),
        ]
    )
    names = schema.names
    get = send(once.sparkSession, centroids)
    allowed = how.reach * float(np.sqrt(2 - 2 * how.cosine))

    def work(batches):
        centres = get()
        if centres is not None:
            between = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T))
        for batch in batches:
            for part in ((0, True), (1, False)):
                usual = np.asarray(batch.column(2).to_numpy(zero_copy_only=False)) == dim
                chosen = np.flatnonzero(usual if part[1] else ~usual)
                if not len(chosen):
                    continue
                rows = batch.take(pa.array(chosen))
                if not part[1] or centres is None:
                    at, cell, home = np.arange(len(chosen)), np.zeros(len(chosen), np.int32), np.ones(len(chosen), bool)
                else:
                    products = unit(_matrix(rows.column(3), dim), dim) @ centres.T
                    own = products.argmax(1)
                    near = products >= products.max(1)[:, None] - allowed * between[own]
                    near &= np.arange(len(centres))[None, :] < own[:, None]
                    near[np.arange(len(own)), own] = True
                    at, cell = np.nonzero(near)
                    home = cell == own[at]
                taken = rows.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [taken.column(0), taken.column(1), taken.column(2), pa.array(cell, pa.int32()), pa.array(home), taken.column(3), taken.column(4)],
                    names,
                )

    return arrow_map(once.select("id", "label", "dim", "vector", "copies"), work, schema)


def block_pairs(members: DataFrame, block: int) -> DataFrame:
    """Every member once per pair of blocks it belongs to: home blocks with one another, and with visitors' blocks.

    A pair (left, right) has home block ``left``; ``right`` is a home block from
    ``left`` on, or, counted from -1 downwards, a block of visitors.
    """
    key = F.concat_ws(":", F.xxhash64("label"), "dim", "cell")
    keyed = members.withColumn("key", key)
    sizes = keyed.groupBy("key").agg(
        F.ceil(F.count_if("home") / block).cast("int").alias("homes"),
        F.ceil(F.count_if(~F.col("home")) / block).cast("int").alias("visitors"),
    )
    sized = lookup_join(keyed, sizes, "key").filter("homes > 0")
    dealt = sized.withColumn("own", F.pmod(F.xxhash64("id"), F.when(F.col("home"), F.col("homes")).otherwise(F.col("visitors"))).cast("int"))
    left, right, own = F.lit(True), F.lit(False), F.col("own")

    def pair(a, b, side):
        return F.struct(a.alias("left"), b.alias("right"), side.alias("is_left"))

    after = F.transform(F.sequence(own, F.col("homes") - 1), lambda b: pair(own, b, left))
    before = F.when(own > 0, F.transform(F.sequence(F.lit(0), own - 1), lambda a: pair(a, own, right))).otherwise(F.slice(after, 1, 0))
    guests = F.when(F.col("visitors") > 0, F.transform(F.sequence(F.lit(1), F.col("visitors")), lambda b: pair(own, -b, left))).otherwise(F.slice(after, 1, 0))
    visits = F.transform(F.sequence(F.lit(0), F.col("homes") - 1), lambda a: pair(a, -own - 1, right))
    pairs = F.when(F.col("home"), F.concat(after, before, guests)).otherwise(visits)
    return dealt.select("key", "label", "dim", "id", "vector", "copies", F.explode(pairs).alias("p")).select(
        "key", "p.left", "p.right", "p.is_left", "label", "dim", "id", "vector", "copies"
    )


LINKS = "id bigint, n_links bigint, other bigint"


def _forest(near: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """For rows and columns of a link matrix, the smallest node that each reaches within it.

    Nodes are rows, then columns; with ``same`` columns are the rows.
    """
    n, m = near.shape
    low_r = np.arange(n, dtype=np.int64)
    low_c = low_r if same else np.arange(n, n + m, dtype=np.int64)
    far = np.int64(n + m)
    while True:
        before = (low_r.copy(), low_c.copy())
        for at in range(0, n, 512):
            part = near[at : at + 512]
            best = np.where(part, low_c[None, :], far).min(1, initial=far)
            low_r[at : at + 512] = np.minimum(low_r[at : at + 512], best)
        for at in range(0, m, 512):
            part = near[:, at : at + 512]
            best = np.where(part, low_r[:, None], far).min(0, initial=far)
            low_c[at : at + 512] = np.minimum(low_c[at : at + 512], best)
        # Whatever a node points at may know a smaller one by now.
        every = low_r if same else np.concatenate((low_r, low_c))
        every = every[every]
        low_r = every[:n]
        low_c = low_r if same else every[n:]
        if np.array_equal(before[0], low_r) and np.array_equal(before[1], low_c):
            return low_r, low_c


def _multiply(table: pa.Table, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, links, smallest node reached) of the linked vectors of one block pair."""
    none = (np.empty(0, np.int64),) * 3
    dim = table.column("dim")[0].as_py()
    is_left = table.column("is_left").to_numpy()
    one_block = bool(is_left.all()) and table.column("left")[0].as_py() == table.column("right")[0].as_py()
    if not one_block and is_left.all():
        return none
    ids, copies = table.column("id").to_numpy(), table.column("copies").to_numpy()
    vectors = unit(_matrix(table.column("vector"), dim), dim)
    a = np.flatnonzero(is_left)
    b = a if one_block else np.flatnonzero(~is_left)
    if not len(a) or not len(b):
        return none
    near = np.empty((len(a), len(b)), bool)
    for at in range(0, len(a), 512):
        near[at : at + 512] = vectors[a[at : at + 512]] @ vectors[b].T >= cosine
    if one_block:
        np.fill_diagonal(near, False)
    rows, columns = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
    if not len(rows):
        return none
    near = near[np.ix_(rows, columns)]
    a, b = a[rows], b[columns]
    row_links = near @ copies[b]
    low_r, low_c = _forest(near, one_block)
    if one_block:
        return ids[a], row_links, ids[a][low_r]
    column_links = near.T @ copies[a]
    nodes = np.concatenate((ids[a], ids[b]))
    return nodes, np.concatenate((row_links, column_links)), nodes[np.concatenate((low_r, low_c))]


def linked(pairs: DataFrame, cosine: float) -> DataFrame:
    """(id, n_links, other): per vector of a block pair its links there, and another vector it is connected with."""

    def work(table: pa.Table) -> pa.Table:
        return pa.table([pa.array(c, pa.int64()) for c in _multiply(table, cosine)], names=["id", "n_links", "other"])

    return pairs.groupBy("key", "left", "right").applyInArrow(work, LINKS)


def near_copies(
    rows: DataFrame, vector: str = "embedding", label: str = "label", vec_id: str = "vec_id", how: Cells | None = None
) -> DataFrame:
    """Per row of ``rows`` its id, ``n_links``, ``component_id`` and ``kept``.

    Vectors are compared when their labels are equal and not null and they have
    the same length, in double precision; ``n_links`` counts the other rows with
    cosine at least ``how.cosine``, exact copies included. ``component_id`` is the
    smallest id that links reach, and ``kept`` says that it is the row's own.

    A vector that is null, empty, zero or holds a null or non-finite component
    links with nothing, like one without a label. A row without an id takes part
    and is never the smallest; in a group without any id, and for a row that
    links with nothing, ``component_id`` is the row's id. Rows with one id are
    rows of their own. An empty table gives an empty one. Other columns are
    ignored.
    """
    how = how or Cells()
    spark = rows.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "64m")
    once = distinct_vectors(rows, vector, label, vec_id)
    dim, centroids = fit_centroids(once, how)
    found = stage(linked(block_pairs(stage(cell_members(once, dim, centroids, how)), how.block), how.cosine))
    counts = found.groupBy("id").agg(F.sum("n_links").alias("links"))
    groups = connected_components(found.filter("id <> other").select(F.col("id").alias("a"), F.col("other").alias("b")))
    groups = groups.join(once.select(F.col("id").alias("node"), "first"), "node")
    lowest = groups.groupBy("component").agg(F.min("first").alias("lowest"))
    grouped = lookup_join(groups.select("node", "component"), lowest, "component").select(F.col("node").alias("id"), "lowest")
    known = once.join(counts, "id", "left").join(grouped, "id", "left").select(
        F.col("label").alias("_label"),
        F.col("vector").alias("_vector"),
        "hash",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("lowest", "first").alias("lowest"),
    )
    values = F.transform(vector, lambda x: x.cast("double") + F.lit(0.0))
    asked = rows.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), values.alias("vector"))
    asked = asked.withColumn("hash", F.xxhash64("label", "vector"))
    known = stage(known)
    same = (asked["hash"] == known["hash"]) & (asked["label"] == known["_label"]) & (asked["vector"] == known["_vector"])
    return asked.join(known, same, "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("lowest", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("lowest", "vec_id"), F.lit(False)).alias("kept"),
    )
