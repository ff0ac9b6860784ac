"""Toxicity by class-conditional Kneser-Ney models.

A text's evidence is the difference of its toxic and its ordinary log-likelihood,
summed over its different words and divided by their number; a logistic curve
turns both, with the length, into a score.

* Counts are of kinds: a word counts once per different training text, so a
  repeated word or a copied text weighs no more than once. k_c(w) is the number of
  training texts of class c that hold w.
* Rare words are smoothed through the counts that both classes share. Discounts
  come from counts of counts, as Kneser and Ney derive theirs, by leaving out:
  words with the same pair of counts (k_toxic, k_ordinary) in the other folds of
  the training texts form a cell, and what a cell's words really do in the fold
  that was left out gives their discounted counts,
  r_c(cell) = what the left-out fold holds of the cell's words in class c.
  Counts up to four are cells of their own, larger ones share half an octave. To
  each cell ``prior`` words are added that behave by plain absolute discounting,
  max(k_c - 0.75, 0) with the discounts dealt out by the shared shares; they decide
  where a cell holds few words.
* P_c(w) = P(w) * r_c(cell) / (r_toxic + r_ordinary)(cell) / (share of c), where P(w)
  is the shared distribution of both classes. It cancels in the difference. A word
  that no training text holds is in the cell (0, 0).

So a word seen once has the evidence of all words seen once, which is next to none,
and one seen in hundreds of texts has nearly its own. Every word of the training
rows is in the model, however rare; nothing is cut.

With ``Settings.pairs`` there is a second order above the words: pairs of neighbours.

* A pair counts once per different training text as well, and its cell also has the
  evidence of its second word, to ``STEP``: pairs back off to words, so the plain
  discounts of their cells are dealt out by the class shares that the word gives.
* A pair adds what its cell has beyond the evidence of its second word. One that no
  training text holds adds nothing: its words stand for it.

The model is a table of (key, evidence). Tasks resolve the commonest words, at most
``COMMON``, from a table that they all hold. Of the others, a bit map of fixed size
tells most that are not in the model; what passes is joined to the rest of the table
and added up by text. Evidence is added in whole billionths, so that it does not
depend on the order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from itertools import product
from math import asinh, exp, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest

from ..operators.skew import lookup_join, mark_possible, stage
from .common import LOWER_WORDS, append_columns, arrow_map, bit_map, in_map, may_match, send, unused

THRESHOLD = 0.7
NANO = 1e9
# Bounds of what a task holds of the model: words of the common table, and bits of the map of the others.
COMMON = 1 << 20
BITS = 1 << 26
FOLDS = 8
LEVELS = 128
# The discount of cells that hold too few words to show their own.
DISCOUNT = 0.75
# Pairs are told apart by the evidence of their second word in steps of so much, up to so many either way.
STEP, STEPS = 0.5, 16


@dataclass(frozen=True)
class Settings:
    """``prior`` words by absolute discounting are added to every cell; the curve is fitted on about ``curve_rows`` training rows.

    ``pairs`` adds the order of pairs to that of words.
    """

    prior: float = 1.0
    pairs: bool = False
    curve_rows: int = 8192
    ridge: float = 1e-5
    # Evidence has long tails: the curve is logistic in asinh(evidence per word / unit), asinh(evidence / unit)
    # and the length, with those of these units that fit best.
    mean_units: tuple[float, ...] = (0.02, 0.1, 1.0)
    total_units: tuple[float, ...] = (1.0, 10.0, 100.0)
    # Pairs of one text repeat each other's evidence, so they weigh by that of these shares that fits best.
    pair_shares: tuple[float, ...] = (0.01, 0.03, 0.1, 0.3, 1.0)


@dataclass(frozen=True)
class Model:
    """Evidence of words over that of an unseen word, and the curve.

    ``rest`` holds (key, evidence) of the words outside the common table; it is
    None where the training rows lack a class. ``held`` returns the common keys,
    their evidence and the bit map inside a task.
    """

    rest: DataFrame | None = field(compare=False)
    held: object = field(compare=False)
    unseen: int
    share: float
    weights: tuple[float, ...]
    words: int = 0
    pairs: bool = False

    def score(self, evidence: float, words: int) -> float:
        if not words or self.rest is None:
            return self.share
        by_mean, by_total, mean, total, length, offset = self.weights
        z = mean * asinh(evidence / words / by_mean) + total * asinh(evidence / by_total) + length * log1p(words) + offset
        return 1.0 / (1.0 + exp(-min(60.0, max(-60.0, z))))

    def scores(self, evidence: Column, words: Column) -> Column:
        by_mean, by_total, mean, total, length, offset = (F.lit(w) for w in self.weights)
        z = mean * F.asinh(evidence / words / by_mean) + total * F.asinh(evidence / by_total) + length * F.log1p(words) + offset
        curve = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.least(F.lit(60.0), F.greatest(F.lit(-60.0), z))))
        return F.when(words == 0, F.lit(self.share)).otherwise(curve)


def words_of(raw: bytes | None) -> list[bytes]:
    return raw.translate(LOWER_WORDS).split() if raw else []


def keys_of(raw: bytes | None) -> np.ndarray:
    """The 64-bit keys of the different words of a text, in order."""
    words = set(words_of(raw))
    keys = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)
    keys.sort()
    return keys


def pairs_of(raw: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit keys of the different pairs of neighbouring words of a text, in order, and those of their second words."""
    words = words_of(raw)
    hashes = {w: xxh3_64_intdigest(w) for w in set(words)}
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    x = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + (h[1:] ^ (h[1:] >> np.uint64(29)))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    keys, first = np.unique((x ^ (x >> np.uint64(31))).view(np.int64), return_index=True)
    return keys, h[1:][first].view(np.int64)


def held_out(doc_id: Column) -> Column:
    """Whether the label of a row must not be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(toxic, fold, place, text) of the different texts of labelled rows that are not held out.

    A row with several labels is toxic if one says so; a text of several rows is
    toxic if half of them are. ``fold`` and ``place`` are by the text alone.
    """
    known = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    texts = docs.select("doc_id", "text").filter(F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    # Both sides grow with the corpus, so this is a shuffled join at every size.
    rows = texts.join(known.hint("merge"), "doc_id")
    key = [F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b")]
    return (
        rows.groupBy(*key)
        .agg((F.avg((F.col("toxic") == 1).cast("int")) >= 0.5).alias("toxic"), F.first("text").alias("text"))
        .select("toxic", F.pmod("a", F.lit(FOLDS)).cast("int").alias("fold"), F.col("b").alias("place"), "text")
    )


def class_counts(train: DataFrame) -> DataFrame:
    """(key, t0.., o0..): per word the toxic and ordinary training texts of each fold that hold it."""
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("slot", T.IntegerType()), T.StructField("n", T.LongType())])

    def work(batches):
        for batch in batches:
            toxic, fold, raws = (batch.column(i).to_pylist() for i in (0, 1, 2))
            found: dict[int, list[np.ndarray]] = {}
            for label, part, raw in zip(toxic, fold, raws, strict=True):
                found.setdefault(part if label else FOLDS + part, []).append(keys_of(raw))
            for slot, lists in found.items():
                keys, n = np.unique(np.concatenate(lists), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.full(len(keys), slot, np.int32)), pa.array(n)], schema.names)

    rows = arrow_map(train.select("toxic", "fold", F.col("text").cast("binary")), work, schema)
    sums = [F.sum(F.when(F.col("slot") == j, F.col("n")).otherwise(0)).alias(f"{'to'[j // FOLDS]}{j % FOLDS}") for j in range(2 * FOLDS)]
    return rows.groupBy("key").agg(*sums)


def pair_counts(train: DataFrame, units: DataFrame, unseen: int) -> DataFrame:
    """(key, step, t0.., o0..): :func:`class_counts` of pairs, with the step of their second word's evidence.

    Tasks know the steps of the commonest words, at most ``COMMON``; pairs that end in others are joined to theirs.
    """
    fields = [("key", T.LongType()), ("step", T.IntegerType()), ("second", T.LongType()), ("slot", T.IntegerType()), ("n", T.LongType())]
    schema = T.StructType([T.StructField(*f) for f in fields])
    least, _ = commonest(units)
    known = send(train.sparkSession, common_words(units.filter(F.col("size") >= least)))

    def steps_of(evidence):
        return np.clip(np.rint((evidence + unseen) / (NANO * STEP)), -STEPS, STEPS).astype(np.int32)

    def work(batches):
        words, evidence = known()
        for batch in batches:
            toxic, fold, raws = (batch.column(i).to_pylist() for i in (0, 1, 2))
            found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
            for label, part, raw in zip(toxic, fold, raws, strict=True):
                found.setdefault(part if label else FOLDS + part, []).append(pairs_of(raw))
            for slot, lists in found.items():
                pairs, seconds = (np.concatenate(x) for x in zip(*lists, strict=True))
                keys, first, n = np.unique(pairs, return_index=True, return_counts=True)
                seconds = seconds[first]
                at = np.searchsorted(words, seconds)
                at[at == len(words)] = 0
                there = words[at] == seconds if len(words) else np.zeros(len(seconds), bool)
                steps = steps_of(evidence[at]) if len(words) else np.zeros(len(seconds), np.int32)
                made = [pa.array(keys), pa.array(steps, mask=~there), pa.array(seconds, mask=there), pa.array(np.full(len(keys), slot, np.int32)), pa.array(n)]
                yield pa.RecordBatch.from_arrays(made, schema.names)

    rows = arrow_map(train.select("toxic", "fold", F.col("text").cast("binary")), work, schema)
    slots = [f"{'to'[j // FOLDS]}{j % FOLDS}" for j in range(2 * FOLDS)]
    sums = [F.sum(F.when(F.col("slot") == j, F.col("n")).otherwise(0)).alias(c) for j, c in enumerate(slots)]
    found = stage(rows.groupBy("key").agg(F.first("step", ignorenulls=True).alias("step"), F.first("second", ignorenulls=True).alias("second"), *sums))
    # Every second word is a word of the training rows.
    step = F.least(F.lit(STEPS), F.greatest(F.lit(-STEPS), F.rint((F.col("evidence") + unseen) / (NANO * STEP)).cast("int")))
    others = units.filter(F.col("size") < least).select(F.col("key").alias("second"), step.alias("step"))
    columns = ["key", "step", *slots]
    joined = found.filter("step IS NULL").drop("step").join(others.hint("merge"), "second")
    return found.filter("step IS NOT NULL").select(*columns).union(joined.select(*columns))


def total(kind: str, without: Column | None = None) -> Column:
    """Texts of a class ('t' or 'o') that hold a word, less those of the fold ``without``."""
    folds = [F.col(f"{kind}{f}") for f in range(FOLDS)]
    if without is not None:
        folds = [F.when(without == f, 0).otherwise(c) for f, c in enumerate(folds)]
    found = folds[0]
    for c in folds[1:]:
        found = found + c
    return found


def level(count: Column) -> Column:
    """The cell of a count: itself up to four, then half octaves."""
    return F.when(count <= 4, count).otherwise(F.floor(4 + 2 * F.log2(count / 4))).cast("int")


def cell_counts(counts: DataFrame) -> np.ndarray:
    """[fold, class, toxic level, ordinary level]: what each left-out fold holds of the words of a cell.

    A fold that has more of a class than the others leaves less of it to them, so
    every fold counts as if all were equally large. At most FOLDS * LEVELS ** 2 rows
    come to the driver.
    """
    parts = [
        F.struct(
            F.lit(f).alias("fold"),
            level(total("t", F.lit(f))).alias("x"),
            level(total("o", F.lit(f))).alias("y"),
            F.col(f"t{f}").alias("toxic"),
            F.col(f"o{f}").alias("ordinary"),
        )
        for f in range(FOLDS)
    ]
    sums = counts.select(F.inline(F.array(*parts))).groupBy("fold", "x", "y").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
    found = np.zeros((FOLDS, 2, LEVELS, LEVELS))
    for r in sums.collect():
        found[r["fold"], :, r["x"], r["y"]] = r["toxic"], r["ordinary"]
    sizes = found.sum(axis=(2, 3), keepdims=True)
    return found * sizes.mean(axis=0) / np.maximum(sizes, 1)


def cell_evidence(cells: np.ndarray, prior: float) -> np.ndarray:
    """log P_toxic - log P_ordinary of every cell from its (toxic, ordinary) counts."""
    share = cells.sum(axis=(1, 2)) / cells.sum()
    share = np.clip(share, 1e-9, 1)[:, None, None]
    found = np.log((cells + prior * discounted(share)) / (cells.sum(axis=0) + prior) / share)
    return np.rint((found[0] - found[1]) * NANO).astype(np.int64)


def discounted(share: np.ndarray) -> np.ndarray:
    """Per cell the classes' shares by absolute discounting: max(k_c - D, 0) and the discounts dealt out by the shared share."""
    steps = np.arange(LEVELS)
    count = np.where(steps <= 4, steps, 4 * 2 ** ((steps - 3.5) / 2))
    k = np.stack(np.broadcast_arrays(count[:, None], count[None, :]))
    off = np.minimum(k, DISCOUNT)
    return np.where(k.sum(axis=0) > 0, (k - off + off.sum(axis=0) * share) / np.maximum(k.sum(axis=0), 1), share)


Cell = tuple[int, int, int]


def pair_cells(counts: DataFrame) -> dict[Cell, np.ndarray]:
    """By cell (step, toxic level, ordinary level) an array [fold, class]: what each left-out fold holds of its pairs.

    Folds are weighed as in :func:`cell_counts`. Cells of all folds together are there too, perhaps with zeros.
    """
    views = [
        F.struct(F.lit(f).alias("fold"), level(total("t", F.lit(f))).alias("x"), level(total("o", F.lit(f))).alias("y"), F.col(f"t{f}").alias("toxic"), F.col(f"o{f}").alias("ordinary"))
        for f in range(FOLDS)
    ]
    whole = F.struct(F.lit(FOLDS).alias("fold"), level(total("t")).alias("x"), level(total("o")).alias("y"), F.lit(0).cast("bigint").alias("toxic"), F.lit(0).cast("bigint").alias("ordinary"))
    # Most pairs have the counts of many others, so these are taken together first.
    alike = counts.groupBy(*[c for c in counts.columns if c != "key"]).agg(F.count("*").alias("n"))
    sums = (
        alike.select("step", "n", F.inline(F.array(*views, whole)))
        .groupBy("fold", "step", "x", "y")
        .agg(F.sum(F.col("toxic") * F.col("n")).alias("toxic"), F.sum(F.col("ordinary") * F.col("n")).alias("ordinary"))
    )
    found: dict[Cell, np.ndarray] = {}
    for r in sums.collect():
        into = found.setdefault((r["step"], r["x"], r["y"]), np.zeros((FOLDS, 2)))
        if r["fold"] < FOLDS:
            into[r["fold"]] = r["toxic"], r["ordinary"]
    sizes = sum(found.values(), np.zeros((FOLDS, 2)))
    weights = sizes.mean(axis=0) / np.maximum(sizes, 1)
    return {cell: held * weights for cell, held in found.items()}


def pair_evidence(cells: dict[Cell, np.ndarray], prior: float, part: float, without: int | None = None) -> dict[Cell, int]:
    """``part`` of what the pairs of each cell have beyond the evidence of their second word, in billionths. Pairs that were not seen add nothing."""
    folds = [f for f in range(FOLDS) if f != without]
    share = sum((held[folds].sum(axis=0) for held in cells.values()), np.zeros(2))
    share = np.clip(share / max(share.sum(), 1e-9), 1e-9, 1)
    added = {}
    for (step, x, y), held in cells.items():
        if not x and not y:
            added[step, x, y] = 0
            continue
        below = share * np.exp([step * STEP, 0])
        below /= below.sum()
        k = np.array([n if n <= 4 else 4 * 2 ** ((n - 3.5) / 2) for n in (x, y)], float)
        off = np.minimum(k, DISCOUNT)
        r = held[folds].sum(axis=0)
        plain = (k - off + off.sum() * below) / max(k.sum(), 1)
        p = np.log((r + prior * plain) / (r.sum() + prior) / share)
        added[step, x, y] = int(np.rint((p[0] - p[1] - step * STEP) * part * NANO))
    return added


def pair_rows(spark: SparkSession, tables: list[dict[Cell, int]]) -> DataFrame:
    """(part, step, x, y, evidence) of :func:`pair_evidence`: a row per cell."""
    rows = [(part, *cell, value) for part, table in enumerate(tables) for cell, value in table.items()]
    return F.broadcast(spark.createDataFrame(rows, "part int, step int, x int, y int, evidence bigint"))


def evidence_rows(spark: SparkSession, tables: list[np.ndarray]) -> DataFrame:
    """(part, x, y, evidence) of evidence tables: LEVELS ** 2 rows each."""
    part, x, y = (i.ravel().astype(np.int32) for i in np.indices((len(tables), LEVELS, LEVELS)))
    rows = pa.table({"part": part, "x": x, "y": y, "evidence": np.stack(tables).ravel()})
    return F.broadcast(spark.createDataFrame(rows))


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of a query go as soon as it has ended."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def fit(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> Model:
    """The models of the labelled rows of ``docs`` whose label may be learned from."""
    with shuffles_dropped(docs.sparkSession):
        return fitted(docs, labels, settings or Settings())


def fitted(docs: DataFrame, labels: DataFrame, s: Settings) -> Model:
    spark = docs.sparkSession
    train = stage(training_rows(docs, labels))
    size = train.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("toxic").cast("int")), F.lit(0)).alias("toxic")).first()
    share = (size["toxic"] + 0.5) / (size["n"] + 10.0)
    if not 0 < size["toxic"] < size["n"]:
        # Training rows of one kind say nothing about words.
        return Model(None, None, 0, min(share, 1 - 1e-9), ())
    counts = stage(class_counts(train))
    cells = cell_counts(counts)
    table = cell_evidence(cells.sum(axis=0), s.prior)
    unseen = int(table[0, 0])
    both = total("t") + total("o")
    units = stage(
        counts.select("key", level(both).alias("size"), F.lit(0).alias("part"), level(total("t")).alias("x"), level(total("o")).alias("y"))
        .join(evidence_rows(spark, [table]), ["part", "x", "y"])
        .select("key", "size", (F.col("evidence") - unseen).alias("evidence"))
    )
    least, words = commonest(units)
    pairs = pair_counts(train, units, unseen) if s.pairs else None
    of_pairs = pair_cells(pairs) if s.pairs else None
    weights, part = curve(train, counts, cells, size["n"], s, (pairs, of_pairs) if s.pairs else None)
    if s.pairs:
        looked = pairs.select("key", level(both).alias("size"), F.lit(0).alias("part"), "step", level(total("t")).alias("x"), level(total("o")).alias("y"))
        made = looked.join(pair_rows(spark, [pair_evidence(of_pairs, s.prior, part)]), ["part", "step", "x", "y"])
        units = units.union(made.select("key", "size", "evidence"))
        least, _ = commonest(units)
    rest = units.filter(F.col("size") < least).select("key", "evidence")
    held = send(spark, (*common_words(units.filter(F.col("size") >= least)), bit_map(rest, BITS)))
    return Model(rest, held, unseen, share, weights, words, s.pairs)


def commonest(units: DataFrame) -> tuple[int, int]:
    """The least ``size`` of which, with all above, at most ``COMMON`` units are; and the number of units."""
    sizes = {r["size"]: r["count"] for r in units.groupBy("size").count().collect()}
    return min(z for z in range(LEVELS + 1) if sum(n for k, n in sizes.items() if k >= z) <= COMMON), sum(sizes.values())


def common_words(units: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order and their evidence; the caller bounds the rows."""
    found = units.select("key", "evidence").toArrow()
    keys, evidence = found.column("key").to_numpy(), found.column("evidence").to_numpy()
    order = np.argsort(keys)
    return keys[order], evidence[order]


def curve(
    train: DataFrame, counts: DataFrame, cells: np.ndarray, rows: int, s: Settings, pairs: tuple[DataFrame, dict[Cell, np.ndarray]] | None = None
) -> tuple[tuple[float, ...], float]:
    """Weights of the logistic curve, and the share of pairs, fitted on about ``curve_rows`` texts by the models of the folds that they are not in.

    ``pairs`` are the counts of :func:`pair_counts` and the cells of :func:`pair_cells`, if the model has pairs.
    """
    spark = train.sparkSession
    part = 1 << 30
    cut = min(part, int(part * s.curve_rows / rows))
    sample = train.filter(F.pmod("place", F.lit(part)) < cut)
    schema = T.StructType([T.StructField("toxic", T.BooleanType()), T.StructField("fold", T.IntegerType()), T.StructField("place", T.LongType()), T.StructField("keys", T.ArrayType(T.LongType()))])

    def by_text(keys: Callable[[bytes], np.ndarray]) -> DataFrame:
        texts = sample.select("toxic", "fold", "place", F.col("text").cast("binary"))
        return arrow_map(texts, _by_text(keys), schema).select("toxic", "fold", "place", F.explode("keys").alias("key"))

    words = by_text(keys_of)
    tables = [cell_evidence(cells[[g for g in range(FOLDS) if g != f]].sum(axis=0), s.prior) for f in range(FOLDS)]
    looked = lookup_join(words, counts, "key").select(
        "toxic", "place", F.col("fold").alias("part"), level(total("t", F.col("fold"))).alias("x"), level(total("o", F.col("fold"))).alias("y")
    )
    parts = looked.join(evidence_rows(spark, tables), ["part", "x", "y"]).select("place", "toxic", "evidence", F.lit(0).alias("added"), F.lit(1).alias("n"))
    if pairs:
        counted, held = pairs
        views = [pair_evidence(held, s.prior, 1.0, f) for f in range(FOLDS)]
        asked = by_text(lambda raw: pairs_of(raw)[0])
        # Only the counts of pairs that the texts may hold are shuffled.
        counted = mark_possible(counted, asked.select("key"), F.col("key")).filter("_possible").drop("_possible")
        met = lookup_join(asked, counted, "key").select(
            "toxic", "place", "step", F.col("fold").alias("part"), level(total("t", F.col("fold"))).alias("x"), level(total("o", F.col("fold"))).alias("y")
        )
        added = met.join(pair_rows(spark, views), ["part", "step", "x", "y"])
        parts = parts.union(added.select("place", "toxic", F.lit(0).alias("evidence"), F.col("evidence").alias("added"), F.lit(0).alias("n")))
    found = (
        parts.groupBy("place", "toxic")
        .agg(F.sum("evidence").alias("evidence"), F.sum("added").alias("added"), F.sum("n").alias("words"))
        .orderBy("place", "toxic")
        .toArrow()
    )
    alone, added, n = found.column("evidence").to_numpy() / NANO, found.column("added").to_numpy() / NANO, found.column("words").to_numpy()
    toxic = found.column("toxic").to_numpy(zero_copy_only=False).astype(float)
    fits = []
    for part, mean, total_unit in product(s.pair_shares if pairs else (1.0,), s.mean_units, s.total_units):
        evidence = alone + part * added
        x = np.stack([np.arcsinh(evidence / n / mean), np.arcsinh(evidence / total_unit), np.log1p(n)], axis=1)
        fits.append((*rising(x, toxic, s.ridge), mean, total_unit, part))
    _, weights, mean, total_unit, part = max(fits, key=lambda f: f[0])
    return (mean, total_unit, *weights), part


def rising(x: np.ndarray, y: np.ndarray, ridge: float) -> tuple[float, tuple[float, ...]]:
    """(log-likelihood, weights) of the best logistic curve that never falls as evidence, the first two columns, rises."""
    fits = []
    for off in ([], [0], [1], [0, 1]):
        used = x.copy()
        used[:, off] = 0.0
        fit_, weights = logistic(used, y, ridge)
        if weights[0] >= 0 <= weights[1]:
            fits.append((fit_, weights))
    return max(fits, key=lambda f: f[0])


def _by_text(keys: Callable[[bytes], np.ndarray]):
    def work(batches):
        for batch in batches:
            lists = [keys(raw) for raw in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(lists, pa.list_(pa.int64()))], ["toxic", "fold", "place", "keys"])

    return work


def logistic(x: np.ndarray, y: np.ndarray, ridge: float) -> tuple[float, tuple[float, ...]]:
    """(log-likelihood, slopes and offset) of a logistic regression by Newton steps on standardised columns."""
    if not len(x):
        return 0.0, (*[0.0] * x.shape[1], 0.0)
    middle, width = x.mean(axis=0), x.std(axis=0) + 1e-9
    design = np.c_[(x - middle) / width, np.ones(len(x))]
    weights = np.zeros(design.shape[1])
    penalty = np.diag([ridge * len(x)] * x.shape[1] + [1e-9])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -60, 60)))
        gradient = design.T @ (y - p) - penalty @ weights
        step = np.linalg.solve((design * (p * (1 - p) + 1e-9)[:, None]).T @ design + penalty, gradient)
        weights += step * min(1.0, 4.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    z = design @ weights
    slopes = weights[:-1] / width
    return float((y * z - np.logaddexp(0, z)).sum()), (*[float(w) for w in slopes], float(weights[-1] - slopes @ middle))


def measure(docs: DataFrame, model: Model, words: str, evidence: str, rest: str) -> DataFrame:
    """``docs`` with the number of different words, the evidence that the common table gives, and the keys to be joined."""
    held, unseen, pairs = model.held, model.unseen, model.pairs

    def work(texts):
        keys, values, bits = held()
        n, sums, asked = [], [], []
        for raw in texts:
            found = keys_of(raw)
            n.append(len(found))
            unknown = unseen * len(found)
            if pairs:
                found = np.concatenate([found, pairs_of(raw)[0]])
            at = np.searchsorted(keys, found)
            at[at == len(keys)] = 0
            known = keys[at] == found if len(keys) else np.zeros(len(found), bool)
            others = found[~known]
            sums.append(int(values[at[known]].sum()) + unknown)
            asked.append(others[in_map(bits, others)])
        return [n, sums, asked]

    fields = [T.StructField(words, T.LongType()), T.StructField(evidence, T.LongType()), T.StructField(rest, T.ArrayType(T.LongType()))]
    return append_columns(docs, "text", work, fields)


def with_score(docs: DataFrame, model: Model, keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """``docs`` (its columns ``keep``) with a score from 0 to 1 for each text, and the new column's name.

    Null and empty texts score the toxic share of the training rows.
    """
    keep = docs.columns if keep is None else keep
    name, words, evidence, asked, row, more = unused(docs.columns, "score", "_words", "_evidence", "_asked", "_row", "_more")
    kept = [F.col(f"`{c}`") for c in keep]
    if model.rest is None:
        return docs.select(*kept, F.lit(model.share).alias(name)), name
    # Row numbers depend on the partitions, so they are fixed by being stored.
    rows = stage(measure(docs, model, words, evidence, asked).select(*kept, words, evidence, asked, F.monotonically_increasing_id().alias(row)))
    found = (
        rows.select(row, F.explode(asked).alias("key"))
        .join(model.rest.toDF("key", more).hint("rebalance"), "key")
        .groupBy(row)
        .agg(F.sum(more).alias(more))
    )
    total_evidence = (F.col(evidence) + F.coalesce(F.col(more), F.lit(0))) / NANO
    scored = rows.join(found, row, "left").select(*kept, model.scores(total_evidence, F.col(words)).alias(name))
    return scored, name


def toxicity_scores(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Per row of ``docs``: (doc_id, held_out, score, predicted).

    Scores come from the text alone. Rows without a doc_id are not held out.
    Repeated rows get the same score; other columns are ignored; without labels
    of both kinds every row gets the share of toxic ones. Empty tables give no rows.
    """
    scored, _ = with_score(docs.select("doc_id", "text"), fit(docs, labels, settings), ["doc_id"])
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def remove_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns as they were.

    A score is of the text alone, so texts are scored by two hashes that name them.
    Only rows whose text may be toxic are shuffled.
    """
    a, b = unused(docs.columns, "_text_a", "_text_b")
    named = docs.withColumns({a: F.xxhash64("text"), b: F.xxhash64(F.lit(1), "text")})
    scored, name = with_score(named.select("text", a, b), model, [a, b])
    toxic = stage(scored.filter(F.col(name) >= threshold).select(a, b).distinct())
    perhaps = may_match(toxic, F.col(a))(F.col(a))
    kept = named.filter(~perhaps).union(named.filter(perhaps).join(toxic, [a, b], "left_anti").select(*[F.col(f"`{c}`") for c in named.columns]))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
