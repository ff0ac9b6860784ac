"""Ranked lexical search by pipelined term partitioning, with integer scores.

The vocabulary is dealt to term owners by rarity: owner 0 has the rarest terms,
the last owner the commonest. Items go through the owners one after the other as
bundles that carry a sparse accumulator, the documents found so far with their
partial scores. At each owner a cogroup brings a bundle together with the
postings of the owner's terms, adds their integer contributions and passes the
bundle on. The selection comes after the last owner.

* *Document blocks.* An owner's postings and the bundles are cut into blocks of
  ``Search.block`` documents and groups of some ``Search.group`` items. One block
  and group is one cogroup, so neither a common term nor an item with many
  documents is ever gathered in one task.
* *Pruning without loss.* Contributions are never negative, so the tenth best
  partial score of an item is a lower bound of its tenth best score. A document
  whose partial score and the most that the remaining owners can add stay below
  that bound is dropped. Equal ones stay, for they may win by their id.
* *The index* has one row per block and term, with postings packed as bytes. Only
  terms that may occur in an item are indexed: a bit map of fixed size
  (``BITS``), filled from all items, says so in the scan, and the exact join with
  the terms of the items comes after. However large the benchmark, the map has
  the same size; it only lets more terms through.

Terms, scores and ties are those of :func:`search`. All counts are over all
documents with a term.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import stage
from .common import LOWER_WORDS, arrow_map, send

BITS = 1 << 20
INDEX = "block bigint, term string, df bigint, words bigint, slots binary, times binary, lengths binary, ids binary"
BUNDLE = "part bigint, block bigint, item bigint, slots binary, scores binary, tops array<bigint>, ids array<bigint>"


@dataclass(frozen=True)
class Search:
    top: int = 10
    # An owner has the terms that at least one in so many documents holds, and
    # that the next owner does not have.
    rarity: tuple[int, ...] = (200, 40, 12, 4)
    block: int = 8192
    group: int = 256


def terms_of(text: bytes | None) -> list[bytes]:
    """Letters and digits of ASCII with A-Z lower-cased, and all other characters, in one piece."""
    return (text or b"").translate(LOWER_WORDS).split()


def item_terms(items: DataFrame, item_id: str, column: str) -> DataFrame:
    """(item, item_id, term): every term of every item once; an item is a row."""
    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col(item_id).alias("item_id"), F.col(column).alias("text"))
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("terms", T.ArrayType(T.StringType()))])

    def work(batches):
        for batch in batches:
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            found = [[t.decode() for t in dict.fromkeys(terms_of(text))] for text in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.string()))], schema.names)

    return stage(arrow_map(rows, work, schema)).select("item", "item_id", F.explode("terms").alias("term"))


def term_map(terms: DataFrame) -> np.ndarray:
    """The bit map of the terms: at most ``BITS`` numbers come to the driver."""
    places = terms.select((F.crc32("term") % BITS).cast("int").alias("place")).distinct()
    bits = np.zeros(BITS, bool)
    bits[places.toArrow().column("place").to_numpy()] = True
    return bits


def build_index(docs: DataFrame, doc_id: str, column: str, bits: np.ndarray, how: Search) -> DataFrame:
    """One row per block and term; the row without a term holds the ids of the block's documents.

    A block is up to ``how.block`` consecutive documents of a task that have a term.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(column).alias("text"), F.spark_partition_id().alias("task"))
    get = send(docs.sparkSession, bits)
    names = [f.split()[0] for f in INDEX.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), *[pa.binary()] * 4]

    def packed(block, ids, lengths, postings):
        out = [(block, None, len(ids), int(sum(lengths)), None, None, None, pa.array(ids, pa.int64()))]
        words = np.array(lengths, np.int32)
        for term, (slots, times) in postings.items():
            at = np.array(slots, np.uint16)
            out.append((block, term.decode(), len(slots), 0, at.tobytes(), np.array(times, np.int32).tobytes(), words[at].tobytes(), None))
        return out

    def batches_of(rows):
        for at in range(0, len(rows), 4096):
            part = rows[at : at + 4096]
            columns = [list(c) for c in zip(*part, strict=True)]
            # A document without an id has the smallest number, which no id is.
            columns[7] = [None if c is None else c.fill_null(-(1 << 63)).to_numpy().tobytes() for c in columns[7]]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def work(batches):
        bits = get().tolist()
        number, ids, lengths, postings, task = 0, [], [], {}, 0
        for batch in batches:
            texts, task_of = batch.column(1).cast(pa.binary()), batch.column(2)
            for doc, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                words = terms_of(text.as_py())
                if not words:
                    continue
                slot = len(ids)
                ids.append(doc)
                lengths.append(len(words))
                for word, times in Counter(words).items():
                    if bits[zlib.crc32(word) % BITS]:
                        found = postings.get(word)
                        if found is None:
                            found = postings[word] = ([], [])
                        found[0].append(slot)
                        found[1].append(times)
                if len(ids) == how.block:
                    task = task_of[0].as_py()
                    yield from batches_of(packed((task << 32) + number, ids, lengths, postings))
                    number, ids, lengths, postings = number + 1, [], [], {}
            if batch.num_rows:
                task = task_of[0].as_py()
        if ids:
            yield from batches_of(packed((task << 32) + number, ids, lengths, postings))

    return stage(arrow_map(rows, work, T._parse_datatype_string(INDEX)))


def share(times: np.ndarray, lengths: np.ndarray, n_docs: int, n_words: int) -> np.ndarray:
    """A posting's part of the score, before the weight of the term."""
    m = 10 + (90 * lengths.astype(np.int64) * n_docs) // n_words
    times = times.astype(np.int64)
    return (1000000000 * times) // (1000 * times + 8 * m)


def term_figures(index: DataFrame, terms: DataFrame, n_docs: int, n_words: int, how: Search) -> DataFrame:
    """(term, weight, most, owner) of every item term that occurs; ``most`` is its largest contribution."""
    rows = index.filter("term IS NOT NULL").select("term", "df", "times", "lengths")
    schema = "term string, df bigint, top bigint"

    def work(batches):
        for batch in batches:
            tops = [
                int(share(np.frombuffer(t, np.int32), np.frombuffer(w, np.int32), n_docs, n_words).max())
                for t, w in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(tops, pa.int64())], ["term", "df", "top"])

    found = arrow_map(rows, work, T._parse_datatype_string(schema)).groupBy("term").agg(F.sum("df").alias("df"), F.max("top").alias("top"))
    df = F.col("df").cast("double")
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2 * df + 1))).cast("long")
    owner = sum((F.when(F.col("df") * r > n_docs, 1).otherwise(0) for r in how.rarity), F.lit(0))
    wanted = terms.select("term").distinct()
    return found.join(wanted, "term", "left_semi").select(
        "term", weight.alias("weight"), (weight * F.col("top")).alias("most"), owner.cast("int").alias("owner")
    )


def _columns(table: pa.Table, *names: str) -> list[list]:
    return [table.column(n).to_pylist() for n in names]


def _owner_step(how: Search, n_docs: int, n_words: int, last: bool):
    """What an owner does with the bundles and postings of one block and item group."""

    def step(bundles: pa.Table, postings: pa.Table) -> pa.Table:
        carried: dict[int, tuple[bytes, bytes]] = {}
        for item, slots, scores in zip(*_columns(bundles, "item", "slots", "scores"), strict=True):
            carried[item] = (slots, scores)
        adds: dict[int, list] = {}
        bounds: dict[int, tuple[int, int]] = {}
        ids = None
        for slots, times, lengths, weight, asks, own in zip(
            *_columns(postings, "slots", "times", "lengths", "weight", "asks", "ids"), strict=True
        ):
            if own is not None:
                ids = np.frombuffer(own, np.int64)
                continue
            at = np.frombuffer(slots, np.uint16)
            part = weight * share(np.frombuffer(times, np.int32), np.frombuffer(lengths, np.int32), n_docs, n_words)
            for ask in asks:
                adds.setdefault(ask["item"], []).append((at, part))
                bounds[ask["item"]] = (ask["least"], ask["rest"])
        key = bundles if bundles.num_rows else postings
        part_no, block = (key.column(n)[0].as_py() for n in ("part", "block"))
        out = []
        sums = np.zeros(how.block, np.int64)
        for item in carried.keys() | adds.keys():
            if item not in adds and not last:
                slots, scores = carried[item]
                values = np.frombuffer(scores, np.int64)
                out.append((part_no, block, item, slots, scores, np.sort(values)[::-1][: how.top].tolist(), None))
                continue
            sums[:] = 0
            if item in carried:
                slots, scores = carried[item]
                sums[np.frombuffer(slots, np.uint16)] = np.frombuffer(scores, np.int64)
            for at, part in adds.get(item, ()):
                sums[at] += part
            at = np.flatnonzero(sums)
            values = sums[at]
            least, rest = bounds.get(item, (0, 0))
            if len(values) > how.top:
                least = max(least, int(np.partition(values, len(values) - how.top)[len(values) - how.top]))
            good = values + rest >= least
            at, values = at[good], values[good]
            if not len(at):
                continue
            if last:
                order = np.lexsort((ids[at], -values))[: how.top]
                out.append((part_no, block, item, None, None, values[order].tolist(), ids[at][order].tolist()))
            else:
                tops = np.sort(values)[::-1][: how.top].tolist()
                out.append((part_no, block, item, at.astype(np.uint16).tobytes(), values.tobytes(), tops, None))
        kinds = [pa.int64()] * 3 + [pa.binary()] * 2 + [pa.list_(pa.int64())] * 2
        columns = list(zip(*out, strict=True)) if out else [()] * len(kinds)
        names = ["part", "block", "item", "slots", "scores", "tops", "ids"]
        return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return step


def _part(item: Column | str, parts: int) -> Column:
    return F.pmod(F.xxhash64(item), F.lit(parts)).cast("bigint")


def search(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    column: str = "text",
    how: Search | None = None,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``how.top`` best documents of every item.

    Terms are the maximal stretches of ASCII letters and digits and of characters
    beyond ASCII, A-Z in lower case. N documents have a term, L is the number of
    their terms with repeats; a document has n, a term occurs in df documents and
    tf times in this one. A term weighs w = floor(1000 ln((2N + 2) / (2df + 1))).
    With m = 10 + (90 n N) div L a document scores the sum of
    w * ((10^9 tf) div (1000 tf + 8m)) over the terms of the item, each once.

    Documents with a score of 0 are not returned; equal scores rank by ``doc_id``,
    a document without an id first. Null and empty texts have no terms; very long
    ones count whole. Rows with one id are documents, or items, of their own.
    An empty table, or one without a term, gives an empty result. ``doc_id`` is
    a whole number above the smallest one.
    """
    how = how or Search()
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "32m")
    terms = item_terms(items, item_id, column)
    bits = term_map(terms)
    index = build_index(docs, doc_id, column, bits, how)
    headers = index.filter("term IS NULL")
    total = headers.agg(F.sum("df").alias("n"), F.sum("words").alias("l")).first()
    n_docs, n_words = total["n"] or 0, total["l"] or 1
    owners = len(how.rarity) + 1
    figures = stage(term_figures(index, terms, n_docs, n_words, how))
    n_items = terms.select("item").distinct().count()
    parts = max(1, -(-n_items // how.group))

    # What an item can still get from the owners after each one.
    asked = stage(terms.join(figures, "term").withColumn("part", _part("item", parts)))
    after = [F.sum(F.when(F.col("owner") > k, F.col("most")).otherwise(0)).alias(f"rest{k}") for k in range(owners)]
    rest = asked.groupBy("item").agg(*after)
    bundles = least = None
    for k in range(owners):
        here = asked.filter(F.col("owner") == k).join(rest.select("item", F.col(f"rest{k}").alias("rest")), "item")
        bound = F.lit(0).cast("bigint")
        if least is not None:
            here = here.join(least, "item", "left")
            bound = F.coalesce("least", bound)
        # At most how.group items or so share a part, which bounds the list.
        ask = F.struct("item", bound.alias("least"), "rest")
        asks = here.groupBy("term", "part").agg(F.first("weight").alias("weight"), F.collect_list(ask).alias("asks"))
        postings = index.drop("ids").join(asks, "term").select("part", "block", "slots", "times", "lengths", "weight", "asks", F.lit(None).cast("binary").alias("ids"))
        if k == owners - 1:
            numbered = headers.select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))).alias("part"), "block", "ids")
            postings = postings.unionByName(numbered, allowMissingColumns=True)
        if bundles is None:
            bundles = spark.createDataFrame([], BUNDLE)
        step = _owner_step(how, n_docs, n_words, k == owners - 1)
        bundles = stage(bundles.groupBy("part", "block").cogroup(postings.groupBy("part", "block")).applyInArrow(step, BUNDLE))
        best = bundles.select("item", F.explode("tops").alias("score"))
        ranked = best.withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(F.desc("score"))))
        least = ranked.filter(F.col("rank") <= how.top).groupBy("item").agg(F.min(F.when(F.col("rank") == how.top, F.col("score"))).alias("least"))

    found = bundles.select("item", F.explode(F.arrays_zip(F.col("tops").alias("score"), F.col("ids").alias("doc_id"))).alias("c")).select("item", "c.*")
    order = W.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    first = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= how.top)
    names = terms.select("item", "item_id").distinct()
    no_id = F.col("doc_id") == F.lit(-(1 << 63))
    return first.join(names, "item").select("item_id", "rank", F.when(~no_id, F.col("doc_id")).alias("doc_id"), "score")
