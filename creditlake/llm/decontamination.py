"""Benchmark decontamination with suffix arrays of the training text.

Every task builds suffix arrays over its shards, that is over batches of
documents. Words that no benchmark item holds end a suffix, and suffixes too
short for the shortest window are left out, so an array holds only what a test
suffix could match. Every test suffix is found by binary search; its matches are
followed to their full length. Results are the longest verbatim matches with
their places: document word, item, length.

A window is ``words`` consecutive words of an item, or a whole shorter item. Both
sides are compared as lower-case words of letters and digits.

The benchmark is read in blocks of at most ``BLOCK_BYTES`` of text, each of which
is sent to the tasks once; the documents pass through one search per block
without a shuffle, whatever the size of the benchmark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER_WORDS, append_columns, send, unused

WINDOW = 10
BLOCK_BYTES = 4 << 20
SHARD_WORDS = 1 << 20

MATCH = T.StructType(
    [
        T.StructField("start", T.LongType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("item_start", T.LongType()),
        T.StructField("length", T.LongType()),
    ]
)


def words_of(raw: bytes | None) -> list[bytes]:
    return raw.translate(LOWER_WORDS).split() if raw else []


class Block:
    """Test suffixes of some items, grouped by the length of their window.

    ``tokens`` holds the items one after the other, each followed by a -1, as ids
    of ``vocabulary`` from 1 on.
    """

    def __init__(self, items: list[tuple[str, bytes]], window: int) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.names, tokens, owner, place, needs, ends = [], [], [], [], [], []
        for name, raw in items:
            words = words_of(raw)
            if not words:
                continue
            need = min(window, len(words))
            base, end = len(tokens), len(tokens) + len(words)
            tokens += [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words] + [-1]
            last = len(words) - need
            owner += [len(self.names)] * (last + 1)
            place += range(base, base + last + 1)
            needs += [need] * (last + 1)
            ends += [end] * (last + 1)
            self.names.append((name, base))
        self.tokens = np.array(tokens, np.int64)
        self.owner, self.place = np.array(owner, np.int64), np.array(place, np.int64)
        self.ends = np.array(ends, np.int64)
        needs = np.array(needs, np.int64)
        self.by_need = [(int(n), np.flatnonzero(needs == n)) for n in np.unique(needs)]


def keys(tokens: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """The ``length`` words from each start as byte strings that sort as the suffixes do."""
    rows = tokens[starts[:, None] + np.arange(length)].astype(">u4")
    return np.ascontiguousarray(rows).view(f"S{4 * length}").ravel()


def matches_in(tokens: np.ndarray, block: Block) -> Iterator[tuple[np.ndarray, ...]]:
    """(train start, item number, item token, length) of the longest matches in a shard.

    ``tokens`` has 0 for words outside the vocabulary and between documents.
    """
    dead = np.flatnonzero(tokens == 0)
    if len(dead) == len(tokens):
        return
    stops = np.append(dead, len(tokens))
    at = np.arange(len(tokens))
    run = stops[np.searchsorted(stops, at)] - at
    for need, chosen in block.by_need:
        suffixes = np.flatnonzero(run >= need)
        if not len(suffixes):
            continue
        train = keys(tokens, suffixes, need)
        order = np.argsort(train, kind="stable")
        train, suffixes = train[order], suffixes[order]
        tests = keys(block.tokens, block.place[chosen], need)
        low, high = np.searchsorted(train, tests, "left"), np.searchsorted(train, tests, "right")
        many = high - low
        if not many.any():
            continue
        test = np.repeat(chosen, many)
        offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        start = suffixes[np.repeat(low, many) + offset]
        place = block.place[test]
        # A match that can be moved one word to the left is part of a longer one.
        before = (start > 0) & (place > 0)
        first = ~before | (tokens[start - 1] != block.tokens[place - 1])
        start, place, test = start[first], place[first], test[first]
        length = np.full(len(start), need)
        growing = np.arange(len(start))
        while len(growing):
            s, p = start[growing] + length[growing], place[growing] + length[growing]
            inside = (s < len(tokens)) & (p < block.ends[test[growing]])
            growing, s, p = growing[inside], s[inside], p[inside]
            growing = growing[tokens[s] == block.tokens[p]]
            length[growing] += 1
        yield start, block.owner[test], place, length


def search(texts: list[bytes | None], block: Block) -> tuple[list[int], list[list[tuple]]]:
    """Per text: number of words and its matches, from one suffix array per shard."""
    counts, found = [], [[] for _ in texts]
    shard: list[np.ndarray] = []
    owners: list[int] = []

    def flush() -> None:
        if not shard:
            return
        sizes = np.array([len(s) for s in shard])
        begins = np.cumsum(sizes) - sizes
        for start, owner, place, length in matches_in(np.concatenate(shard), block):
            where = np.searchsorted(begins, start, "right") - 1
            for d, s, o, p, n in zip(where, start, owner, place, length, strict=True):
                name, base = block.names[o]
                found[owners[d]].append((int(s - begins[d]), name, int(p - base), int(n)))
        shard.clear()
        owners.clear()

    held = 0
    for i, raw in enumerate(texts):
        words = words_of(raw)
        counts.append(len(words))
        if words:
            ids = np.fromiter(map(block.vocabulary.get, words, [0] * len(words)), np.int64, len(words))
            shard.append(np.append(ids, 0))
            owners.append(i)
            held += len(words)
            if held >= SHARD_WORDS:
                flush()
                held = 0
    flush()
    for rows in found:
        rows.sort()
    return counts, found


def blocks(benchmark: DataFrame, window: int, limit: int) -> Iterator[Block]:
    held, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("binary")).filter("text is not null")
    for name, raw in rows.toLocalIterator():
        if held and size + len(raw) > limit:
            yield Block(held, window)
            held, size = [], 0
        held.append((name, bytes(raw)))
        size += len(raw)
    yield Block(held, window)


def with_matches(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> tuple[DataFrame, str, str]:
    """``docs`` with a column of word counts and one of matches; also their names."""
    n_words, matches = unused(docs.columns, "n_words", "matches")
    found = None
    for block in blocks(benchmark, window, block_bytes):
        sent = send(docs.sparkSession, block)
        (count, part) = unused([*docs.columns, *(found.columns if found is not None else [])], "_count", "_part")
        fields = [T.StructField(count, T.LongType()), T.StructField(part, T.ArrayType(MATCH))]
        step = append_columns(
            docs if found is None else found, "text", lambda texts, sent=sent: list(search(texts, sent())), fields
        )
        if found is None:
            found = step.withColumnsRenamed({count: n_words, part: matches})
        else:
            found = step.withColumn(matches, F.concat(matches, part)).drop(count, part)
    return found, n_words, matches


def hit_words(matches) -> F.Column:
    """Words inside any match: the length of the union of intervals."""
    ordered = F.array_sort(F.transform(matches, lambda m: F.struct(m["start"], m["start"] + m["length"])))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))

    def add(done, m):
        begin, end = m["start"], m["col2"]
        new = F.greatest(F.lit(0).cast("long"), end - F.greatest(begin, done["end"]))
        return F.struct((done["n"] + new).alias("n"), F.greatest(done["end"], end).alias("end"))

    return F.aggregate(ordered, zero, add, lambda done: done["n"])


def decontamination_report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: words, hit words, items with windows in it, and the matches themselves.

    A null or empty text has no words; an empty benchmark hits nothing; items
    that share an id count once; repeated rows are judged one by one. Other
    columns of both tables are ignored.
    """
    found, n_words, matches = with_matches(docs.select("doc_id", "text"), benchmark, window)
    items = F.array_sort(F.array_distinct(F.filter(F.col(f"{matches}.item_id"), lambda i: i.isNotNull())))
    return (
        found.withColumn("_items", items)
        .withColumn("n_hit", hit_words(F.col(matches)))
        .select(
            "doc_id",
            F.col(n_words).alias("n_words"),
            "n_hit",
            F.size("_items").cast("long").alias("n_items"),
            F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"),
            (F.col("n_hit") > 0).alias("contaminated"),
            F.col(matches).alias("matches"),
        )
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any window of a benchmark item, all columns as they were."""
    found, _, matches = with_matches(docs, benchmark, window)
    return found.filter(F.size(matches) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
