"""Periodic runs of words: maximal stretches that repeat themselves, and texts without the repeats.

A run is a stretch of consecutive words with smallest period q that is at least
``max(least, 2 * q)`` words long and that no neighbouring word extends. The runs
of a sequence are found from its Lyndon arrays. In one of the two orders of the
alphabet, the longest Lyndon word at some place of a run is exactly one period
long (its Lyndon root), so extending the longest Lyndon words of both orders to
both sides gives every run.

* *Lyndon arrays by Baier's grouping.* The first phase of his suffix sorter puts
  suffixes into groups that share a prefix, the group's context. Groups are
  handled from the highest to the lowest. A handled group lengthens the contexts
  of the suffixes just before its members by its own, and moves them into higher
  groups. When a group is handled, its context is the longest Lyndon word that
  starts at its members, so no suffix array and no second phase is needed. The
  time is linear, as an already handled place points over all the higher ones on
  its left.
* *Extension by LCE.* Numbers for all stretches of 1, 2, 4, 8, ... words answer
  "how far do two places agree", to the right and to the left, for all candidates
  of a sequence at once.

A run of at least ``least`` words contains, twice, a stretch of half as many
words, and such stretches cover all of it. Only the parts of a text that repeated
stretches cover are looked at, which is most often nothing.

Everything happens inside one text, so the operator is a map without a shuffle.
A task holds a batch of texts, by Spark's row and byte limits for Arrow batches,
and for the text at hand some 300 bytes per repeated word.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, unused

LEAST = 12
RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
BATCH_BYTES = "32m"


def lyndon_array(values: Sequence[int]) -> list[int]:
    """The length of the longest Lyndon word at every place of ``values``."""
    n = len(values)
    places = sorted(range(n), key=values.__getitem__)
    group = [0] * n  # by place: where the group of its suffix starts in ``places``
    size = [0] * n  # by start of a group
    context = [0] * n  # by start of a group: the length of the shared prefix
    slot = [0] * n  # by place: its index in ``places``
    first = 0
    for at, place in enumerate(places):
        if values[place] != values[places[first]]:
            first = at
        group[place] = first
        size[first] += 1
        context[first] = 1
        slot[place] = at
    before = [-1] * n  # by place, once handled: the nearest lower group on its left
    found = [0] * n
    end = n
    while end:
        g = group[places[end - 1]]
        members = sorted(places[g:end])
        length = context[g]
        times: dict[int, int] = {}
        for i in members:
            found[i] = length
            j = i - 1
            while j >= 0 and group[j] >= g:
                j = before[j]
            before[i] = j
            if j >= 0:
                times[j] = times.get(j, 0) + 1
        end = g
        by_times: dict[int, list[int]] = {}
        for j, k in times.items():
            by_times.setdefault(k, []).append(j)
        for k in sorted(by_times, reverse=True):
            touched: dict[int, int] = {}
            for j in by_times[k]:
                old = group[j]
                size[old] -= 1
                last = old + size[old]
                moved, there = places[last], slot[j]
                places[there], places[last] = moved, j
                slot[moved], slot[j] = there, last
                touched[old] = touched.get(old, 0) + 1
            for old, number in touched.items():
                new = old + size[old]
                grown = context[old] + k * length
                size[new], context[new] = number, grown
                for at in range(new, new + number):
                    group[places[at]] = new
    return found


class Agreement:
    """How far the words at two places agree, to the right and to the left."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.levels = [np.unique(values, return_inverse=True)[1].astype(np.int64)]
        width = 1
        while 2 * width <= self.n:
            last = self.levels[-1]
            pairs = last[:-width] * (self.n + 1) + last[width:]
            self.levels.append(np.unique(pairs, return_inverse=True)[1].astype(np.int64))
            width *= 2

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that agree from ``a`` and ``b`` on, where ``a < b``."""
        far = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            fits = b + far < len(level)
            same = np.zeros(len(a), bool)
            same[fits] = level[(a + far)[fits]] == level[(b + far)[fits]]
            far[same] += 1 << k
        return far

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that agree before ``a`` and ``b``, where ``a < b``."""
        far = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level, width = self.levels[k], 1 << k
            fits = a - far >= width
            same = np.zeros(len(a), bool)
            same[fits] = level[(a - far)[fits] - width] == level[(b - far)[fits] - width]
            far[same] += width
        return far


def runs_of_part(values: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence."""
    n = len(values)
    ranks = np.unique(values, return_inverse=True)[1]
    places = np.arange(n)
    starts, periods = [], []
    for order in (ranks, -ranks):
        lengths = np.array(lyndon_array(order.tolist()), np.int64)
        open_ended = places + lengths < n
        starts.append(places[open_ended])
        periods.append(lengths[open_ended])
    start, period = np.concatenate(starts), np.concatenate(periods)
    agreement = Agreement(ranks)
    first = start - agreement.left(start, start + period)
    length = start + period + agreement.right(start, start + period) - first
    good = length >= np.maximum(least, 2 * period)
    return sorted(set(zip(first[good].tolist(), length[good].tolist(), period[good].tolist(), strict=True)))


def repeated_parts(values: np.ndarray, width: int) -> list[tuple[int, int]]:
    """[start, end) of the parts that repeated stretches of ``width`` words cover.

    Stretches are compared by 64-bit hashes: equal ones always meet, and a
    chance meeting only makes a part longer.
    """
    n = len(values) - width + 1
    if n < 2:
        return []
    mixed = (values.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    code = np.zeros(n, np.uint64)
    for k in range(width):
        code = code * np.uint64(0xBF58476D1CE4E5B9) + mixed[k : k + n]
    ordered = np.sort(code)
    repeated = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(repeated):
        return []
    at = np.flatnonzero(np.isin(code, repeated))
    edges = np.zeros(len(values) + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + width, -1)
    covered = np.cumsum(edges[:-1]) > 0
    bounds = np.flatnonzero(np.diff(np.concatenate(([False], covered, [False])).astype(np.int8)))
    return list(zip(bounds[::2].tolist(), bounds[1::2].tolist(), strict=True))


def find_runs(words: Sequence, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``words``, by start, then period."""
    if len(words) < least:
        return []
    numbers: dict = {}
    values = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    found = []
    for a, b in repeated_parts(values, (least + 1) // 2):
        if b - a >= least:
            found += [(a + s, length, p) for s, length, p in runs_of_part(values[a:b], least)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: Sequence[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay: those that no run contains after its first period."""
    edges = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:-1]) == 0


def periodic_runs(df: DataFrame, column: str = "text", least: int = LEAST) -> tuple[DataFrame, str, str, str]:
    """Every row of ``df`` with the number of words, the runs and the collapsed text of ``column``.

    Words are separated by blanks, tabs and line breaks (``[^\\x20\\x09-\\x0D]+``)
    and compared as they are. Runs are ordered by start, then period. The
    collapsed text joins the words that stay by one space.

    Returns the frame and the names of the three new columns, which avoid those
    of ``df``. Null and empty texts have no words, no runs and an empty collapsed
    text; a very long text is handled whole, in one task; repeated rows each get
    their result; an empty table gives an empty one; other columns stay.
    """
    if least < 4:
        raise ValueError("runs of fewer than 4 words are not looked for")
    words_name, runs_name, text_name = unused(df.columns, "n_words", "runs", "collapsed")
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)

    def measure(texts):
        numbers, runs, collapsed = [], [], []
        for text in texts:
            words = (text or b"").split()
            found = find_runs(words, least)
            numbers.append(len(words))
            runs.append([{"start": s, "length": n, "period": p} for s, n, p in found])
            if found:
                words = [words[i] for i in np.flatnonzero(kept_words(len(words), found)).tolist()]
            collapsed.append(b" ".join(words).decode())
        return [numbers, runs, collapsed]

    fields = [
        T.StructField(words_name, T.LongType()),
        T.StructField(runs_name, T.ArrayType(RUN)),
        T.StructField(text_name, T.StringType()),
    ]
    return append_columns(df, column, measure, fields), words_name, runs_name, text_name


def run_report(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): its runs in figures and digests.

    ``start``, ``length``, ``period`` and ``exponent_milli`` are those of the
    longest run (ties: smallest start, then period), null without a run.
    """
    found, _, runs, collapsed = periodic_runs(docs.select("doc_id", "text"))
    longest = F.array_max(
        F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    )
    lines = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    shown = found.select("doc_id", F.size(runs).cast("long").alias("n_runs"), longest.alias("_top"),
                         F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size(runs) > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
                         F.sha2(collapsed, 256).alias("collapsed_sha256"))
    length, period = F.col("_top.length"), -F.col("_top.period")
    return shown.select(
        "doc_id",
        "n_runs",
        (-F.col("_top.start")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
