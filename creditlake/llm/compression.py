"""Compression bands: repetitive or incompressible text by its zstandard ratio.

A ratio is compressed size over size, of the whole text and of fixed chunks.
Short texts compress badly and long ones well, so each length has limits of its
own. A text is

* ``repetitive`` when its whole ratio lies below the band of its length, or when
  at least ``chunk_share`` of its chunks lie below the chunk band (a long run of
  the same passage inside an otherwise ordinary text);
* ``incompressible`` when the whole ratio or that share of chunks lies above
  (keys, encoded binaries, random characters).

Every figure is taken from the whole text. Null and empty texts have no words,
all figures 0, a null ratio, and fail the base rules.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from itertools import count

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\v\f\r"


@dataclass(frozen=True)
class Bands:
    """Limits by length in bytes: (shorter than, lowest ratio, highest ratio)."""

    whole: tuple[tuple[float, float, float], ...] = (
        (256, 0.30, 1.20),
        (512, 0.30, 1.00),
        (1024, 0.28, 0.85),
        (2048, 0.25, 0.80),
        (8192, 0.20, 0.75),
        (65536, 0.18, 0.72),
        (float("inf"), 0.15, 0.70),
    )
    chunk_bytes: int = 4096
    chunk: tuple[float, float] = (0.18, 0.80)
    chunk_share: float = 0.5
    level: int = 3
    fewest_words: int = 50
    most_repeated_percent: int = 50

    def of(self, size: int) -> tuple[float, float]:
        return next((low, high) for below, low, high in self.whole if size < below)


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of three that occur twice or more, first occurrences included."""
    if len(words) < 4:
        return 0
    known = dict(zip(dict.fromkeys(words), count(), strict=False))
    ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
    pairs = ids[:-1] * len(known) + ids[1:]
    if len(known) > 2_000_000:  # the product of three would not fit 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(known) + ids[2:]
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    found = np.isin(windows, np.unique(twice))
    hit = np.zeros(len(words), bool)
    for shift in range(3):
        hit[shift : shift + len(found)] |= found
    return int(hit.sum())


def chunks(raw: bytes, size: int) -> list[bytes]:
    """Fixed chunks; a tail of less than a quarter belongs to the chunk before it."""
    starts = list(range(0, len(raw), size))
    if len(starts) > 1 and len(raw) - starts[-1] < size // 4:
        starts.pop()
    return [raw[a:b] for a, b in zip(starts, [*starts[1:], len(raw)], strict=True)]


def judge(raw: bytes, bands: Bands, packer: zstandard.ZstdCompressor):
    """(whole ratio, lowest chunk ratio, highest chunk ratio, reason or None)."""
    if not raw:
        return None, None, None, None
    whole = len(packer.compress(raw)) / len(raw)
    parts = [len(packer.compress(c)) / len(c) for c in chunks(raw, bands.chunk_bytes)] if len(raw) > bands.chunk_bytes else []
    low, high = bands.of(len(raw))
    needed = max(1, bands.chunk_share * len(parts))
    reason = None
    if whole < low or sum(r < bands.chunk[0] for r in parts) >= needed:
        reason = "repetitive"
    elif whole > high or sum(r > bands.chunk[1] for r in parts) >= needed:
        reason = "incompressible"
    return whole, min(parts, default=whole), max(parts, default=whole), reason


FIELDS = [
    *[T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
    T.StructField("base_failed", T.BooleanType()),
    T.StructField("kept", T.BooleanType()),
    *[T.StructField(n, T.DoubleType()) for n in ("ratio", "lowest_chunk_ratio", "highest_chunk_ratio")],
    T.StructField("reason", T.StringType()),
]


def measure_texts(texts: list[bytes | None], bands: Bands) -> list[list]:
    packer = zstandard.ZstdCompressor(level=bands.level)
    rows = []
    for raw in texts:
        raw = raw or b""
        words = raw.split()  # exactly the six blanks of ASCII
        blanks = sum(raw.count(c) for c in BLANKS)
        symbols = sum(raw.count(c) for c in SYMBOLS)
        copies = sum(n - 1 for line, n in Counter(raw.split(b"\n")).items() if n > 1 and line.strip())
        repeated = repeated_words(words)
        failed = len(words) < bands.fewest_words or 100 * repeated > bands.most_repeated_percent * len(words)
        whole, lowest, highest, reason = judge(raw, bands, packer)
        rows.append(
            (len(words), len(raw.decode()) - blanks, symbols, copies, repeated, failed, not failed and reason is None)
            + (whole, lowest, highest, "base" if failed else reason)
        )
    return [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in FIELDS]


def compression_bands(docs: DataFrame, bands: Bands | None = None) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): the base figures, the ratios and the verdict.

    One pass without a shuffle; other columns of ``docs`` are ignored, repeated
    rows are judged one by one, an empty table gives no rows.
    """
    bands = bands or Bands()
    narrow = docs.select("doc_id", "text")
    return append_columns(narrow, "text", lambda texts: measure_texts(texts, bands), FIELDS).select(
        "doc_id", *[F.col(f.name) for f in FIELDS]
    )
