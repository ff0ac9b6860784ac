"""Helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import MAP_BITS, bit_words

# Rows that a Python worker holds at once. A batch of ordinary documents is a
# few MB; one text is at most Spark's own 2 GB per value.
BATCH_ROWS = 1000

# Byte tables for words of letters and digits: A-Z become a-z, other ASCII that
# is neither letter nor digit becomes a space, bytes above 127 stay.
LOWER_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def unused(columns: Iterable[str], *wanted: str) -> list[str]:
    """Names like ``wanted`` that clash with no column, also not in another case."""
    taken = {c.lower() for c in columns}
    found = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def send(spark: SparkSession, value: object) -> Callable[[], object]:
    """Broadcast ``value``, whose size the caller bounds; the result returns it inside a task."""
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    held: list = []

    def get():
        if not held:
            held.append(cloudpickle.loads(packed.value))
        return held[0]

    return get


def bit_map(keys: DataFrame, bits: int) -> np.ndarray:
    """Bits of the column ``key`` of ``keys``: ``bits`` / 8 bytes, whatever their number."""
    found = bit_words(keys, bits).toArrow()
    made = np.zeros(bits // 64, np.int64)
    made[found.column("at").to_numpy()] = found.column("bits").to_numpy()
    return made.view(np.uint64)


def in_map(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the map ``bits`` may hold each key; one that it holds is never missed."""
    place = keys.view(np.uint64) % np.uint64(64 * len(bits))
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def may_match(rows: DataFrame, key: Column) -> Callable[[Column], Column]:
    """A test that is true for every value equal to a ``key`` of ``rows``, and for few others.

    ``key`` is a 64-bit hash. Only rows that pass need meet ``rows`` in an exact join, so
    the others, with their texts, are not shuffled.
    """
    held = send(rows.sparkSession, bit_map(rows.select(key.alias("key")), MAP_BITS))

    @F.arrow_udf("boolean")
    def test(keys: pa.Array) -> pa.Array:
        return pa.array(in_map(held(), keys.to_numpy(zero_copy_only=False)))

    return test


def arrow_map(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType
) -> DataFrame:
    """``df.mapInArrow`` in batches of at most ``BATCH_ROWS`` rows."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(work, schema)


def append_columns(
    df: DataFrame,
    column: str,
    measure: Callable[[list[bytes | None]], list[list]],
    fields: list[T.StructField],
) -> DataFrame:
    """Every row of ``df`` with new columns that ``measure`` derives from the text in ``column``.

    ``measure`` takes the UTF-8 bytes of a batch of texts and returns one list
    per field. Rows keep their other columns, their order and their partition.
    """
    schema = T.StructType([*df.schema.fields, *fields])
    place = df.columns.index(column)
    types = [pa_type(f.dataType) for f in fields]

    def work(batches):
        for batch in batches:
            texts = batch.column(place).cast(pa.binary()).to_pylist()
            made = [pa.array(v, type=t) for v, t in zip(measure(texts), types, strict=True)]
            names = [*batch.schema.names, *[f.name for f in fields]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=names)

    return arrow_map(df, work, schema)


def pa_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(pa_type(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, pa_type(f.dataType)) for f in kind.fields])
    return {
        T.LongType(): pa.int64(),
        T.IntegerType(): pa.int32(),
        T.DoubleType(): pa.float64(),
        T.BooleanType(): pa.bool_(),
        T.StringType(): pa.string(),
        T.BinaryType(): pa.binary(),
    }[kind]
