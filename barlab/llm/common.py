"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlab.session import scratch_dir, ship_package

#: Rows a side may have to be broadcast; checked by counting, never assumed.
BROADCAST_ROWS = 200_000
#: More groups than this can't be larger than 1/HOT_GROUPS of the rows.
HOT_GROUPS = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def short_batches(spark: SparkSession) -> None:
    """Whole texts go to Python a thousand rows at a time, unless the session
    asks for another number than Spark's default of ten thousand: that many long
    texts would be held at once, in Spark's buffers and in the worker."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name, "10000") == "10000":
        spark.conf.set(name, "1000")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back: cuts
    lineage, and a lost executor re-reads files instead of recomputing."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_join(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner",
               limit: int = BROADCAST_ROWS) -> DataFrame:
    """Join; ``right`` is broadcast only if counting shows at most ``limit``
    rows.  Beyond that it is a shuffle join that AQE may split on skew."""
    if right.limit(limit + 1).count() <= limit:
        return left.join(F.broadcast(right), on, how)
    return left.join(right, on, how)


def answers_to_rows(rows: DataFrame, answers: DataFrame, key: str, size: str) -> DataFrame:
    """Left join of per-group ``answers`` to the groups' rows, whatever the size
    of a group: groups above 1/``HOT_GROUPS`` of the rows, of which there can be
    at most ``HOT_GROUPS``, are broadcast, all others are joined by shuffle.
    Rows with a null key get null answers."""
    limit = max(1_000, rows.count() // HOT_GROUPS)
    hot = F.broadcast(answers.filter(F.col(size) > limit))
    rest = answers.filter(F.col(size) <= limit)
    found = rows.join(hot, key).unionByName(
        rows.filter(F.col(key).isNotNull()).join(hot.select(key), key, "left_anti").join(rest, key))
    none = [F.lit(None).cast(answers.schema[c].dataType).alias(c) for c in answers.columns if c != key]
    return found.unionByName(rows.filter(F.col(key).isNull()).select("*", *none).select(*found.columns))


def text_key(text_col: str) -> Column:
    """64-bit hash of a text, null as empty: with the identifier it names a row."""
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def same_row(id_col: str, text_col: str) -> Column:
    """Condition between documents and decisions ``__gone`` (identifier, null
    equals null) and ``__key`` (``text_key``)."""
    return F.col(id_col).cast("long").eqNullSafe(F.col("__gone")) & (text_key(text_col) == F.col("__key"))


def anti_rows(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str, limit: int = 1_000_000) -> DataFrame:
    """``docs`` without the rows that ``gone`` (``__gone, __key``) names; it is
    broadcast only if counting shows at most ``limit`` rows.  ``gone`` is written
    before it is counted, so what finds it runs once."""
    gone = written(gone, "gone")
    few = gone.limit(limit + 1).count() <= limit
    return docs.join(F.broadcast(gone) if few else gone, same_row(id_col, text_col), "left_anti")


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """True where crc32(id as text) mod ``modulus`` is ``remainder``; a null id
    counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def text_bytes(column: pa.Array | pa.ChunkedArray) -> Iterator[bytes]:
    """UTF-8 bytes of each text; null counts as empty.  Goes through slices so
    that one batch of very long texts is never held twice."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    binary = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    for start in range(0, len(binary), 256):
        for value in binary.slice(start, 256).to_pylist():
            yield value or b""


class WordHash(dict):
    """word bytes -> 64-bit hash, cached for one task; cleared when full so that
    memory stays bounded whatever the vocabulary."""

    def __init__(self, limit: int = 100_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def batch_of(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                                       for c, f in zip(columns, schema)], schema=schema)
