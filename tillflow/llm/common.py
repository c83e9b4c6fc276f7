"""Helpers that the operators share: stored tables, fixed-size filters, batches of text."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.session import scratch_dir

#: Stands for a null id where ids are ordered: before every other.
LEAST = -(2**63)

#: Bytes of rows that go to a Python worker together, about; Spark's own bound is 64 MB or 10,000 rows.
BATCH = "4m"
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends here.

    Any executor can read the files, so a lost one costs its running tasks only.
    The folder goes when the session's JVM ends.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    # Spark drops the shuffle files of a finished query when its plan is collected as garbage
    gc.collect()
    spark._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """From now on this session's Arrow batches hold about ``BATCH``, unless it has a bound of its own.

    A task holds a batch in its JVM, outside the heap, and again in its Python worker. Steps run
    when their result is read, so the setting stays.
    """
    if _BATCH_KEY not in spark.conf.getAll:
        spark.conf.set(_BATCH_KEY, BATCH)


def ordered_id(name: str = "doc_id") -> Column:
    return F.coalesce(F.col(name).cast("long"), F.lit(LEAST))


def whole_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


# --- filters of a fixed size -------------------------------------------------


def bit_filter(keys: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of ``2**bits`` bits of the column ``key`` (long): ``2**bits / 8`` bytes at any input.

    ``passes`` finds every key of ``keys``, and others with the share of bits set. It only
    saves shuffled rows; what passes must be joined or judged exactly.
    """
    place = F.shiftrightunsigned("key", 64 - bits)
    rows = (
        keys.select((place + 1).alias("at"))
        .groupBy(F.bitmap_bucket_number("at").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
        .toArrow()
    )
    out = np.zeros(2**bits // 8, np.uint8)
    for bucket, part in zip(rows["bucket"].to_pylist(), rows["bits"].to_pylist(), strict=True):
        at = (bucket - 1) * 4096
        piece = np.frombuffer(part, np.uint8)[: len(out) - at]
        out[at : at + len(piece)] = piece
    return out


def passes(filter_: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of ``keys`` (uint64) the filter lets through."""
    shift = 64 - (len(filter_) * 8).bit_length() + 1
    at = (keys >> np.uint64(shift)).astype(np.int64)
    return (filter_[at >> 3] >> (at & 7).astype(np.uint8)) & 1 != 0


# --- text in Arrow batches ---------------------------------------------------


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column, end to end, and the offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def portions(
    data: np.ndarray, offsets: np.ndarray, size: int = 1 << 20
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a column into runs of rows of about ``size`` bytes; a longer row comes alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        j = min(j, n)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``starts[0] .. starts[0]+lengths[0]-1, starts[1] ..`` end to end."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
