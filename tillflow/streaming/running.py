"""Running totals per record over a stream, on Spark's own state.

The totals so far of each key are engine state (RocksDB, in the checkpoint), so restarts and
retried batches need no care. What reaches the state is not a sale but a block: each task of a
micro-batch adds up its rows by key and block of the order and sends one total with the rows
packed behind it. The state hands each block its start; the rows are unpacked and added up
block by block, spread over all tasks. A key with a third of all rows costs its task a few
additions, and passes its packed rows on unread.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tillflow.session import engine_config
from tillflow.streaming.batches import BatchSink, parquet_batches, write_each_batch

# Helper columns; pandas renames those that begin with an underscore.
_GROUP, _BLOCK, _PART, _SUM, _ROWS, _TOTAL, _N, _NUMBER = (
    f"running__{c}" for c in ("group", "block", "part", "sum", "rows", "total", "n", "number")
)
# Rows that a task packs together, and order numbers of a block.
_PACK = 1 << 16
BLOCK = 1 << 20
_EMPTY = "spark.sql.streaming.noDataMicroBatches.enabled"
_STORE = "spark.sql.streaming.stateStore.providerClass"


class RunningTotals:
    """The stages of running totals of one stream.

    ``blocks`` is a stream with one row a packed block; `rows` turns a micro-batch of it into
    the records with ``n, total, mean`` so far. Rows count batch by batch, and in ``order``
    within a batch. ``key`` may be several columns. ``order`` is an integer column, or several
    columns of which the last is one; ``ties`` settle equal values. A value that ``sum_type``
    cannot hold counts as NULL. ``ttl`` (as ``"1 day"``) forgets a key that had no row for so
    long, by the clock, with the next micro-batch; by default keys are kept for ever.
    """

    def __init__(
        self,
        df: DataFrame,
        key: str | Sequence[str],
        measure: str,
        order: str | Sequence[str],
        *,
        ties: Sequence[str] = (),
        sum_type: str = "double",
        block: int = BLOCK,
        ttl: str | None = None,
    ):
        keys = [key] if isinstance(key, str) else list(key)
        *lead, last = [order] if isinstance(order, str) else order
        if not isinstance(df.schema[last].dataType, T.IntegralType):
            raise TypeError(f"order column {last} must be an integer")
        self.kept = [c for c in df.columns if c.lower() not in ("n", "total", "mean")]
        self.order = [*lead, last, *ties]
        self.places = [*(f"{_PART}{i}" for i in range(len(lead))), _BLOCK]
        value = F.col(measure).try_cast(sum_type)
        # null keys are a group of their own, and lengths keep several texts apart
        text = [F.coalesce(F.concat(F.length(c.cast("string")), F.lit("="), c), F.lit("~")) for c in map(F.col, keys)]
        rows = df.withColumns(
            {
                _GROUP: F.concat(*text),
                **{p: F.col(c) for p, c in zip(self.places, lead, strict=False)},
                _BLOCK: F.expr(f"`{last}` div {block}L"),
                _SUM: value,
            }
        ).select(*self.kept, _GROUP, *self.places, _SUM)
        fields = {f.name: f for f in rows.schema}
        kind = df.sparkSession.range(0).select(F.sum(F.lit(None).cast(sum_type)).alias(_TOTAL)).schema[_TOTAL].dataType
        self.total = kind
        counts = [T.StructField(_TOTAL, kind), T.StructField(_N, T.LongType())]
        places = [T.StructField(p, fields[p].dataType) for p in self.places]
        packed = T.StructType([T.StructField(_GROUP, T.StringType()), *places, *counts, T.StructField(_ROWS, T.BinaryType())])
        self.record = T.StructType([T.StructField(f.name, f.dataType) for f in rows.select(*self.kept, _SUM).schema])
        self.packed = packed
        self.blocks = (
            rows.mapInArrow(_packer(packed, self.places, self.record, rows.schema), packed)
            .groupBy(_GROUP)
            .transformWithStateInPandas(
                _Starts(self.places, T.StructType(counts), _milliseconds(ttl)),
                packed,
                "update",
                "none" if ttl is None else "processingTime",
            )
        )

    def rows(self, blocks: DataFrame) -> DataFrame:
        """The records of a micro-batch, each with the totals up to it."""
        whole = T.StructType([*self.record.fields, *[f for f in self.packed if f.name != _ROWS]])
        rows = blocks.mapInArrow(_unpacker(self.record, whole), whole)
        w = (
            Window.partitionBy(_GROUP, *self.places)
            .orderBy(*self.order)
            .rowsBetween(Window.unboundedPreceding, 0)
        )
        here = F.sum(_SUM).over(w)
        # a sum of no values stays NULL
        total = F.coalesce(F.col(_TOTAL) + here, here, F.col(_TOTAL)).cast(self.total)
        n = F.col(_N) + F.count(F.lit(1)).over(w)
        added = rows.select(*self.kept, n.alias("n"), total.alias("total"))
        return added.withColumn("mean", F.col("total").cast("double") / F.col("n"))


def _milliseconds(ttl: str | None) -> int | None:
    return None if ttl is None else int(pd.Timedelta(ttl).total_seconds() * 1000)


def _packer(packed: T.StructType, places: list[str], record: T.StructType, rows: T.StructType):
    """Rows of a task to one row for each group and block, with their sum, number and Arrow bytes."""
    kind, inner = to_arrow_schema(packed), to_arrow_schema(record)
    names = [f.name for f in rows]

    def pack(table: pa.Table) -> pa.RecordBatch:
        table = table.rename_columns(names)
        by = [_GROUP, *places]
        group = table.select(by).to_pandas().groupby(by, sort=False, dropna=False).ngroup().to_numpy()
        table = table.append_column(_NUMBER, pa.array(group)).sort_by(_NUMBER)
        sums = table.group_by(_NUMBER).aggregate([(_SUM, "sum"), (_NUMBER, "count")]).sort_by(_NUMBER)
        counts = sums[f"{_NUMBER}_count"]
        sizes = counts.to_pylist()
        starts = [0, *accumulate(sizes)][:-1]
        rows_in = pa.table([table[f.name].cast(f.type) for f in inner], schema=inner)
        (whole,) = rows_in.combine_chunks().to_batches()
        bodies = [whole.slice(a, n).serialize().to_pybytes() for a, n in zip(starts, sizes, strict=True)]
        heads = table.select(by).take(pa.array(starts, pa.int64()))
        columns = [*heads.columns, sums[f"{_SUM}_sum"], counts, pa.array(bodies, pa.binary())]
        out = pa.table([c.cast(f.type) for c, f in zip(columns, kind, strict=True)], schema=kind)
        return out.combine_chunks().to_batches()[0]

    def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0
        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                n += batch.num_rows
            if n >= _PACK:
                yield pack(pa.Table.from_batches(waiting))
                waiting, n = [], 0
        if waiting:
            yield pack(pa.Table.from_batches(waiting))

    return packs


def _unpacker(record: T.StructType, whole: T.StructType):
    inner, outer = to_arrow_schema(record), to_arrow_schema(whole)
    heads = [f.name for f in whole][len(record) :]

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column(_ROWS)
            for i in range(batch.num_rows):
                rows = pa.ipc.read_record_batch(pa.py_buffer(bodies[i].as_py()), inner)
                same = [pa.repeat(batch.column(h)[i], rows.num_rows) for h in heads]
                columns = [*rows.columns, *same]
                yield pa.record_batch([c.cast(f.type) for c, f in zip(columns, outer, strict=True)], schema=outer)

    return unpack


class _Starts(StatefulProcessor):
    """Gives each block of a key the total and number of the rows before it."""

    def __init__(self, places: list[str], state: T.StructType, ttl: int | None):
        self.places, self.schema, self.ttl = places, state, ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.so_far = handle.getValueState("so_far", self.schema, self.ttl)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        total, n = self.so_far.get() if self.so_far.exists() else (None, 0)
        blocks = pd.concat(list(rows), ignore_index=True)
        blocks = blocks.sort_values(self.places, na_position="first", kind="stable", ignore_index=True)
        head = blocks[self.places]
        # equal places come from several tasks: one block, one start
        follows = [False] + [head.iloc[i].equals(head.iloc[i - 1]) for i in range(1, len(head))]
        totals, counts = [], []
        sums, sizes = blocks[_TOTAL].tolist(), blocks[_N].tolist()
        for i, again in enumerate(follows):
            if not again:
                start = (total, n)
            totals.append(start[0])
            counts.append(start[1])
            total, n = _plus(total, sums[i]), n + int(sizes[i])
        self.so_far.update((total, n))
        blocks[_TOTAL] = pd.Series(totals, index=blocks.index, dtype="object")
        blocks[_N] = counts
        yield blocks

    def close(self) -> None:
        pass


def _plus(a, b):
    if pd.isna(b):
        return a
    return b if a is None else a + b


def running_stats_stream(
    df: DataFrame,
    key: str | Sequence[str],
    measure: str,
    order: str | Sequence[str],
    out: str,
    checkpoint_root: str,
    *,
    ties: Sequence[str] = (),
    sum_type: str = "double",
    trigger: dict | None = None,
    ttl: str | None = None,
    block: int = BLOCK,
) -> StreamingQuery:
    """`running_stats` of a stream into ``out``, one ``batch_id=`` folder per micro-batch."""
    totals = RunningTotals(df, key, measure, order, ties=ties, sum_type=sum_type, ttl=ttl, block=block)
    keep = parquet_batches(out)
    return each_batch_of_rows(totals, keep, f"{checkpoint_root}/query", trigger)


def each_batch_of_rows(
    totals: RunningTotals, sink: BatchSink, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Hand every micro-batch of records with their totals to ``sink``."""

    def write(blocks: DataFrame, batch_id: int) -> None:
        sink(totals.rows(blocks), batch_id)

    # Spark would run empty batches without end for the clock's sake; state expires with any batch
    settings = {_EMPTY: "false"}
    conf = totals.blocks.sparkSession.conf
    if conf.get(_STORE).endswith(".HDFSBackedStateStoreProvider"):  # Spark's default cannot hold this state
        settings |= {k: v for k, v in engine_config().items() if ".stateStore." in k}
    before = {k: conf.get(k, None) for k in settings}
    # a query keeps the settings of its start
    for k, v in settings.items():
        conf.set(k, v)
    try:
        return write_each_batch(totals.blocks, write, checkpoint, trigger, "update")
    finally:
        for k, v in before.items():
            if v is None:
                conf.unset(k)
            else:
                conf.set(k, v)
