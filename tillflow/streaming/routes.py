"""One pass over a stream for several sinks.

Each row is copied to its sinks by a routing column, and one partitioned write puts every
sink's rows into its own folder. The source is read and parsed once, nothing is cached, and no
sink waits for another.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillflow.sinks.topics import BATCH_BITS, envelope, first_partition
from tillflow.sources.topics import Topic
from tillflow.streaming.batches import BatchSink, claim, write_each_batch, writer_id

# Columns that `routed_batches` adds before rows are copied.
_ROW, _BASE, _FIRST = "__route_row", "__route_base", "__route_first"
#: The routing column, and the batch's number.
SINK, BATCH = "sink", "batch_id"


@dataclass(frozen=True)
class Route:
    """What a sink takes of each row: columns by name, and the rows that ``where`` is true for."""

    columns: Mapping[str, Column]
    where: Column | None = None
    #: Its files are read by others, so its columns keep their names there.
    fixed: bool = False


def rows_route(df: DataFrame, where: Column | None = None) -> Route:
    """All columns as they are."""
    return Route({c: F.col(c) for c in df.columns}, where)


def topic_route(topic: str, value: Column, key: Column | None = None, where: Column | None = None) -> Route:
    """Messages with the columns of a topic; see `routed_topic`."""
    key = F.lit(None) if key is None else key
    columns = envelope(key, value, topic, F.col(_ROW), F.col(_BASE), F.col(_FIRST))
    return Route(columns, where, fixed=True)


def routed_topic(name: str, out: str, sink: str) -> Topic:
    """The folder topic that a `topic_route` named ``sink`` fills."""
    return Topic.files(name, f"{out}/{SINK}={sink}")


def routed_rows(spark: SparkSession, out: str, sink: str, route: Route) -> DataFrame:
    """What a sink has got so far."""
    rows = spark.read.parquet(f"{out}/{SINK}={sink}")
    own = {c: _own(c, sink) for c in route.columns}
    return rows.select(*[F.col(o if o in rows.columns else c).alias(c) for c, o in own.items()])


def _own(column: str, sink: str) -> str:
    return f"{column}__{sink}"


def copied(df: DataFrame, routes: Mapping[str, Route]) -> DataFrame:
    """A row for each row and sink that takes it; columns of other sinks are NULL.

    All sinks share the columns of the files. One whose type differs between two sinks is
    kept apart under a name of its own.
    """
    kinds: dict[str, T.DataType] = {}
    named: dict[str, dict[str, Column]] = {}
    for sink, route in sorted(routes.items(), key=lambda r: not r[1].fixed):
        shape = df.select(*[c.alias(k) for k, c in route.columns.items()]).schema
        if {SINK, BATCH} & set(shape.names):
            raise ValueError(f"columns {SINK} and {BATCH} say where a row goes")
        named[sink] = {}
        for field in shape:
            name = field.name
            if kinds.setdefault(name, field.dataType) != field.dataType:
                name = _own(name, sink)
                kinds[name] = field.dataType
            named[sink][name] = route.columns[field.name]

    def copy(sink: str, where: Column | None) -> Column:
        cells = [named[sink].get(c, F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()]
        row = F.struct(F.lit(sink).alias(SINK), *cells)
        return row if where is None else F.when(where, row)

    copies = F.array_compact(F.array(*[copy(n, r.where) for n, r in routes.items()]))
    return df.select(F.inline(copies))


def routed_batches(routes: Mapping[str, Route], out: str) -> BatchSink:
    """A micro-batch sink that fills ``out/sink=<name>/batch_id=<n>`` for every route.

    A retry replaces the folders of its batch. ``out`` belongs to the stream that wrote first.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id >> (63 - BATCH_BITS):
            raise ValueError(f"batch {batch_id}: offsets would pass 64 bits")
        claim(batch, out)
        marked = batch.withColumns(
            {
                _ROW: F.monotonically_increasing_id(),
                _BASE: F.lit(batch_id << BATCH_BITS).cast("bigint"),
                _FIRST: F.lit(first_partition(writer_id(batch))),
            }
        )
        rows = copied(marked, routes).withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        # a writer for each sink is open in a task, so rows need no sort
        conf = batch.sparkSession.conf
        before = conf.get("spark.sql.maxConcurrentOutputFileWriters")
        conf.set("spark.sql.maxConcurrentOutputFileWriters", str(len(routes)))
        try:
            writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(SINK, BATCH).parquet(out)
        finally:
            conf.set("spark.sql.maxConcurrentOutputFileWriters", before)

    return write


def fan_out_routed(
    df: DataFrame, routes: Mapping[str, Route], out: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Feed one stream to all routes in one pass."""
    return write_each_batch(df, routed_batches(routes, out), checkpoint, trigger)
