"""Starting queries, and sinks that take one micro-batch at a time.

A retried micro-batch has the same id and rows, so a sink that overwrites the
folder of its batch id has no duplicates. Batch ids start anew with each checkpoint;
`writer_id` tells the streams apart. ``trigger`` is the argument of
``DataStreamWriter.trigger``, such as ``{"availableNow": True}`` or
``{"processingTime": "10 seconds"}``; None starts each batch as the last one ends.
No operator sets a watermark.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

BatchSink = Callable[[DataFrame, int], object]


def start(
    writer: DataStreamWriter, checkpoint: str, trigger: dict | None = None, table: str | None = None
) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start() if table is None else writer.toTable(table)


def write_each_batch(
    df: DataFrame,
    fn: BatchSink,
    checkpoint: str,
    trigger: dict | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    """Call ``fn(batch, batch_id)`` for every micro-batch; committed batches do not come again."""
    return start(df.writeStream.outputMode(output_mode).foreachBatch(fn), checkpoint, trigger)


def writer_id(batch: DataFrame) -> str:
    """The id that Spark keeps in the checkpoint of the stream ``batch`` belongs to."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"


def parquet_batches(path: str) -> BatchSink:
    """A sink that keeps each micro-batch in its own ``batch_id=`` folder.

    ``path`` belongs to the stream that wrote it first. Another one, or the same flow
    with a new checkpoint, would overwrite its batches and is refused.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        claim(batch, path)
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def claim(batch: DataFrame, path: str) -> None:
    """Leave the writer's name in ``path``, unless another one's is there."""
    jvm = batch.sparkSession.sparkContext._jvm
    mine = f"_writer-{writer_id(batch)}"
    folder = jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(batch.sparkSession.sparkContext._jsc.hadoopConfiguration())
    names = []
    if store.exists(folder):
        names = [f.getPath().getName() for f in store.listStatus(folder)]
    others = [n for n in names if n.startswith("_writer-") and n != mine]
    if others:
        raise ValueError(f"{path} holds the batches of another stream ({others[0]})")
    if mine not in names:
        store.create(jvm.org.apache.hadoop.fs.Path(folder, mine)).close()


def latest_per_key(batches: DataFrame, key: str) -> DataFrame:
    """The newest row of each key of update-mode batches kept by `parquet_batches`."""
    rest = [c for c in batches.columns if c not in (key, "batch_id")]
    return batches.groupBy(key).agg(
        *[F.max_by(c, "batch_id").alias(c) for c in rest]
    )


def fan_out(
    df: DataFrame,
    sinks: Mapping[str, BatchSink],
    checkpoint_root: str,
    shared: bool = False,
    trigger: dict | None = None,
    output_mode: str = "append",
) -> list[StreamingQuery]:
    """Feed one stream to several sinks.

    By default every sink is its own query: it reads the source by itself and has its
    own progress. ``shared`` makes one query that reads and keeps each micro-batch
    once for all sinks; if one fails, the batch is tried again for all. Bound its
    micro-batches (``max_per_trigger``): a batch is kept whole while the sinks run.
    """
    if not shared:
        return [
            write_each_batch(df, sink, f"{checkpoint_root}/{name}", trigger, output_mode)
            for name, sink in sinks.items()
        ]

    def write_all(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # the first sink fills the cache; the others then run side by side
            first, *rest = sinks.values()
            first(batch, batch_id)
            with ThreadPoolExecutor(max(1, len(rest))) as pool:
                for done in [pool.submit(inherit(sink), batch, batch_id) for sink in rest]:
                    done.result()
        finally:
            batch.unpersist()

    def inherit(sink: BatchSink) -> BatchSink:
        return inheritable_thread_target(df.sparkSession)(sink)

    return [write_each_batch(df, write_all, f"{checkpoint_root}/shared", trigger, output_mode)]
