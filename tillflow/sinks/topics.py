"""Writers to message topics."""

from __future__ import annotations

import zlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillflow.sources.topics import Topic, read_topic
from tillflow.streaming.batches import start, writer_id

# monotonically_increasing_id() is the task number times 2**33 plus the row number.
_ROW_BITS = 33
# A stream numbers batch b from b * 2**33, with no look at what is there: 2**30 batches fit.
BATCH_BITS = 33
# A writer's partitions begin at a multiple of 2**16 that follows from its name.
TASK_BITS = 16
# Ranges for streams; range 0 is that of appended batches.
_RANGES = 0x7FFF
#: Options of a folder topic's files. Spark splits a file between row groups only: small ones let a
#: micro-batch of one file use many tasks.
ROW_GROUPS = {"parquet.block.size": 2 << 20}


def kafka_write_options(topic: Topic) -> dict[str, str]:
    return {"kafka.bootstrap.servers": topic.location, "topic": topic.name}


def write_topic(df: DataFrame, topic: Topic) -> None:
    """Append the ``value`` (and ``key``, if there is one) of each row to the topic."""
    if topic.format == "kafka":
        messages = df.select(*[c for c in ("key", "value") if c in df.columns])
        messages.write.format("kafka").options(**kafka_write_options(topic)).save()
        return
    messages = _envelopes(df, topic, F.lit(_next_offset(df, topic)))
    messages.write.mode("append").options(**ROW_GROUPS).parquet(f"{topic.location}/appended")


def stream_to_topic(
    df: DataFrame, topic: Topic, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Relay a stream of ``value`` rows. At least once: a retried batch may repeat in
    Kafka; in a folder topic it replaces its first attempt."""
    if topic.format == "kafka":
        messages = df.select(*[c for c in ("key", "value") if c in df.columns])
        writer = messages.writeStream.format("kafka").options(**kafka_write_options(topic))
        return start(writer, checkpoint, trigger)
    return start(df.writeStream.foreachBatch(topic_batches(topic)), checkpoint, trigger)


def topic_batches(topic: Topic):
    """A ``foreachBatch`` sink that appends each micro-batch to the topic.

    In a folder topic every stream writes into a folder of its own, named by the id in
    its checkpoint, and overwrites nothing but its own batch. It takes a range of topic
    partitions that no other stream has.
    """
    ranges: dict[str, int] = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        if topic.format == "kafka":
            write_topic(batch, topic)
            return
        if batch_id >> (63 - BATCH_BITS):
            raise ValueError(f"batch {batch_id}: offsets would pass 64 bits")
        writer = writer_id(batch)
        base = F.lit(batch_id << BATCH_BITS).cast("bigint")
        if writer not in ranges:
            ranges[writer] = _own_range(batch.sparkSession, topic, writer)
        _envelopes(batch, topic, base, ranges[writer]).write.mode("overwrite").options(**ROW_GROUPS).parquet(
            f"{topic.location}/writer={writer}/batch={batch_id}"
        )

    return write


def first_partition(writer: str) -> int:
    """Where the topic partitions of a stream begin, if it is the only one."""
    return (zlib.crc32(writer.encode()) % _RANGES + 1) << TASK_BITS


def _own_range(spark: SparkSession, topic: Topic, writer: str) -> int:
    """Where the topic partitions of a stream begin among others.

    Files beside the messages say who has which range. The first to create the file of a
    range has it; a stream that is not listed yet tries the range of its name and then the
    next ones. A range whose owner was lost before it was listed stays unused.
    """
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{topic.location}/_writers")
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(folder)
    names = [f.getPath().getName() for f in store.listStatus(folder)]
    for name in names:
        number, _, owner = name.partition("=")
        if owner == writer:
            return int(number) << TASK_BITS
    first = first_partition(writer) >> TASK_BITS
    for step in range(_RANGES):
        number = (first - 1 + step) % _RANGES + 1
        if store.createNewFile(jvm.org.apache.hadoop.fs.Path(folder, str(number))):
            store.createNewFile(jvm.org.apache.hadoop.fs.Path(folder, f"{number}={writer}"))
            return number << TASK_BITS
    raise ValueError(f"{topic.location} has no range of partitions left for another stream")


def envelope(
    key: Column, value: Column, topic: str, row: Column, base: Column, first: Column
) -> dict[str, Column]:
    """The columns of a topic. Topic partition = ``first`` + Spark task, offset = ``base`` + row
    within it, both from ``row``, a `monotonically_increasing_id`: no shuffle to number rows."""
    return {
        "key": key.cast("string").cast("binary"),
        "value": value.cast("string").cast("binary"),
        "topic": F.lit(topic),
        "partition": F.shiftright(row, _ROW_BITS).cast("int") + first,
        "offset": (base + row.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))).cast("bigint"),
        "timestamp": F.current_timestamp(),
    }


def _envelopes(df: DataFrame, topic: Topic, base: Column, first: int = 0) -> DataFrame:
    key = F.col("key") if "key" in df.columns else F.lit(None)
    row = F.monotonically_increasing_id()
    columns = envelope(key, F.col("value"), topic.name, row, base, F.lit(first))
    return df.select(*[c.alias(n) for n, c in columns.items()])


def _next_offset(df: DataFrame, topic: Topic) -> int:
    try:
        known = read_topic(df.sparkSession, topic)
        return known.agg(F.coalesce(F.max("offset") + 1, F.lit(0))).first()[0]
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return 0
        raise
