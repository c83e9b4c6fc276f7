"""Message topics: Kafka, or a folder of Parquet files with the same columns.

The folder form serves tests and sites without a broker. Only this module and
``tillflow.sinks.topics`` know which of the two a topic is.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.operators.parsing import parse_json
from tillflow.operators.projections import TEXT_EVENT_PROJECTION, project_cast
from tillflow.schemas import ENVELOPE


#: By topic partition: the first offset, and the one after the last; None is the topic's own end.
Ranges = Mapping[int, tuple[int | None, int | None]]
# How Kafka names its own ends.
_EARLIEST, _LATEST = -2, -1


@dataclass(frozen=True)
class Topic:
    """A topic ``name`` at ``location``: bootstrap servers, or a folder."""

    name: str
    location: str
    format: str = "kafka"

    @classmethod
    def kafka(cls, name: str, servers: str) -> Topic:
        return cls(name, servers)

    @classmethod
    def files(cls, name: str, folder: str) -> Topic:
        return cls(name, folder, "files")


def kafka_read_options(
    topic: Topic,
    *,
    streaming: bool,
    fail_on_data_loss: bool = True,
    max_per_trigger: int | None = None,
    rows_per_task: int | None = None,
    group_id: str | None = None,
    ranges: Ranges | None = None,
) -> dict[str, str]:
    """Read from the earliest offset, up to the current end if not streaming.

    ``rows_per_task`` splits one busy topic partition over several Spark tasks. ``ranges``
    reads the partitions it names, between the offsets given.
    """
    options = {
        "kafka.bootstrap.servers": topic.location,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if ranges is None:
        options |= {"subscribe": topic.name, "startingOffsets": "earliest"}
        if not streaming:
            options["endingOffsets"] = "latest"
    else:
        _checked(ranges)

        def ends(side: int, default: int) -> str:
            given = {str(p): default if r[side] is None else r[side] for p, r in sorted(ranges.items())}
            return json.dumps({topic.name: given})

        options["assign"] = json.dumps({topic.name: sorted(ranges)})
        options["startingOffsets"] = ends(0, _EARLIEST)
        if not streaming:
            options["endingOffsets"] = ends(1, _LATEST)
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if rows_per_task is not None:
        options["maxRecordsPerPartition"] = str(rows_per_task)
    if group_id is not None:
        options["kafka.group.id"] = group_id
    return options


def read_topic(
    spark: SparkSession,
    topic: Topic,
    *,
    fail_on_data_loss: bool = True,
    rows_per_task: int | None = None,
    ranges: Ranges | None = None,
) -> DataFrame:
    """Bounded read: all messages present now, or those of ``ranges``.

    ``ranges`` names topic partitions and for each the first offset and the one after the
    last. `next_ranges` gives those that go on where a read ended. In a folder topic they are
    filters that reach the files, whose statistics rule out all others.
    """
    if topic.format == "kafka":
        options = kafka_read_options(
            topic,
            streaming=False,
            fail_on_data_loss=fail_on_data_loss,
            rows_per_task=rows_per_task,
            ranges=ranges,
        )
        return spark.read.format("kafka").options(**options).load()
    messages = _folder(spark.read, fail_on_data_loss).parquet(topic.location)
    return messages if ranges is None else messages.filter(_within(ranges))


def next_ranges(messages: DataFrame) -> dict[int, tuple[int, None]]:
    """Where a later read of the same topic goes on: one range a topic partition, open at its end.

    Partitions without messages are not named; begin those at None.
    """
    ends = messages.groupBy("partition").agg((F.max("offset") + 1).alias("end"))
    return {r.partition: (r.end, None) for r in ends.collect()}  # as many as the topic has partitions


def _checked(ranges: Ranges) -> None:
    if not ranges:
        raise ValueError("no topic partition is named")
    for partition, (first, end) in ranges.items():
        if min(v for v in (first, end, 0) if v is not None) < 0 or (None not in (first, end) and first > end):
            raise ValueError(f"partition {partition}: no offsets from {first} to {end}")


def _within(ranges: Ranges) -> Column:
    """Partitions with the same offsets share a term."""
    _checked(ranges)
    shared: dict[tuple[int | None, int | None], list[int]] = {}
    for partition, bounds in sorted(ranges.items()):
        shared.setdefault(tuple(bounds), []).append(partition)

    def term(bounds: tuple[int | None, int | None], partitions: list[int]) -> Column:
        first, end = bounds
        out = F.col("partition").isin(partitions) if len(partitions) > 1 else F.col("partition") == partitions[0]
        if first is not None:
            out &= F.col("offset") >= first
        return out if end is None else out & (F.col("offset") < end)

    return reduce(Column.__or__, [term(b, p) for b, p in shared.items()])


def stream_topic(
    spark: SparkSession,
    topic: Topic,
    *,
    fail_on_data_loss: bool = True,
    max_per_trigger: int | None = None,
    rows_per_task: int | None = None,
    group_id: str | None = None,
) -> DataFrame:
    """Unbounded read from the earliest message; a checkpoint resumes after the last one.

    ``fail_on_data_loss=False`` goes on when messages vanished or the topic was made
    anew. ``max_per_trigger`` bounds a micro-batch, in messages (Kafka) or files.
    """
    if topic.format == "kafka":
        options = kafka_read_options(
            topic,
            streaming=True,
            fail_on_data_loss=fail_on_data_loss,
            max_per_trigger=max_per_trigger,
            rows_per_task=rows_per_task,
            group_id=group_id,
        )
        return spark.readStream.format("kafka").options(**options).load()
    reader = _folder(spark.readStream, fail_on_data_loss)
    if max_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    return reader.parquet(topic.location)


def _folder(reader, fail_on_data_loss: bool):
    return (
        reader.schema(ENVELOPE)
        .option("recursiveFileLookup", True)
        .option("ignoreMissingFiles", not fail_on_data_loss)
    )


def topic_view(spark: SparkSession, topic: Topic, view: str, **options) -> DataFrame:
    """Declare a JSON topic as a streaming SQL view of the twelve typed columns.

    The feed quotes numbers or not, so they are parsed as text and cast; a bad one is NULL.
    """
    text = parse_json(stream_topic(spark, topic, **options))
    sales = project_cast(text, TEXT_EVENT_PROJECTION)
    sales.createOrReplaceTempView(view)
    return sales
