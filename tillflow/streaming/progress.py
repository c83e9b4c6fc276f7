"""Figures taken from a stream while its rows pass."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from tillflow.streaming.batches import BatchSink


def one_row(spark: SparkSession, figures: Mapping[str, int]) -> DataFrame:
    """Counts as a relation of one row."""
    kinds = ", ".join(f"`{name}` bigint" for name in figures)
    return spark.createDataFrame([tuple(figures.values())], kinds)


class _Reports(StreamingQueryListener):
    """Hands the figures of one observation to a sink, batch by batch."""

    def __init__(self, spark: SparkSession, name: str, sink: BatchSink):
        self.spark, self.name, self.sink = spark, name, sink
        self.run: str | None = None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        figures = event.progress.observedMetrics.get(self.name)
        if figures is not None:
            self.run = str(event.progress.runId)
            self.sink(one_row(self.spark, figures.asDict()), event.progress.batchId)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if self.run == str(event.runId):
            self.spark.streams.removeListener(self)


def observed(df: DataFrame, figures: Sequence[Column], sink: BatchSink) -> DataFrame:
    """``df``, a stream, whose ``figures`` go to ``sink`` as one row after every micro-batch.

    Nothing is read or computed twice: the figures travel with the query's progress. They come
    after the batch is committed, on the listener's thread. A sink that overwrites by batch id
    is safe to call again.
    """
    name = f"figures-{uuid.uuid4().hex}"
    df.sparkSession.streams.addListener(_Reports(df.sparkSession, name, sink))
    return df.observe(name, *figures)
