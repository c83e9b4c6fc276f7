"""Streaming flows."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillflow.operators.aggregates import group_stats_each
from tillflow.operators.filters import filter_key_present, filter_nonempty
from tillflow.operators.messages import (
    big_sale_alert,
    category_message,
    city_message,
    sale_message,
)
from tillflow.operators.parsing import (
    parse_json,
    parse_sale_strict,
    reject_envelope,
    render_event_json,
    render_json,
    split_parsed,
)
from tillflow.operators.projections import TEXT_TABLE_PROJECTION, project_cast, reject_counts
from tillflow.schemas import SALE_RAW
from tillflow.sinks.tables import is_file_table, stream_to_table, table_batches
from tillflow.sinks.topics import stream_to_topic
from tillflow.sources.topics import Topic, stream_topic
from tillflow.streaming.batches import BatchSink, fan_out, write_each_batch
from tillflow.streaming.progress import observed, one_row
from tillflow.streaming.running import RunningTotals, each_batch_of_rows


def relay(messages: DataFrame, schema: T.StructType = SALE_RAW) -> DataFrame:
    """Parse, keep what has a key, render again."""
    return render_json(filter_key_present(parse_json(messages, schema), schema.names[0]))


def relay_topic(
    spark: SparkSession,
    source: Topic,
    sink: Topic,
    checkpoint: str,
    schema: T.StructType = SALE_RAW,
    *,
    fail_on_data_loss: bool = False,
    trigger: dict | None = None,
    **reading,
) -> StreamingQuery:
    """Pass the valid sales of one topic on to another; ``reading`` goes to `stream_topic`."""
    messages = stream_topic(spark, source, fail_on_data_loss=fail_on_data_loss, **reading)
    return stream_to_topic(relay(messages, schema), sink, checkpoint, trigger)


def echo_topic(
    messages: DataFrame, fn: BatchSink, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Hand every non-empty message to ``fn`` as text."""
    text = messages.selectExpr("CAST(value AS STRING) AS value")
    return write_each_batch(filter_nonempty(text), fn, checkpoint, trigger)


def stream_topic_to_table(
    spark: SparkSession,
    source: Topic,
    table: str,
    checkpoint: str,
    *,
    trigger: dict | None = None,
    dedupe_key: str | None = None,
    sole_writer: bool = False,
    rejects: BatchSink | None = None,
    **reading,
) -> StreamingQuery:
    """Insert a topic's sales into the catalog table; ``reading`` goes to `stream_topic`.

    The numbers of the feed may be quoted or not, so they are parsed as text and cast.
    ``rejects`` gets one row a micro-batch: how many values of each column were no numbers
    and became NULL. They are counted while the rows pass, with no second read of the topic.
    In a file table the count is handed on before the batch is committed. Elsewhere it comes
    with the query's progress, after the commit, and a driver lost in between loses it.
    """
    sales = filter_key_present(parse_json(stream_topic(spark, source, **reading)))
    if rejects is None:
        rows = project_cast(sales, TEXT_TABLE_PROJECTION)
        return stream_to_table(
            rows, table, checkpoint, trigger, dedupe_key=dedupe_key, sole_writer=sole_writer
        )
    if sole_writer or not is_file_table(spark, table):
        counts = reject_counts(sales, TEXT_TABLE_PROJECTION)
        rows = project_cast(observed(sales, counts, rejects), TEXT_TABLE_PROJECTION)
        return stream_to_table(rows, table, checkpoint, trigger, sole_writer=sole_writer)
    insert = table_batches(table, dedupe_key)

    def write(batch: DataFrame, batch_id: int) -> None:
        if dedupe_key is not None:  # reads the batch several times
            batch.persist()
        try:
            counts = reject_counts(batch, TEXT_TABLE_PROJECTION)
            if dedupe_key is not None:
                found = batch.agg(*counts)
                insert(project_cast(batch, TEXT_TABLE_PROJECTION), batch_id)
            else:
                seen = Observation()
                insert(project_cast(batch.observe(seen, *counts), TEXT_TABLE_PROJECTION), batch_id)
                found = one_row(batch.sparkSession, seen.get)
            rejects(found, batch_id)
        finally:
            if dedupe_key is not None:
                batch.unpersist()

    return write_each_batch(sales, write, checkpoint, trigger)


def live_sales_metrics(
    messages: DataFrame,
    sinks: Mapping[str, BatchSink],
    checkpoint_root: str,
    *,
    threshold: float = 1000.0,
    per_record: bool = False,
    trigger: dict | None = None,
    sum_type: str = "double",
) -> list[StreamingQuery]:
    """Category and city turnover, alerts, clean messages and rejects of a live topic.

    ``sinks`` may name ``category``, ``city``, ``alerts``, ``events``, ``sales`` and
    ``rejects``. Parsing is strict. Turnover by category and city is one query on Spark's
    state, and the other branches share a second one, so the topic is read and parsed twice
    at most. Turnover reports changed keys once per micro-batch; with ``per_record`` it
    reports after every sale (needs ``partition`` and ``offset`` columns). A ``Total`` that
    ``sum_type`` cannot hold is a reject.
    """
    place = ("partition", "offset") if per_record else ()
    parsed = parse_sale_strict(filter_nonempty(messages), keep=place, total_type=sum_type)

    def branch(name: str, make: Callable[[DataFrame], DataFrame]) -> BatchSink:
        return lambda batch, batch_id: sinks[name](make(batch), batch_id)

    plain = {
        "alerts": lambda batch: big_sale_alert(split_parsed(batch)[0], threshold),
        "events": lambda batch: render_event_json(split_parsed(batch)[0]),
        "sales": lambda batch: sale_message(split_parsed(batch)[0]),
        "rejects": reject_envelope,
    }
    shared = {name: branch(name, make) for name, make in plain.items() if name in sinks}
    keyed = {"category": ("Categorie", category_message), "city": ("Ville", city_message)}
    keyed = {name: spec for name, spec in keyed.items() if name in sinks}
    queries = fan_out(parsed, shared, checkpoint_root, True, trigger) if shared else []
    if keyed:
        sales = split_parsed(parsed)[0]
        make = _per_record if per_record else _per_batch
        queries.append(make(sales, keyed, sinks, f"{checkpoint_root}/turnover", sum_type, trigger))
    return queries


def _report(stats: DataFrame, keyed, sinks: Mapping[str, BatchSink], batch_id: int) -> None:
    """Rows ``by, key, ...`` as messages, each to the sink of its key."""
    stats.persist()  # the state is advanced once, however many sinks read it
    try:
        for name, (column, text) in keyed.items():
            mine = stats.filter(F.col("by") == column).withColumnRenamed("key", column)
            sinks[name](text(mine, column), batch_id)
    finally:
        stats.unpersist()


def _per_batch(sales, keyed, sinks, checkpoint, sum_type, trigger) -> StreamingQuery:
    stats = group_stats_each(sales, [c for c, _ in keyed.values()], "Total", sum_type)
    return write_each_batch(
        stats, lambda batch, batch_id: _report(batch, keyed, sinks, batch_id), checkpoint, trigger, "update"
    )


def _per_record(sales, keyed, sinks, checkpoint, sum_type, trigger) -> StreamingQuery:
    keys = [F.struct(F.lit(c).alias("by"), F.col(c).alias("key")) for c, _ in keyed.values()]
    each = sales.select(F.inline(F.array(*keys)), "Total", "partition", "offset")
    totals = RunningTotals(each, ["by", "key"], "Total", ["partition", "offset"], sum_type=sum_type)
    return each_batch_of_rows(
        totals, lambda batch, batch_id: _report(batch, keyed, sinks, batch_id), checkpoint, trigger
    )
