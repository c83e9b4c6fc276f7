"""Queries over the driver tables, each beside the SQL that gives the same rows.

Sales are bound to ``events`` where identity, order or a stream matters and to
``lineitem`` for plain aggregates. Whole tables are read everywhere.
"""

from __future__ import annotations

import os
import sys
import time
from collections.abc import Callable
from datetime import datetime
from functools import reduce
from itertools import pairwise

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillflow.functions.casts import DECIMAL, ISO_DATE, WHOLE
from tillflow.operators import aggregates, filters, messages, parsing, projections
from tillflow.operators.exact import EXACT
from tillflow.operators.running import running_stats
from tillflow.plans import batch, streams
from tillflow.schemas import (
    SALE_CSV_PRICED,
    SALE_EVENT,
    SALE_FIELDS,
    SALE_POSITIONAL,
    SALE_TABLE,
    TEST_ROWS,
    TEST_TABLE,
)
from tillflow.session import scratch_dir
from tillflow.sinks import files as file_sinks
from tillflow.sinks import tables as table_sinks
from tillflow.sinks import topics as topic_sinks
from tillflow.sinks.keys import build_key_index
from tillflow.sources import files as file_sources
from tillflow.sources import tables as catalog
from tillflow.sources.topics import Topic, next_ranges, read_topic, stream_topic, topic_view
from tillflow.streaming.batches import (
    fan_out,
    latest_per_key,
    parquet_batches,
    write_each_batch,
)
from tillflow.streaming.routes import (
    fan_out_routed,
    routed_rows,
    routed_topic,
    rows_route,
    topic_route,
)
from tillflow.streaming.running import running_stats_stream

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}

MONEY = "decimal(18,2)"
NOW = {"availableNow": True}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        _QUERIES[fn.__name__] = fn
        if sql is not None:
            _ORACLES[fn.__name__] = sql
        return fn

    return register


def _training_data() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries of the ``llm`` subpackage and of ``corpus_pipeline``, and their SQL, where these exist."""
    try:
        from tillflow.llm import queries as operators
    except ModuleNotFoundError as missing:
        if missing.name not in ("tillflow.llm", "tillflow.llm.queries"):
            raise
        return {}, {}
    found, sql = dict(operators.QUERIES), dict(operators.ORACLES)
    try:
        import corpus_pipeline
    except ModuleNotFoundError as missing:
        if missing.name != "corpus_pipeline":
            raise
    else:
        found["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL is not None:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Query]:
    return _QUERIES | _training_data()[0]


def oracle_sql() -> dict[str, str]:
    return _ORACLES | _training_data()[1]


def entry(spark: SparkSession) -> DataFrame:
    """Turnover per category of dirty sales text, at sf0.001."""
    raw = sales(table(spark, "/root/testdata/sf0.001", "events"))
    clean = projections.clean_cast(projections.rename_by_name(raw))
    return in_money(aggregates.group_stats(clean, "Categorie", "total", MONEY))


# --- bindings of the driver tables ------------------------------------------


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


STEPS, FILES = 3, 2


def in_steps(events: DataFrame) -> list[DataFrame]:
    """``events`` in three parts, by ``event_id`` in ascending order."""
    marks = events.agg(F.percentile_approx("event_id", [1 / 3, 2 / 3], 10_000)).first()[0]
    low, high = marks or (0, 0)
    part = F.when(F.col("event_id") <= low, 0).when(F.col("event_id") <= high, 1).otherwise(2)
    return [events.filter(part == i) for i in range(STEPS)]


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """``events`` as a stream of three micro-batches: appended in three steps, read a step at a time."""
    events, folder = table(spark, sf, "events"), scratch_dir(spark, "events")
    for part in in_steps(events):
        part.repartition(FILES).write.mode("append").parquet(folder)
    return (
        spark.readStream.schema(events.schema).option("maxFilesPerTrigger", FILES).parquet(folder)
    )


def _k() -> Column:
    return F.get_json_object("props", "$.k")


def sale_columns() -> list[Column]:
    """The twelve text columns of a sale, from the columns of ``events``."""
    kind = F.col("event_type")
    value = F.col("value").cast("string")
    fields = [
        F.col("event_id").cast("string"),
        F.date_format("ts", "yyyy-MM-dd"),
        F.concat(F.lit("Produit "), _k()),
        kind,
        _k(),
        value,
        F.concat(F.lit("Client "), "user_id"),
        F.concat(F.lit("Ville "), "user_id"),
        F.lit("France"),
        F.lit("0.05"),
        F.when(kind == "purchase", "Chèque").when(kind == "click", "Espèces").otherwise("CB"),
        value,
    ]
    return [f.alias(n) for f, n in zip(fields, SALE_FIELDS, strict=True)]


def sales(events: DataFrame) -> DataFrame:
    return events.select(*sale_columns())


def typed_sales(events: DataFrame) -> DataFrame:
    """Events as parsed sales."""
    text = projections.rename_by_position(sales(events), SALE_EVENT.names)
    return text.select(*[F.col(f.name).cast(f.dataType) for f in SALE_EVENT])


def sale_messages(events: DataFrame) -> DataFrame:
    """Events as JSON messages in ``value``, in every shape the feed knows.

    By event type: all text; numbers unquoted; a quote inside a name; a missing
    field; no JSON at all. ``event_id`` is the offset.
    """
    kind = F.col("event_type")

    def message(drop: str = "", **change: Column) -> Column:
        cols = {n: F.col(n) for n in SALE_FIELDS if n != drop} | change
        return F.to_json(F.struct(*[c.alias(n) for n, c in cols.items()]))

    numbers = {
        n: F.col(n).cast("int" if n == "Quantité" else "double")
        for n in ("Quantité", "PrixUnitaire", "Remise", "Total")
    }
    text = (
        F.when(kind == "click", message())
        .when(kind == "view", message(**numbers))
        .when(kind == "purchase", message(Produit=F.concat(F.lit('"'), "Produit", F.lit('"'))))
        .when(kind == "signup", message(drop="Pays"))
        .otherwise(F.concat(F.lit("not json "), "IDVente"))
    )
    return events.select("event_id", "event_type", *sale_columns()).select(
        text.alias("value"), F.lit(0).alias("partition"), F.col("event_id").alias("offset")
    )


# The same bindings in SQL.
SALES = """
SELECT event_id, event_type, event_id::VARCHAR AS "IDVente",
  strftime(ts, '%Y-%m-%d') AS "DateVente", 'Produit ' || k AS "Produit",
  event_type AS "Categorie", k AS "Quantité", value::VARCHAR AS "PrixUnitaire",
  'Client ' || user_id AS "Client", 'Ville ' || user_id AS "Ville", 'France' AS "Pays",
  '0.05' AS "Remise", CASE event_type WHEN 'purchase' THEN 'Chèque' WHEN 'click' THEN 'Espèces'
  ELSE 'CB' END AS "MoyenPaiement", value::VARCHAR AS "Total"
FROM (SELECT *, json_extract_string(props, '$.k') AS k FROM events)
"""
# What a lenient parse of sale_messages keeps, still as text.
LENIENT = f"""
SELECT "IDVente", "DateVente", "Categorie", "Quantité", "PrixUnitaire", "Client", "Ville",
  "Remise", "MoyenPaiement", "Total",
  CASE event_type WHEN 'purchase' THEN '"' || "Produit" || '"' ELSE "Produit" END AS "Produit",
  CASE event_type WHEN 'signup' THEN NULL ELSE "Pays" END AS "Pays"
FROM ({SALES}) WHERE event_type <> 'error'
"""
# What a strict parse keeps, typed.
STRICT = f"""
SELECT "IDVente", "DateVente", "Produit", "Categorie", "Quantité"::INTEGER AS "Quantite",
  "PrixUnitaire"::DOUBLE AS "PrixUnitaire", "Client", "Ville", "Pays",
  "Remise"::DOUBLE AS "Remise", "MoyenPaiement", "Total"::DOUBLE AS "Total"
FROM ({LENIENT}) WHERE "Pays" IS NOT NULL
"""
SALE_TABLE_SQL = """
SELECT "IDVente"::BIGINT AS id, "Produit" AS produit, "PrixUnitaire"::DOUBLE AS "prixUnitaire",
  "Quantité"::INTEGER AS quantite, "Total"::DOUBLE AS total, "Remise"::DOUBLE AS remise,
  "Ville" AS ville, "Client" AS client, "MoyenPaiement" AS "moyenPaiement",
  "DateVente"::DATE AS "dateVente"
"""


def _packed(fields: dict[str, str]) -> str:
    return "to_json({" + ", ".join(f"'{n}': {e}" for n, e in fields.items()) + "})::VARCHAR"


def _text2(number: str) -> str:
    """Two decimals, half up on the shortest decimal text of a double."""
    return f"round(({number})::VARCHAR::DECIMAL(38,18), 2)::DECIMAL(18,2)::VARCHAR"


def in_money(stats: DataFrame) -> DataFrame:
    """Exact decimal totals as double, the same on every engine."""
    return stats.withColumn("total", F.col("total").cast("double"))


def new_table(spark: SparkSession, schema, committed: bool = False) -> str:
    """An empty Parquet table with a name and folder of its own."""
    folder = scratch_dir(spark, "table")
    name = folder.rpartition("/")[2].replace("-", "_")
    catalog.create_table(spark, name, schema, location=folder, committed=committed)
    return name


def forget_commit(spark: SparkSession, checkpoint: str) -> None:
    """Leave a checkpoint as a driver does that is lost just before its last commit."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in store.listStatus(folder)]
    last = max(int(n) for n in names if n.isdigit())
    store.delete(jvm.org.apache.hadoop.fs.Path(folder, str(last)), False)


def message_topic(spark: SparkSession, sf: str, name: str = "sales_in") -> Topic:
    """A folder topic that holds all of ``sale_messages``."""
    topic = Topic.files(name, scratch_dir(spark, name))
    for part in in_steps(table(spark, sf, "events")):
        topic_sinks.write_topic(sale_messages(part).select("value"), topic)
    return topic


def ordered_topic(spark: SparkSession, sf: str) -> Topic:
    """A folder topic of one partition, whose offset is ``event_id``, written in three steps."""
    topic = Topic.files("sales_in", scratch_dir(spark, "sales_in"))
    for part in in_steps(table(spark, sf, "events")):
        rows = sale_messages(part).select(
            F.lit(None).cast("binary").alias("key"),
            F.col("value").cast("binary").alias("value"),
            F.lit(topic.name).alias("topic"),
            "partition",
            "offset",
            F.current_timestamp().alias("timestamp"),
        )
        rows.repartition(FILES).write.mode("append").options(**topic_sinks.ROW_GROUPS).parquet(topic.location)
    return topic


def finish(*running: StreamingQuery) -> None:
    for q in running:
        q.awaitTermination()


# --- aggregates --------------------------------------------------------------


@query("""
SELECT l_returnflag, count(*) AS n, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS total,
  sum(l_extendedprice::DECIMAL(18,2))::DOUBLE / count(*) AS mean
FROM lineitem GROUP BY 1
""")
def category_stats(spark, sf):
    return in_money(
        aggregates.group_stats(
            table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice", MONEY
        )
    )


@query("""
SELECT l_returnflag, count(*) AS n,
  round((sum((l_extendedprice * 1099511627776)::HUGEINT)::DOUBLE / 1099511627776), 6) AS total
FROM lineitem GROUP BY 1
""")
def category_stats_exact(spark, sf):
    """Totals of doubles that no order of addition changes; SQL adds whole multiples of 2**-40."""
    stats = aggregates.group_stats(
        table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice", EXACT
    )
    return stats.select("l_returnflag", "n", F.round("total", 6).alias("total"))


@query("""
SELECT l_suppkey, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY 1
""")
def city_totals(spark, sf):
    totals = aggregates.group_totals(table(spark, sf, "lineitem"), "l_suppkey", "l_extendedprice")
    return totals.select("l_suppkey", F.round("total", 2).alias("total"))


@query("""
SELECT l_suppkey, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS total
FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5
""")
def top_cities(spark, sf):
    totals = aggregates.group_totals(
        table(spark, sf, "lineitem"), "l_suppkey", "l_extendedprice", MONEY
    )
    return in_money(aggregates.top_k(totals, "l_suppkey"))


@query("SELECT count(*) AS n FROM lineitem")
def row_count(spark, sf):
    return aggregates.row_count(table(spark, sf, "lineitem"))


@query("SELECT event_id, event_type, value FROM events ORDER BY event_id LIMIT 5")
def limit_rows(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    return aggregates.limit_rows(events, "event_id")


RUNNING = """
SELECT event_id, {key}, count(*) OVER w AS n, (sum({value}) OVER w)::DOUBLE AS total,
  (sum({value}) OVER w)::DOUBLE / count(*) OVER w AS mean
FROM events
WINDOW w AS (PARTITION BY {key} ORDER BY event_id ROWS UNBOUNDED PRECEDING)
"""


def _running(spark, sf, key):
    events = table(spark, sf, "events").select("event_id", key, "value")
    rows = running_stats(events, key, "value", "event_id", sum_type=MONEY)
    return in_money(rows).drop("value")


@query(RUNNING.format(key="event_type", value="value::DECIMAL(18,2)"))
def category_stats_running(spark, sf):
    return _running(spark, sf, "event_type")


@query(RUNNING.format(key="user_id", value="value::DECIMAL(18,2)"))
def city_totals_running(spark, sf):
    return _running(spark, sf, "user_id")


# --- filters -----------------------------------------------------------------


@query("SELECT event_id, value FROM events WHERE value > 100")
def filter_threshold(spark, sf):
    events = table(spark, sf, "events").select("event_id", "value")
    return filters.filter_threshold(events, "value", 100.0)


@query("""
SELECT event_id, CASE WHEN event_type <> 'error' THEN event_id::VARCHAR END AS key
FROM events WHERE event_type <> 'error'
""")
def filter_key_present(spark, sf):
    key = F.when(F.col("event_type") != "error", F.col("event_id").cast("string"))
    events = table(spark, sf, "events").select("event_id", key.alias("key"))
    return filters.filter_key_present(events, "key")


@query("""
SELECT event_id, event_id::VARCHAR AS _c0 FROM events
WHERE event_type NOT IN ('view', 'error')
""")
def filter_header_row(spark, sf):
    kind = F.col("event_type")
    first = F.when(kind == "view", "IDVente").when(
        kind != "error", F.col("event_id").cast("string")
    )
    events = table(spark, sf, "events").select("event_id", first.alias("_c0"))
    return filters.filter_header_row(events)


@query("""
SELECT event_id, props AS value FROM events WHERE event_type NOT IN ('view', 'error')
""")
def filter_nonempty(spark, sf):
    kind = F.col("event_type")
    text = F.when(kind == "view", "").when(kind != "error", F.col("props"))
    return filters.filter_nonempty(
        table(spark, sf, "events").select("event_id", text.alias("value"))
    )


# --- projections and casts ---------------------------------------------------


@query("SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def project_columns(spark, sf):
    return projections.project_columns(
        table(spark, sf, "orders"), ["o_orderkey", "o_totalprice", "o_orderpriority"]
    )


@query("""
SELECT o_orderkey AS id, o_custkey AS client, o_orderstatus, o_totalprice AS total,
  o_orderdate AS "dateVente", o_orderpriority FROM orders
""")
def rename_by_name(spark, sf):
    return projections.rename_by_name(
        table(spark, sf, "orders"),
        {
            "o_orderkey": "id",
            "o_custkey": "client",
            "o_totalprice": "total",
            "o_orderdate": "dateVente",
            "absent": "ignored",
        },
    )


@query("""
SELECT o_orderkey AS c0, o_custkey AS c1, o_orderstatus AS c2, o_totalprice AS c3,
  o_orderdate AS c4, o_orderpriority AS c5 FROM orders
""")
def rename_by_position(spark, sf):
    return projections.rename_by_position(
        table(spark, sf, "orders"), [f"c{i}" for i in range(6)]
    )


@query("""
SELECT event_id, user_id, value FROM events WHERE event_type <> 'error'
UNION ALL SELECT NULL, NULL, NULL FROM events WHERE event_type = 'error'
""")
def expand_struct(spark, sf):
    data = F.when(F.col("event_type") != "error", F.struct("event_id", "user_id", "value"))
    return projections.expand_struct(table(spark, sf, "events").select(data.alias("data")))


TOKENS = """
SELECT event_id, CASE event_type WHEN 'click' THEN value::VARCHAR WHEN 'view' THEN '-' || value
  WHEN 'error' THEN value || 'e1' WHEN 'signup' THEN event_id::VARCHAR
  ELSE ' ' || event_id END AS token FROM events
"""


@query(f"""
SELECT event_id, CASE WHEN regexp_matches(token, '^\\d+$') THEN try_cast(token AS BIGINT) END
  AS whole, CASE WHEN regexp_matches(token, '^\\d+$') THEN try_cast(token AS INTEGER) END
  AS small, CASE WHEN regexp_matches(token, '^\\d*\\.?\\d+$') THEN try_cast(token AS DOUBLE) END
  AS amount FROM ({TOKENS})
""")
def clean_cast(spark, sf):
    kind, value = F.col("event_type"), F.col("value").cast("string")
    number = F.col("event_id").cast("string")
    token = (
        F.when(kind == "click", value)
        .when(kind == "view", F.concat(F.lit("-"), value))
        .when(kind == "error", F.concat(value, F.lit("e1")))
        .when(kind == "signup", number)
        .otherwise(F.concat(F.lit(" "), number))
    )
    rules = {"whole": (WHOLE, "bigint"), "small": (WHOLE, "int"), "amount": (DECIMAL, "double")}
    texts = table(spark, sf, "events").select("event_id", *[token.alias(c) for c in rules])
    return projections.clean_cast(texts, rules)


@query("""
SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN ts::DATE END AS day FROM events
""")
def clean_cast_date(spark, sf):
    kind, day = F.col("event_type"), F.date_format("ts", "yyyy-MM-dd")
    token = (
        F.when(kind.isin("click", "view"), day)
        .when(kind == "error", F.concat(F.substring(day, 1, 4), F.lit("-13-45")))
        .when(kind == "signup", F.concat(F.substring(day, 1, 4), F.lit("-02-30")))
        .otherwise(F.date_format("ts", "yyyy/MM/dd"))
    )
    texts = table(spark, sf, "events").select("event_id", token.alias("day"))
    return projections.clean_cast(texts, {"day": (ISO_DATE, "date")})


@query(f"{SALE_TABLE_SQL} FROM ({SALES})")
def clean_sales(spark, sf):
    return batch.clean_sales(sales(table(spark, sf, "events")))


CAST_SPEC = {
    "id": ("IDVente", "bigint"),
    "produit": ("Produit", None),
    "k": ("Produit", "int"),
    "dateVente": ("DateVente", "date"),
}


@query(f"""
SELECT "IDVente"::BIGINT AS id, "Produit" AS produit, NULL::INTEGER AS k,
  "DateVente"::DATE AS "dateVente" FROM ({SALES})
""")
def project_cast_alias(spark, sf):
    return projections.project_cast(sales(table(spark, sf, "events")), CAST_SPEC)


@query("""
SELECT 0::BIGINT AS id, count(*) AS k, 0::BIGINT AS "dateVente" FROM events
""")
def cast_rejects(spark, sf):
    return projections.cast_rejects(sales(table(spark, sf, "events")), CAST_SPEC)


# --- messages ----------------------------------------------------------------


def _category_sql(source: str) -> str:
    return f"""
SELECT '📊 ' || c || ': ' || n || ' ventes, CA: ' || {_text2('total')} || '€, Moyenne: '
  || {_text2('total / n')} || '€' AS message FROM ({source})
"""


def _city_sql(source: str) -> str:
    return f"SELECT '🏙️  ' || c || ': ' || {_text2('total')} || '€' AS message FROM ({source})"


@query(_category_sql("""
SELECT event_type AS c, count(*) AS n, sum(value::DECIMAL(18,2))::DOUBLE AS total
FROM events GROUP BY 1
"""))
def category_message(spark, sf):
    stats = aggregates.group_stats(table(spark, sf, "events"), "event_type", "value", MONEY)
    return messages.category_message(stats, "event_type")


@query(_city_sql("""
SELECT l_suppkey AS c, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS total
FROM lineitem GROUP BY 1
"""))
def city_message(spark, sf):
    totals = aggregates.group_totals(
        table(spark, sf, "lineitem"), "l_suppkey", "l_extendedprice", MONEY
    )
    return messages.city_message(totals, "l_suppkey")


ALERTS = """
SELECT '🚨 GROSSE VENTE! ' || "Produit" || ' - ' || "Total"::DOUBLE || '€ - ' || "Client"
  AS message FROM ({}) WHERE "Total"::DOUBLE > 100
"""
LINES = """
SELECT '✅ Vente ' || "IDVente" || ': ' || "Produit" || ' - ' || "Total"::DOUBLE || '€ - '
  || "Client" AS message FROM ({})
"""


@query(ALERTS.format(SALES))
def big_sale_alert(spark, sf):
    return messages.big_sale_alert(typed_sales(table(spark, sf, "events")), 100.0)


@query(LINES.format(SALES))
def sale_message(spark, sf):
    return messages.sale_message(typed_sales(table(spark, sf, "events")))


# --- JSON --------------------------------------------------------------------


@query("SELECT json_extract_string(props, '$.k') AS k FROM events")
def parse_props(spark, sf):
    return parsing.parse_json(table(spark, sf, "events"), "k string", "props")


@query(LENIENT)
def parse_sale_lenient(spark, sf):
    parsed = parsing.parse_json(sale_messages(table(spark, sf, "events")))
    return filters.filter_key_present(parsed)


@query(f"""
SELECT {', '.join(f'"{n}"' for n in SALE_FIELDS)} FROM ({SALES})
""")
def parse_sale_positional(spark, sf):
    text = projections.rename_by_position(
        sales(table(spark, sf, "events")), SALE_POSITIONAL.names
    )
    parsed = parsing.parse_json(parsing.render_json(text), SALE_POSITIONAL)
    return projections.rename_by_position(filters.filter_header_row(parsed))


@query(STRICT)
def parse_sale_strict(spark, sf):
    parsed = parsing.parse_sale_strict(sale_messages(table(spark, sf, "events")))
    return parsing.split_parsed(parsed)[0]


@query(f"""
SELECT event_id AS "offset", CASE event_type WHEN 'signup' THEN 'missing field Pays'
  WHEN 'error' THEN 'malformed JSON' END AS reason,
  event_type NOT IN ('signup', 'error') AS ok FROM ({SALES})
""")
def filter_parsed(spark, sf):
    parsed = parsing.parse_sale_strict(
        sale_messages(table(spark, sf, "events")), keep=["offset"]
    )
    return parsed.select("offset", "reason", "ok")


_SHORT = _packed({n: f'"{n}"' for n in SALE_FIELDS if n != "Pays"})


REJECTS = f"""
SELECT to_json({{'error': 'Parse error', 'message': reason, 'raw': raw}})::VARCHAR AS value
FROM (SELECT CASE event_type WHEN 'signup' THEN 'missing field Pays' ELSE 'malformed JSON' END
  AS reason, CASE event_type WHEN 'signup' THEN {_SHORT} ELSE 'not json ' || event_id END AS raw
  FROM ({SALES}) WHERE event_type IN ('signup', 'error'))
"""


@query(REJECTS)
def reject_envelope(spark, sf):
    parsed = parsing.parse_sale_strict(sale_messages(table(spark, sf, "events")))
    return parsing.reject_envelope(parsing.split_parsed(parsed)[1])


@query("""
SELECT to_json({'event_id': event_id, 'user_id': user_id, 'event_type': event_type,
  'value': value, 'props': props})::VARCHAR AS value FROM events
""")
def render_sale_json(spark, sf):
    return parsing.render_json(
        table(spark, sf, "events"), ["event_id", "user_id", "event_type", "value", "props"]
    )


EVENT_JSON = f"""
SELECT {_packed({n: '"Quantite"' if n == 'Quantité' else f'"{n}"' for n in SALE_FIELDS})}
  AS value FROM ({STRICT})
"""


@query(EVENT_JSON)
def render_event_json(spark, sf):
    parsed = parsing.parse_sale_strict(sale_messages(table(spark, sf, "events")))
    return parsing.render_event_json(parsing.split_parsed(parsed)[0])


@query("SELECT event_id::VARCHAR AS event_id, value::VARCHAR AS value, props FROM events")
def json_roundtrip(spark, sf):
    events = table(spark, sf, "events").select("event_id", "value", "props")
    schema = "event_id string, value string, props string"
    parsed = parsing.parse_json(parsing.render_json(events), schema)
    return filters.filter_key_present(parsed, "event_id")


# --- files -------------------------------------------------------------------


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def csv_roundtrip_typed(spark, sf):
    events = table(spark, sf, "events")
    path = file_sinks.write_csv(events, scratch_dir(spark, "csv"))
    return file_sources.read_csv_typed(spark, path, events.schema)


@query("""
SELECT event_id::VARCHAR AS event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts,
  user_id::VARCHAR AS user_id, event_type, value::VARCHAR AS value, props FROM events
""")
def csv_roundtrip_raw(spark, sf):
    path = file_sinks.write_csv(table(spark, sf, "events"), scratch_dir(spark, "csv"))
    return file_sources.read_csv_raw(spark, path)


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def parquet_roundtrip(spark, sf):
    path = file_sinks.write_parquet(
        table(spark, sf, "events"), scratch_dir(spark, "parquet"), snapshot=1
    )
    return file_sources.read_parquet(spark, path)


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def sink_parquet_compact(spark, sf):
    path = file_sinks.write_parquet(
        table(spark, sf, "events"), scratch_dir(spark, "compact"), compact=True
    )
    return file_sources.read_parquet(spark, path)


@query("""
SELECT count(*) AS rows_written, count(*) AS rows_read, TRUE AS schema_equal, TRUE AS content_equal
FROM events
""")
def readback_check(spark, sf):
    return file_sinks.readback_check(
        spark, table(spark, sf, "events"), scratch_dir(spark, "checked")
    )


@query("""
SELECT event_id::VARCHAR AS event_id, event_type, TRUE AS first, FALSE AS again FROM events
""")
def sink_csv_if_absent(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type")
    path = scratch_dir(spark, "absent")
    first = file_sinks.write_csv_if_absent(events, path)
    again = file_sinks.write_csv_if_absent(events, path)
    return file_sources.read_csv_raw(spark, path).select(
        "*", F.lit(first).alias("first"), F.lit(again).alias("again")
    )


@query("SELECT FALSE AS before, TRUE AS after, count(*) AS n FROM events")
def path_has_data(spark, sf):
    path = scratch_dir(spark, "csv")
    before = file_sources.path_has_data(spark, path)
    file_sinks.write_csv(table(spark, sf, "events"), path)
    after = file_sources.path_has_data(spark, path)
    return aggregates.row_count(file_sources.read_csv_raw(spark, path)).select(
        F.lit(before).alias("before"), F.lit(after).alias("after"), "n"
    )


PARTS = 8


def _inbox(spark: SparkSession, sf: str) -> str:
    """A folder of CSV drops: a part of the sales, then all of them in eight files, then a drop
    whose writer is not done."""
    events = table(spark, sf, "events")
    inbox = scratch_dir(spark, "inbox")
    some, *_ = in_steps(events)
    file_sinks.write_csv(sales(some), f"{inbox}/early")
    file_sinks.write_csv(sales(events).repartition(PARTS), f"{inbox}/sales")
    file_sinks.write_csv(sales(some), f"{inbox}/unfinished")
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{inbox}/unfinished/_SUCCESS")
    marker.getFileSystem(spark._jsc.hadoopConfiguration()).delete(marker, False)
    return inbox


@query(f"SELECT {', '.join(f'\"{n}\"' for n in SALE_FIELDS)}, {PARTS} AS files FROM ({SALES})")
def latest_file(spark, sf):
    newest = file_sources.latest_drop(spark, _inbox(spark, sf))
    rows = file_sources.read_csv_raw(spark, newest.files)
    return rows.withColumn("files", F.lit(len(newest.files)))


@query(f"""
SELECT * EXCLUDE ("Quantité", "PrixUnitaire", "Remise", "Total"), "Quantité"::INTEGER AS "Quantite",
  "PrixUnitaire"::DOUBLE AS "PrixUnitaire", "Remise"::DOUBLE AS "Remise", "Total"::DOUBLE AS "Total"
FROM (SELECT {', '.join(f'"{n}"' for n in SALE_FIELDS)} FROM ({SALES}))
""")
def ingest_latest_file(spark, sf):
    topic = Topic.files("sales_in", scratch_dir(spark, "sales_in"))
    batch.ingest_latest_file(spark, _inbox(spark, sf), topic, SALE_CSV_PRICED)
    parsed = parsing.parse_sale_strict(read_topic(spark, topic))
    return parsing.split_parsed(parsed)[0]


# --- tables ------------------------------------------------------------------


@query("""
SELECT event_id AS id, event_type AS data FROM events
UNION ALL SELECT event_id, event_type FROM events
""")
def append_table(spark, sf):
    name = new_table(spark, TEST_TABLE)
    rows = table(spark, sf, "events").select("event_id", "event_type")
    table_sinks.append_table(rows, name)
    table_sinks.append_table(rows, name)
    return catalog.scan_table(spark, name)


@query("SELECT event_id AS id, event_type AS data FROM events")
def append_table_dedupe(spark, sf):
    name = new_table(spark, TEST_TABLE)
    rows = table(spark, sf, "events").selectExpr("event_id AS id", "event_type AS data")
    table_sinks.append_table(rows, name, dedupe_key="id")
    table_sinks.append_table(rows, name, dedupe_key="id")
    return catalog.scan_table(spark, name)


@query("SELECT event_id AS id, event_type AS data FROM events")
def append_table_indexed(spark, sf):
    """A part of the events, and then all of them by key: the table's keys stay in their buckets."""
    name = new_table(spark, TEST_TABLE)
    rows = table(spark, sf, "events").selectExpr("event_id AS id", "event_type AS data")
    table_sinks.append_table(rows.filter("id % 3 = 0"), name)
    build_key_index(spark, name, "id", 16)
    for _ in range(2):
        table_sinks.append_table(rows, name, dedupe_key="id")
    return catalog.scan_table(spark, name)


LITERALS = ", ".join(f"({i}, '{t}')" for i, t in TEST_ROWS)


@query(f"""
SELECT event_id AS id, event_type AS data FROM events
UNION ALL SELECT * FROM (VALUES {LITERALS}) AS v(id, data)
""")
def insert_values(spark, sf):
    name = new_table(spark, TEST_TABLE)
    table_sinks.append_table(table(spark, sf, "events").select("event_id", "event_type"), name)
    table_sinks.insert_values(spark, name, TEST_ROWS)
    return catalog.scan_table(spark, name)


@query(f"{SALE_TABLE_SQL} FROM ({SALES})")
def load_sales_table(spark, sf):
    csv = file_sinks.write_csv(sales(table(spark, sf, "events")), scratch_dir(spark, "csv"))
    folder = scratch_dir(spark, "ventes")
    name = folder.rpartition("/")[2].replace("-", "_")
    return batch.load_sales_table(
        spark, csv, name, export=scratch_dir(spark, "export"), location=folder
    )


@query("SELECT event_id AS id, event_type AS data, TRUE AS exported FROM events")
def catalog_smoke(spark, sf):
    folder = scratch_dir(spark, "smoke")
    return batch.catalog_smoke(
        spark,
        "default",
        scratch_dir(spark, "csv"),
        table=folder.rpartition("/")[2].replace("-", "_"),
        rows=table(spark, sf, "events").select("event_id", "event_type"),
        location=folder,
    )


@query("""
SELECT 'namespace' AS kind, 'found' AS name, NULL::BIGINT AS n
UNION ALL SELECT 'table', 'ventes', NULL
UNION ALL SELECT 'rows', 'ventes', count(*) FROM events
""")
def catalog_listing(spark, sf):
    folder = scratch_dir(spark, "ns")
    ns = folder.rpartition("/")[2].replace("-", "_")
    catalog.create_namespace(spark, ns, folder)
    catalog.create_table(spark, f"{ns}.ventes", TEST_TABLE)
    events = table(spark, sf, "events").select("event_id", "event_type")
    table_sinks.append_table(events, f"{ns}.ventes")
    none = F.lit(None).cast("bigint").alias("n")
    found = catalog.list_namespaces(spark).filter(F.col("namespace") == ns)
    tables = catalog.list_tables(spark, ns)
    rows = aggregates.row_count(catalog.scan_table(spark, f"{ns}.ventes"))
    return (
        found.select(F.lit("namespace").alias("kind"), F.lit("found").alias("name"), none)
        .unionByName(
            tables.select(F.lit("table").alias("kind"), F.col("tableName").alias("name"), none)
        )
        .unionByName(rows.select(F.lit("rows").alias("kind"), F.lit("ventes").alias("name"), "n"))
    )


# --- topics ------------------------------------------------------------------


@query(f"""
SELECT event_id::VARCHAR AS key, props AS value, 'sales_in' AS topic, part::INTEGER AS partition,
  row_number() OVER (PARTITION BY part ORDER BY event_id NULLS FIRST, props NULLS FIRST) - 1 AS "offset", TRUE AS gapless
FROM (SELECT *, coalesce((event_id % {PARTS} + {PARTS}) % {PARTS}, 0) AS part FROM events)
""")
def envelope_view(spark, sf):
    """Messages written by many tasks, each in order; offsets count up from 0 without gaps in every partition."""
    topic = Topic.files("sales_in", scratch_dir(spark, "sales_in"))
    events = table(spark, sf, "events").select("event_id", "props")
    task = F.coalesce(F.pmod("event_id", F.lit(PARTS)), F.lit(0)).cast("int")
    rows = events.repartitionById(PARTS, task).sortWithinPartitions("event_id", "props")
    topic_sinks.write_topic(rows.selectExpr("CAST(event_id AS STRING) AS key", "props AS value"), topic)
    view = projections.envelope_view(read_topic(spark, topic))
    each = view.groupBy("partition").agg(
        F.min("offset").alias("low"), F.max("offset").alias("high"),
        F.count("*").alias("n"), F.count_distinct("offset").alias("different"),
    )
    whole = (F.col("low") == 0) & (F.col("high") + 1 == F.col("n")) & (F.col("n") == F.col("different"))
    parts = each.agg((F.every(whole) & (F.max("partition") < PARTS)).alias("gapless"))
    return view.crossJoin(F.broadcast(parts))  # one row


@query(f"""
SELECT *, CASE WHEN "IDVente"::BIGINT < (SELECT (max(event_id) + 1) // 3 FROM events) THEN 'first'
  ELSE 'rest' END AS part FROM ({LENIENT})
""")
def topic_batch_ranges(spark, sf):
    """A topic read up to an offset and then from where that read ended."""
    topic = ordered_topic(spark, sf)
    end = table(spark, sf, "events").agg(F.expr("(max(event_id) + 1) div 3")).first()[0] or 0
    first = read_topic(spark, topic, ranges={0: (None, end)})
    rest = read_topic(spark, topic, ranges=next_ranges(first) or {0: (None, None)})
    parts = [
        filters.filter_key_present(parsing.parse_json(m)).withColumn("part", F.lit(name))
        for m, name in ((first, "first"), (rest, "rest"))
    ]
    return parts[0].unionByName(parts[1])


@query(LENIENT)
def topic_batch(spark, sf):
    messages_in = read_topic(spark, message_topic(spark, sf))
    return filters.filter_key_present(parsing.parse_json(messages_in))


@query(LENIENT)
def land_topic(spark, sf):
    out = scratch_dir(spark, "landed")
    batch.land_topic(spark, message_topic(spark, sf), out)
    return file_sources.read_parquet(spark, out)


# --- streams -----------------------------------------------------------------


@query(LENIENT)
def relay_topic(spark, sf):
    source = message_topic(spark, sf)
    sink = Topic.files("sales_out", scratch_dir(spark, "sales_out"))
    checkpoint = scratch_dir(spark, "ckpt")
    finish(
        streams.relay_topic(spark, source, sink, checkpoint, trigger=NOW, max_per_trigger=1)
    )
    return parsing.parse_json(read_topic(spark, sink))


@query(f"{LENIENT} UNION ALL {LENIENT}")
def relay_two_writers(spark, sf):
    """Two relays into one topic, each with a checkpoint of its own."""
    source = message_topic(spark, sf)
    sink = Topic.files("sales_out", scratch_dir(spark, "sales_out"))
    for _ in range(2):
        checkpoint = scratch_dir(spark, "ckpt")
        finish(
            streams.relay_topic(spark, source, sink, checkpoint, trigger=NOW, max_per_trigger=1)
        )
    return parsing.parse_json(read_topic(spark, sink))


@query(f"SELECT *, TRUE AS resumed FROM ({LENIENT})")
def resume_from_checkpoint(spark, sf):
    """A restart takes the messages that came since, and none of those before."""
    source = Topic.files("sales_in", scratch_dir(spark, "sales_in"))
    sink = Topic.files("sales_out", scratch_dir(spark, "sales_out"))
    checkpoint = scratch_dir(spark, "ckpt")
    counts = []
    for part in in_steps(table(spark, sf, "events")):
        topic_sinks.write_topic(sale_messages(part).select("value"), source)
        finish(streams.relay_topic(spark, source, sink, checkpoint, trigger=NOW))
        counts.append(read_topic(spark, sink).count())
    resumed = counts[0] < counts[1] < counts[2]
    return parsing.parse_json(read_topic(spark, sink)).withColumn("resumed", F.lit(resumed))


@query(f"SELECT *, TRUE AS strict_stops FROM ({LENIENT})")
def tolerate_offset_reset(spark, sf):
    """Messages vanish after a batch has listed them: the strict reader stops, the other goes on."""
    source = message_topic(spark, sf)
    doomed = f"{source.location}/doomed"
    folder = spark._jvm.org.apache.hadoop.fs.Path(doomed)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def relay(strict: bool) -> Topic:
        sink = Topic.files("sales_out", scratch_dir(spark, "sales_out"))
        send = topic_sinks.topic_batches(sink)
        read_topic(spark, source).write.mode("overwrite").parquet(doomed)

        def lose_some(rows: DataFrame, batch_id: int) -> None:
            store.delete(folder, True)
            send(rows, batch_id)

        rows = streams.relay(stream_topic(spark, source, fail_on_data_loss=strict))
        finish(write_each_batch(rows, lose_some, scratch_dir(spark, "ckpt"), NOW))
        return sink

    try:
        relay(strict=True)
        stops = False
    except StreamingQueryException:
        stops = True
    sent = parsing.parse_json(read_topic(spark, relay(strict=False)))
    return sent.withColumn("strict_stops", F.lit(stops))


@query("SELECT event_id, event_type, value, TRUE AS spaced FROM events")
def checkpoint_interval(spark, sf):
    """Micro-batches of a query with an interval start that far apart; then it is stopped.

    The first starts at once, the others at whole multiples of the interval.
    """
    rows = event_stream(spark, sf).select("event_id", "event_type", "value")
    out = scratch_dir(spark, "batches")
    running = write_each_batch(
        rows, parquet_batches(out), scratch_dir(spark, "ckpt"), {"processingTime": "2 seconds"}
    )
    try:
        running.processAllAvailable()
        starts = [
            datetime.fromisoformat(p["timestamp"].replace("Z", "+00:00")).timestamp()
            for p in running.recentProgress
            if p["numInputRows"]
        ]
    finally:
        running.stop()
    spaced = len(starts) >= STEPS and all(b - a > 1.5 for a, b in pairwise(starts[1:]))
    return spark.read.parquet(out).drop("batch_id").withColumn("spaced", F.lit(spaced))


FANNED = f"""
SELECT 'parquet' AS sink, * FROM ({LENIENT}) UNION ALL SELECT 'topic', * FROM ({LENIENT})
"""


def _kept_sales(spark, sf):
    return filters.filter_key_present(
        parsing.parse_json(stream_topic(spark, message_topic(spark, sf), max_per_trigger=1))
    )


def _fanned(landed: DataFrame, sent: DataFrame) -> DataFrame:
    return landed.withColumn("sink", F.lit("parquet")).unionByName(
        parsing.parse_json(sent).withColumn("sink", F.lit("topic"))
    )


def _fan_out(spark, sf, shared):
    out = scratch_dir(spark, "sales")
    topic = Topic.files("sales_out", scratch_dir(spark, "sales_out"))
    send = topic_sinks.topic_batches(topic)
    sinks = {
        "parquet": parquet_batches(out),
        "topic": lambda rows, batch_id: send(parsing.render_json(rows), batch_id),
    }
    finish(*fan_out(_kept_sales(spark, sf), sinks, scratch_dir(spark, "ckpt"), shared, NOW))
    return _fanned(spark.read.parquet(out).drop("batch_id"), read_topic(spark, topic))


@query(FANNED)
def stream_fan_out(spark, sf):
    return _fan_out(spark, sf, False)


@query(FANNED)
def stream_fan_out_shared(spark, sf):
    """One pass: each row is routed to both sinks and written once."""
    kept, out = _kept_sales(spark, sf), scratch_dir(spark, "sales")
    text = F.to_json(F.struct(*kept.columns))
    routes = {"parquet": rows_route(kept), "topic": topic_route("sales_out", text)}
    finish(fan_out_routed(kept, routes, out, scratch_dir(spark, "ckpt"), NOW))
    landed = routed_rows(spark, out, "parquet", routes["parquet"])
    return _fanned(landed, read_topic(spark, routed_topic("sales_out", out, "topic")))


@query(FANNED)
def stream_fan_out_sinks(spark, sf):
    """One query that keeps each micro-batch for sinks of any kind."""
    return _fan_out(spark, sf, True)


@query("SELECT event_id, event_type, value FROM events")
def sink_foreach_batch(spark, sf):
    rows = event_stream(spark, sf).select("event_id", "event_type", "value")
    out = scratch_dir(spark, "batches")
    finish(write_each_batch(rows, parquet_batches(out), scratch_dir(spark, "ckpt"), NOW))
    return spark.read.parquet(out).drop("batch_id")


@query("""
SELECT CASE event_type WHEN 'view' THEN 'view ' || event_id ELSE props END AS value
FROM events WHERE event_type <> 'error'
""")
def echo_topic(spark, sf):
    kind = F.col("event_type")
    text = (
        F.when(kind == "view", F.concat(F.lit("view "), "event_id"))
        .when(kind != "error", F.col("props"))
        .otherwise("")
    )
    out = scratch_dir(spark, "echo")
    finish(
        streams.echo_topic(
            event_stream(spark, sf).select(text.alias("value")),
            parquet_batches(out),
            scratch_dir(spark, "ckpt"),
            NOW,
        )
    )
    return spark.read.parquet(out).drop("batch_id")


@query("""
SELECT event_type, count(*) AS n, sum(value::DECIMAL(18,2))::DOUBLE AS total,
  sum(value::DECIMAL(18,2))::DOUBLE / count(*) AS mean FROM events GROUP BY 1
""")
def stream_category_stats(spark, sf):
    stats = aggregates.group_stats(event_stream(spark, sf), "event_type", "value", MONEY)
    out = scratch_dir(spark, "stats")
    finish(
        write_each_batch(
            in_money(stats), parquet_batches(out), scratch_dir(spark, "ckpt"), NOW, "update"
        )
    )
    return latest_per_key(spark.read.parquet(out), "event_type")


@query("""
SELECT user_id, sum(value::DECIMAL(18,2))::DOUBLE AS total FROM events GROUP BY 1
""")
def stream_city_totals(spark, sf):
    totals = aggregates.group_totals(event_stream(spark, sf), "user_id", "value", MONEY)
    out = scratch_dir(spark, "totals")
    finish(
        write_each_batch(
            in_money(totals), parquet_batches(out), scratch_dir(spark, "ckpt"), NOW, "update"
        )
    )
    return latest_per_key(spark.read.parquet(out), "user_id")


@query("""
SELECT user_id, sum(value::DECIMAL(18,2))::DOUBLE AS total FROM events GROUP BY 1
ORDER BY 2 DESC, 1 LIMIT 5
""")
def stream_top_cities(spark, sf):
    totals = aggregates.group_totals(event_stream(spark, sf), "user_id", "value", MONEY)
    top = aggregates.top_k(in_money(totals), "user_id")
    out = scratch_dir(spark, "top")
    finish(
        write_each_batch(top, parquet_batches(out), scratch_dir(spark, "ckpt"), NOW, "complete")
    )
    # Complete mode repeats the whole report with every batch; the last one counts.
    reports = spark.read.parquet(out)
    return reports.filter(
        F.col("batch_id") == reports.select(F.max("batch_id")).scalar()
    ).drop("batch_id")


def _running_stream(spark, sf, key):
    rows = event_stream(spark, sf).select("event_id", key, "value")
    out = scratch_dir(spark, "running")
    finish(
        running_stats_stream(
            rows,
            key,
            "value",
            "event_id",
            out,
            scratch_dir(spark, "ckpt"),
            sum_type=MONEY,
            trigger=NOW,
        )
    )
    return in_money(spark.read.parquet(out)).drop("value", "batch_id")


@query(RUNNING.format(key="event_type", value="value::DECIMAL(18,2)"))
def stream_category_stats_running(spark, sf):
    return _running_stream(spark, sf, "event_type")


@query(RUNNING.format(key="user_id", value="value::DECIMAL(18,2)"))
def stream_city_totals_running(spark, sf):
    return _running_stream(spark, sf, "user_id")


IDLE = 2  # seconds


@query("""
SELECT event_id, user_id, count(*) OVER w AS n, (sum(v) OVER w)::DOUBLE AS total,
  (sum(v) OVER w)::DOUBLE / count(*) OVER w AS mean
FROM (SELECT *, value::DECIMAL(18,2) AS v, 2 * event_id > (SELECT max(event_id) FROM events) AS late FROM events)
WINDOW w AS (PARTITION BY user_id, late ORDER BY event_id ROWS UNBOUNDED PRECEDING)
""")
def stream_running_idle_keys(spark, sf):
    """Half of the events, a pause in which every key is forgotten, and the other half."""
    events = table(spark, sf, "events").select("event_id", "user_id", "value")
    last = events.agg(F.max("event_id")).first()[0] or 0
    folder, out, checkpoint = (scratch_dir(spark, n) for n in ("events", "running", "ckpt"))
    for late in (False, True):
        half = events.filter((2 * F.col("event_id") > last) == late)
        half.write.mode("append").parquet(folder)
        rows = spark.readStream.schema(events.schema).parquet(folder)
        finish(
            running_stats_stream(
                rows, "user_id", "value", "event_id", out, checkpoint,
                sum_type=MONEY, trigger=NOW, ttl=f"{IDLE} seconds",
            )
        )
        if not late:
            time.sleep(IDLE)
    return in_money(spark.read.parquet(out)).drop("value", "batch_id")


@query("SELECT event_id AS id, event_type AS data FROM events")
def stream_to_table(spark, sf):
    name = new_table(spark, TEST_TABLE, committed=True)
    rows = event_stream(spark, sf).selectExpr("event_type AS data", "event_id AS id")
    finish(table_sinks.stream_to_table(rows, name, scratch_dir(spark, "ckpt"), NOW))
    return catalog.scan_table(spark, name)


@query("""
SELECT event_id AS id, event_type AS data, FALSE AS appended FROM events
UNION ALL SELECT event_id, event_type, TRUE FROM events
""")
def stream_to_table_retried(spark, sf):
    """A batch is tried again after its rows are in the table, beside appended rows; then batches are folded."""
    schema = T.StructType([*TEST_TABLE.fields, T.StructField("appended", T.BooleanType())])
    name, checkpoint = new_table(spark, schema, committed=True), scratch_dir(spark, "ckpt")
    rows = event_stream(spark, sf).selectExpr(
        "event_id AS id", "event_type AS data", "FALSE AS appended"
    )
    finish(table_sinks.stream_to_table(rows, name, checkpoint, NOW))
    both = table(spark, sf, "events").selectExpr("event_id", "event_type", "TRUE")
    table_sinks.append_table(both, name)
    forget_commit(spark, checkpoint)
    finish(table_sinks.stream_to_table(rows, name, checkpoint, NOW))
    table_sinks.fold_batches(spark, name)
    return catalog.scan_table(spark, name)


@query(f"""
WITH kept AS ({SALE_TABLE_SQL}, "Categorie" FROM ({LENIENT}))
SELECT * EXCLUDE ("Categorie") REPLACE (CASE "Categorie" WHEN 'view' THEN NULL ELSE quantite END AS quantite,
  CASE "Categorie" WHEN 'purchase' THEN NULL ELSE total END AS total),
  (SELECT count(*) FROM kept WHERE "Categorie" = 'view') AS bad_quantite,
  (SELECT count(*) FROM kept WHERE "Categorie" = 'purchase') AS bad_total
FROM kept
""")
def stream_topic_to_table(spark, sf):
    """The table's rows, and how many values were no numbers and became NULL."""
    source = Topic.files("sales_in", scratch_dir(spark, "sales_in"))
    value = F.col("value")
    kind = F.get_json_object("value", "$.Categorie")
    spoilt = (
        F.when(kind == "view", F.regexp_replace(value, '("Quantité":)"?\\d+"?', '$1"4 x"'))
        .when(kind == "purchase", F.regexp_replace(value, '("Total":)"[^"]*"', '$1"much"'))
        .otherwise(value)
    )
    for part in in_steps(table(spark, sf, "events")):
        topic_sinks.write_topic(sale_messages(part).select(spoilt.alias("value")), source)
    name, lost = new_table(spark, SALE_TABLE, committed=True), scratch_dir(spark, "lost")
    finish(
        streams.stream_topic_to_table(
            spark, source, name, scratch_dir(spark, "ckpt"), rejects=parquet_batches(lost),
            trigger=NOW, max_per_trigger=1,
        )
    )
    bad = spark.read.parquet(lost).agg(
        F.sum("quantite").alias("bad_quantite"), F.sum("total").alias("bad_total")
    )
    return catalog.scan_table(spark, name).crossJoin(F.broadcast(bad))  # one row of counts


@query(f"""
SELECT * EXCLUDE ("Quantité", "PrixUnitaire", "Remise", "Total"), "Quantité"::INTEGER AS "Quantite",
  "PrixUnitaire"::DOUBLE AS "PrixUnitaire", "Remise"::DOUBLE AS "Remise", "Total"::DOUBLE AS "Total"
FROM ({LENIENT})
""")
def source_topic_table(spark, sf):
    view = scratch_dir(spark, "sales").rpartition("/")[2].replace("-", "_")
    topic_view(spark, message_topic(spark, sf), view, max_per_trigger=1)
    out = scratch_dir(spark, "view")
    kept = spark.sql(f"SELECT * FROM {view} WHERE IDVente IS NOT NULL")
    finish(write_each_batch(kept, parquet_batches(out), scratch_dir(spark, "ckpt"), NOW))
    return spark.read.parquet(out).drop("batch_id")


BRANCHES = ["category", "city", "alerts", "events", "sales", "rejects"]


def _live(spark, messages_in, names, per_record=False):
    out = scratch_dir(spark, "live")
    sinks = {n: parquet_batches(f"{out}/branch={n}") for n in names}
    finish(
        *streams.live_sales_metrics(
            messages_in,
            sinks,
            scratch_dir(spark, "ckpt"),
            threshold=100.0,
            per_record=per_record,
            trigger=NOW,
            sum_type=MONEY,
        )
    )
    # turnover per micro-batch repeats a key with every batch that has it: the last line counts
    repeats = {} if per_record else {"category": r"^(.*?): \d+ ventes", "city": r"^(.*): [-0-9.]+€$"}

    def lines(n: str) -> DataFrame:
        rows = spark.read.parquet(f"{out}/branch={n}").toDF("message", "batch_id")
        if n in repeats:
            by = F.regexp_extract("message", repeats[n], 1)
            rows = rows.groupBy(by).agg(F.max_by("message", "batch_id").alias("message"))
        return rows.select(F.lit(n).alias("branch"), "message")

    texts = [lines(n) for n in names]
    return reduce(DataFrame.unionByName, texts)


def _branches(**parts: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS branch, {'value' if n in ('events', 'rejects') else 'message'} "
        f"AS message FROM ({sql})"
        for n, sql in parts.items()
    )


@query(_branches(
    category=_category_sql(f"""
SELECT "Categorie" AS c, count(*) AS n, sum("Total"::DECIMAL(18,2))::DOUBLE AS total
FROM ({STRICT}) GROUP BY 1"""),
    city=_city_sql(f"""
SELECT "Ville" AS c, sum("Total"::DECIMAL(18,2))::DOUBLE AS total FROM ({STRICT}) GROUP BY 1"""),
    alerts=ALERTS.format(STRICT),
    events=EVENT_JSON,
    sales=LINES.format(STRICT),
    rejects=REJECTS,
))
def live_sales_metrics(spark, sf):
    messages_in = stream_topic(spark, message_topic(spark, sf), max_per_trigger=1)
    return _live(spark, messages_in, BRANCHES)


def _so_far(key: str) -> str:
    return f"""
SELECT "{key}" AS c, count(*) OVER w AS n,
  (sum("Total"::DECIMAL(18,2)) OVER w)::DOUBLE AS total FROM ({STRICT})
WINDOW w AS (PARTITION BY "{key}" ORDER BY "IDVente"::BIGINT ROWS UNBOUNDED PRECEDING)
"""


@query(_branches(
    category=_category_sql(_so_far("Categorie")),
    city=_city_sql(_so_far("Ville")),
    alerts=ALERTS.format(STRICT),
    events=EVENT_JSON,
    sales=LINES.format(STRICT),
    rejects=REJECTS,
))
def live_sales_metrics_per_record(spark, sf):
    messages_in = stream_topic(spark, ordered_topic(spark, sf), max_per_trigger=FILES)
    return _live(spark, messages_in, BRANCHES, True)


@query(f"""
SELECT c AS "Categorie", n, total FROM (
  SELECT "Categorie" AS c, count(*) AS n, sum("Total"::DECIMAL(18,2))::DOUBLE AS total
  FROM ({STRICT}) WHERE "Categorie" = 'click' GROUP BY 1)
UNION ALL SELECT reason, count(*), NULL FROM (
  SELECT CASE event_type WHEN 'view' THEN 'out of range: Total' WHEN 'purchase'
    THEN 'not a number: Quantité' WHEN 'signup' THEN 'missing field Pays'
    ELSE 'malformed JSON' END AS reason FROM events WHERE event_type <> 'click') GROUP BY 1
""")
def poison_records(spark, sf):
    """Totals too large to add up and numbers with a line end are rejects; the rest adds up."""
    kind = F.get_json_object("value", "$.Categorie")
    spoilt = (
        F.when(kind == "view", F.regexp_replace("value", '("Total":)[^,}]*', "$11e300"))
        .when(kind == "purchase", F.regexp_replace("value", '("Quantité":"\\d+)"', '$1\\\\n"'))
        .otherwise(F.col("value"))
    )
    texts = sale_messages(table(spark, sf, "events")).select(spoilt.alias("value"))
    good, bad = parsing.split_parsed(parsing.parse_sale_strict(texts, total_type=MONEY))
    totals = in_money(aggregates.group_stats(good, sum_type=MONEY)).drop("mean")
    none = F.lit(None).cast("double").alias("total")
    return totals.unionByName(
        bad.groupBy(F.col("reason").alias("Categorie")).agg(F.count("*").alias("n")).select("*", none)
    )


@query(RUNNING.format(key="user_id", value="CASE event_type WHEN 'view' THEN value END::DECIMAL(18,2)"))
def running_with_nulls(spark, sf):
    """Running totals of a measure that is often absent, in blocks of a few rows."""
    value = F.when(F.col("event_type") == "view", F.col("value")).alias("value")
    events = table(spark, sf, "events").select("event_id", "user_id", value)
    rows = running_stats(events, "user_id", "value", "event_id", sum_type=MONEY, block=64)
    return in_money(rows).drop("value")
