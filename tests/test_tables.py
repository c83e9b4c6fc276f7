import datetime
import uuid

import pytest
from pyspark.errors import AnalysisException

from tillflow.plans.batch import catalog_smoke, load_sales_table
from tillflow.schemas import SALE_FIELDS, SALE_RAW, SALE_TABLE, TEST_ROWS, TEST_TABLE
from tillflow.sinks.files import write_csv
from tillflow.sinks import tables as sinks
from tillflow.sinks.keys import build_key_index, not_in_index, up_to_date
from tillflow.sinks.tables import _new_keys, append_table, insert_values, stream_to_table
from tillflow.sources.files import read_csv_raw
from tillflow.sources.tables import (
    create_namespace,
    create_table,
    inline_values,
    list_namespaces,
    list_tables,
    scan_table,
)

NOW = {"availableNow": True}


def fresh(prefix="t"):
    return f"{prefix}_{uuid.uuid4().hex}"


@pytest.fixture
def table(spark, tmp_path):
    name = fresh()
    create_table(spark, name, TEST_TABLE, location=str(tmp_path / name))
    yield name
    spark.sql(f"DROP TABLE {name}")


def content(spark, name):
    return sorted(tuple(r) for r in scan_table(spark, name).collect())


def test_append_goes_by_position_and_repeats(spark, table):
    rows = spark.createDataFrame([(1, "a")], "data long, id string")
    append_table(rows, table)
    append_table(rows, table)
    assert content(spark, table) == [(1, "a"), (1, "a")]


def test_append_by_name(spark, table):
    append_table(spark.createDataFrame([("a", 1)], "data string, id long"), table, by_name=True)
    assert content(spark, table) == [(1, "a")]


def test_text_is_not_stored_as_number(spark, table):
    with pytest.raises(AnalysisException):
        append_table(spark.createDataFrame([("x", "a")], "id string, data string"), table)


def test_dedupe(spark, table):
    first = [(1, "a"), (1, "a"), (2, "b"), (None, "n"), (None, "n")]
    append_table(spark.createDataFrame(first, TEST_TABLE), table, dedupe_key="id")
    again = [(2, "b"), (3, "c"), (None, "n")]
    append_table(spark.createDataFrame(again, TEST_TABLE), table, dedupe_key="id")
    got = sorted(scan_table(spark, table).collect(), key=repr)
    want = [(1, "a"), (2, "b"), (3, "c"), *[(None, "n")] * 3]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def without_small_joins(spark, fn):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return fn()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_large_batch_leaves_the_keys_of_the_table_where_they_are(spark, table):
    """Beyond the broadcast the index is joined bucket by bucket: no exchange above its scan."""
    append_table(spark.range(500).selectExpr("id", "'old' AS data"), table)
    build_key_index(spark, table, "id", 16)
    batch = spark.range(sinks._FEW_KEYS + 10).selectExpr("id", "'new' AS data")
    plan = without_small_joins(spark, lambda: physical(not_in_index(batch, table, "id")))
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
    assert plan.count("Exchange") == 1  # that of the batch
    assert "SelectedBucketsCount: 16 out of 16" in plan
    without_small_joins(spark, lambda: append_table(batch, table, dedupe_key="id"))
    assert scan_table(spark, table).count() == sinks._FEW_KEYS + 10
    assert scan_table(spark, table).filter("data = 'old'").count() == 500
    assert up_to_date(spark, table, "id")


def test_indexed_dedupe_is_dedupe(spark, table):
    first = [(1, "a"), (1, "a"), (2, "b"), (None, "n"), (None, "n")]
    build_key_index(spark, table, "id", 4)
    append_table(spark.createDataFrame(first, TEST_TABLE), table, dedupe_key="id")
    again = [(2, "b"), (3, "c"), (None, "n")]
    append_table(spark.createDataFrame(again, TEST_TABLE), table, dedupe_key="id")
    got = sorted(map(tuple, scan_table(spark, table).collect()), key=repr)
    assert got == sorted([(1, "a"), (2, "b"), (3, "c"), *[(None, "n")] * 3], key=repr)
    assert up_to_date(spark, table, "id")


def test_an_index_left_behind_is_built_anew(spark, table):
    """Rows came past it: by another writer, or in a run that stopped before its keys were added."""
    build_key_index(spark, table, "id", 4)
    append_table(spark.createDataFrame([(1, "a"), (2, "b")], TEST_TABLE), table)
    assert not up_to_date(spark, table, "id")
    append_table(spark.createDataFrame([(2, "x"), (3, "c")], TEST_TABLE), table, dedupe_key="id")
    assert content(spark, table) == [(1, "a"), (2, "b"), (3, "c")]
    assert up_to_date(spark, table, "id")


def test_wide_keys_are_not_broadcast(spark, table, monkeypatch):
    monkeypatch.setattr(sinks, "_FEW_BYTES", 100)
    old = spark.createDataFrame([(1, "k" * 60)], TEST_TABLE)
    append_table(old, table)
    for keys, sent in ((["k" * 60], True), (["k" * 60, "l" * 60], False)):
        rows = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], TEST_TABLE)
        fresh = without_small_joins(spark, lambda rows=rows: sinks._new_keys(rows, scan_table(spark, table), "data"))
        plan = without_small_joins(spark, lambda fresh=fresh: physical(fresh))
        assert ("BroadcastExchange" in plan) == sent
        assert fresh.count() == len(keys) - 1


def test_insert_and_inline_values(spark, table):
    insert_values(spark, table, TEST_ROWS)
    assert content(spark, table) == list(TEST_ROWS)
    assert [tuple(r) for r in inline_values(spark, TEST_ROWS).collect()] == list(TEST_ROWS)


def stream_of(spark, path, rows):
    spark.createDataFrame(rows, "data string, id long").write.mode("append").parquet(path)
    return spark.readStream.schema("data string, id long").parquet(path)


def test_stream_and_batch_share_a_file_table(spark, table, tmp_path):
    insert_values(spark, table, [(1, "batch")])
    rows = stream_of(spark, str(tmp_path / "in"), [("stream", 2)])
    stream_to_table(rows, table, str(tmp_path / "ckpt"), NOW).awaitTermination()
    insert_values(spark, table, [(3, "batch")])
    stream_of(spark, str(tmp_path / "in"), [("stream", 4)])
    stream_to_table(rows, table, str(tmp_path / "ckpt"), NOW).awaitTermination()
    assert content(spark, table) == [(1, "batch"), (2, "stream"), (3, "batch"), (4, "stream")]


def test_lost_checkpoint_with_dedupe_adds_nothing(spark, table, tmp_path):
    rows = stream_of(spark, str(tmp_path / "in"), [("a", 1), ("b", 2)])
    for n in range(2):
        stream_to_table(
            rows, table, str(tmp_path / f"ckpt{n}"), NOW, dedupe_key="id"
        ).awaitTermination()
    assert content(spark, table) == [(1, "a"), (2, "b")]


def test_sole_writer(spark, table, tmp_path):
    rows = stream_of(spark, str(tmp_path / "in"), [("a", 1)])
    stream_to_table(
        rows, table, str(tmp_path / "ckpt"), NOW, sole_writer=True
    ).awaitTermination()
    assert content(spark, table) == [(1, "a")]


def test_namespaces_and_tables_are_idempotent(spark):
    ns = fresh("ns")
    for _ in range(2):
        create_namespace(spark, ns)
        create_table(spark, f"{ns}.ventes", partition_by=["ville"])
    assert ns in [r[0] for r in list_namespaces(spark).collect()]
    assert [r.tableName for r in list_tables(spark, ns).collect()] == ["ventes"]
    columns = {f.name: f.dataType for f in scan_table(spark, f"{ns}.ventes").schema}
    assert columns == {f.name: f.dataType for f in SALE_TABLE}
    spark.sql(f"DROP NAMESPACE {ns} CASCADE")


def test_catalog_smoke_twice(spark, tmp_path):
    ns = fresh("ns")
    out = str(tmp_path / "csv")
    first = catalog_smoke(spark, ns, out)
    assert sorted(map(tuple, first.collect())) == [(*r, True) for r in TEST_ROWS]
    again = catalog_smoke(spark, ns, out)
    assert sorted(map(tuple, again.collect())) == sorted([(*r, False) for r in TEST_ROWS] * 2)
    assert read_csv_raw(spark, out).count() == 3
    spark.sql(f"DROP NAMESPACE {ns} CASCADE")


def test_load_sales_table(spark, tmp_path):
    good = ["7", "2024-02-29", "Lampe", "Déco", "2", "10.5", "Ann", "Lyon", "FR", "0", "CB", "21"]
    bad = ["x7", "2024-02-30", "Lampe", "Déco", "2.0", "1e3", "Bob", "Nice", "FR", "-1", "CB", "12."]
    raw = spark.createDataFrame([good, bad], SALE_RAW)
    csv, export = write_csv(raw, str(tmp_path / "in")), str(tmp_path / "copy")
    ns = fresh("ns")
    got = load_sales_table(spark, csv, f"{ns}.ventes", export)
    assert got.columns == SALE_TABLE.names
    day = datetime.date(2024, 2, 29)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [
            (7, "Lampe", 10.5, 2, 21.0, 0.0, "Lyon", "Ann", "CB", day),
            (None, "Lampe", None, None, None, None, "Nice", "Bob", "CB", None),
        ],
        key=repr,
    )
    copy = read_csv_raw(spark, export)
    assert copy.columns == list(SALE_FIELDS)
    assert sorted(map(tuple, copy.collect())) == sorted(map(tuple, (good, bad)))
    spark.sql(f"DROP NAMESPACE {ns} CASCADE")


def test_dedupe_looks_up_a_small_batch_where_the_table_is_read(spark, table):
    name = table
    append_table(spark.range(100).selectExpr("id", "'a' AS data"), name)
    unseen = _new_keys(spark.range(90, 110).selectExpr("id", "'b' AS data"), spark.table(name), "id")
    plan = unseen._jdf.queryExecution().executedPlan().toString()
    lookup = plan.index("LeftSemi")
    assert "BroadcastHashJoin" in plan[lookup - 120 : lookup + 120]
    # below the lookup the table is scanned and not shuffled
    scan = plan.index("FileScan parquet", lookup)
    assert "Exchange hashpartitioning" not in plan[lookup:scan]
    append_table(spark.range(90, 110).selectExpr("id", "'b' AS data"), name, dedupe_key="id")
    assert spark.table(name).count() == 110
