import os

import pytest
from pyspark.sql import functions as F

from tillflow.schemas import SALE_CSV, SALE_CSV_PRICED
from tillflow.sinks.files import (
    counted,
    readback_check,
    write_csv,
    write_csv_if_absent,
    write_parquet,
)
from tillflow.sources.files import latest_file, path_has_data, read_csv_raw, read_csv_typed


def put(path, text, mtime=None):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    if mtime is not None:
        os.utime(path, (mtime, mtime))


def test_typed_csv_shapes(spark, tmp_path):
    put(tmp_path / "a.csv", "id,n,r\n2,4.5,x\n3,,0\n4\n5,6,0.2,extra\n")
    got = read_csv_typed(spark, str(tmp_path / "a.csv"), "id string, n int, r double")
    assert [tuple(r) for r in got.collect()] == [
        ("2", None, None),
        ("3", None, 0.0),
        ("4", None, None),
        ("5", 6, 0.2),
    ]


def test_price_with_decimals_needs_the_priced_shape(spark, tmp_path):
    header = ",".join(SALE_CSV.names)
    put(tmp_path / "a.csv", f"{header}\n1,2024-01-05,P,C,2,12.5,c,v,p,0,CB,25\n")
    path = str(tmp_path / "a.csv")
    assert read_csv_typed(spark, path).first().PrixUnitaire is None
    assert read_csv_typed(spark, path, SALE_CSV_PRICED).first().PrixUnitaire == 12.5


def test_raw_csv_is_all_text(spark, tmp_path):
    put(tmp_path / "a.csv", "id;n\n01;\n2;x,y\n")
    got = read_csv_raw(spark, str(tmp_path / "a.csv"), sep=";")
    assert [tuple(r) for r in got.collect()] == [("01", None), ("2", "x,y")]


def test_latest_file(spark, tmp_path):
    put(tmp_path / "b.csv", "x\n1\n", 2000)
    put(tmp_path / "a.csv", "x\n1\n", 2000)
    put(tmp_path / "old.csv", "x\n1\n", 1000)
    put(tmp_path / "notes.txt", "newer, but no CSV", 3000)
    row = latest_file(spark, str(tmp_path)).first()
    assert row.path.endswith("/a.csv") and row.length == 4
    put(tmp_path / "deep" / "c.csv", "x\n1\n", 4000)
    assert latest_file(spark, str(tmp_path)).first().path.endswith("/deep/c.csv")
    assert latest_file(spark, str(tmp_path), recursive=False).first().path.endswith("/a.csv")
    assert latest_file(spark, str(tmp_path), "*.txt").first().path.endswith("/notes.txt")
    with pytest.raises(FileNotFoundError):
        latest_file(spark, str(tmp_path), "*.json")


def test_path_has_data(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    assert not path_has_data(spark, str(tmp_path / "empty"))
    assert not path_has_data(spark, str(tmp_path / "absent"))
    put(tmp_path / "some" / "a.csv", "x\n1\n")
    assert path_has_data(spark, str(tmp_path / "some"))
    with pytest.raises(Exception, match="nowhere"):
        path_has_data(spark, "nowhere://x/y")


def test_csv_only_if_absent(spark, tmp_path):
    out = tmp_path / "out"
    out.mkdir()
    assert write_csv_if_absent(spark.range(3), str(out))
    assert not write_csv_if_absent(spark.range(5), str(out))
    assert read_csv_raw(spark, str(out)).count() == 3


def test_microseconds_survive_text(spark, tmp_path):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 00:00:07.179575' AS ts")
    back = read_csv_typed(spark, write_csv(df, str(tmp_path / "t")), df.schema)
    assert back.collect() == df.collect()


def parts(path):
    return [f for f in os.listdir(path) if f.endswith(".parquet")]


def test_parquet_files(spark, tmp_path):
    df = spark.range(0, 1000, 1, 6).withColumn("Quantité", F.col("id") % 3)
    assert len(parts(write_parquet(df, str(tmp_path / "a")))) == 6
    assert len(parts(write_parquet(df, str(tmp_path / "b"), n_files=2))) == 2
    assert len(parts(write_parquet(df, str(tmp_path / "c"), compact=True))) == 1
    snap = write_parquet(df, str(tmp_path / "d"), snapshot=17, partition_by=["Quantité"])
    assert snap.endswith("/d/output_17.parquet")
    back = spark.read.parquet(snap).filter("`Quantité` = 1")
    assert back.count() == 333
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Quantité" in plan


def test_counted_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(500).mapInArrow(touch, "id long")
    assert counted(df, lambda d: write_parquet(d, str(tmp_path / "n"))) == 500
    assert seen.value == 500


def test_readback(spark, tmp_path):
    df = spark.range(40).withColumn("d", F.lit(1.5))
    assert tuple(readback_check(spark, df, str(tmp_path / "r")).first()) == (40, 40, True, True)
    empty = df.filter("id < 0")
    assert tuple(readback_check(spark, empty, str(tmp_path / "e")).first()) == (0, 0, True, True)
