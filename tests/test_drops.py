"""Drops of several files, and the check that what was written is what is read."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.plans.batch import ingest_latest_file
from tillflow.sinks import files as sinks
from tillflow.sources.files import latest_drop, read_csv_raw
from tillflow.sources.topics import Topic, read_topic

MANY = "id long, x double, t string, m map<string,array<int>>, s struct<a:int,m:map<int,int>>, l array<map<int,int>>"


def many(spark, change=None):
    rows = [
        (i, float(i), f"t{i}", {"a": [i], "b": []}, (i, {i: 1, -i - 1: 2}), [{1: i}, None]) for i in range(30)
    ]
    rows += [(None,) * 6, (7, float("nan"), "", {}, None, []), (7, -0.0, "", {}, None, [])]
    rows += rows[:3]
    return spark.createDataFrame(change(rows) if change else rows, MANY)


def test_fingerprint_does_not_depend_on_order(spark):
    df = many(spark)
    want = tuple(df.agg(*sinks.fingerprint(df)).first())
    for other in (df.repartition(7), df.orderBy(F.desc("id")).coalesce(1)):
        assert tuple(other.agg(*sinks.fingerprint(other)).first()) == want


def test_maps_are_equal_in_any_order(spark):
    a, b = (spark.createDataFrame([(m,)], "m map<string,int>") for m in ({"x": 1, "y": 2}, {"y": 2, "x": 1}))
    assert a.agg(*sinks.fingerprint(a)).first() == b.agg(*sinks.fingerprint(b)).first()


@pytest.mark.parametrize("change", [
    lambda r: [(0, 0.5, *r[0][2:]), *r[1:]],  # one value
    lambda r: [*r[1:], r[1]],  # one row for another
    lambda r: [(0, None, *r[0][2:]), *r[1:]],
    lambda r: [(*r[0][:3], {"a": [1], "b": []}, *r[0][4:]), *r[1:]],
    lambda r: [(*r[0][:4], (0, {0: 1, -1: 3}), r[0][5]), *r[1:]],
])
def test_a_changed_value_is_reported(spark, tmp_path, monkeypatch, change):
    """Counts and schema stay equal; what was written does not."""
    write = sinks.write_parquet

    def other(df, path):
        df.count()  # the rows pass, and others are written
        write(many(spark, change), path)

    monkeypatch.setattr(sinks, "write_parquet", other)
    row = sinks.readback_check(spark, many(spark), str(tmp_path / "r")).first()
    assert tuple(row) == (36, 36, True, False)


# --- drops --------------------------------------------------------------------------


def put(folder, name, at, text="a\n1\n"):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_text(text)
    os.utime(path, (at, at))


def names(drop):
    return [f.rpartition("/")[2] for f in drop.files]


def test_newest_complete_drop(spark, tmp_path):
    for i in range(8):
        put(tmp_path / "old", f"p{i}.csv", 1000 + i)
        put(tmp_path / "new" / "deep", f"p{i}.csv", 2000 + i)
        put(tmp_path / "late", f"p{i}.csv", 3000 + i)
    for folder in ("old", "new/deep"):
        (tmp_path / folder / "_SUCCESS").touch()
    drop = latest_drop(spark, str(tmp_path))
    assert drop.path.endswith("/new/deep") and names(drop) == [f"p{i}.csv" for i in range(8)]
    rows = read_csv_raw(spark, drop.files)
    assert rows.count() == 8 and len(rows.inputFiles()) == 8
    (tmp_path / "late" / "_SUCCESS").touch()
    assert latest_drop(spark, str(tmp_path)).path.endswith("/late")


def test_a_file_that_came_alone(spark, tmp_path):
    put(tmp_path / "whole", "p.csv", 1000)
    (tmp_path / "whole" / "_SUCCESS").touch()
    put(tmp_path, "lone.csv", 2000)
    put(tmp_path, "note.txt", 4000)
    put(tmp_path / "unfinished", "q.csv", 3000)
    assert names(latest_drop(spark, str(tmp_path))) == ["lone.csv"]
    assert names(latest_drop(spark, str(tmp_path), loose=False)) == ["p.csv"]
    with pytest.raises(FileNotFoundError, match="complete"):
        latest_drop(spark, str(tmp_path), "*.json")
    with pytest.raises(FileNotFoundError, match="complete"):
        latest_drop(spark, str(tmp_path / "unfinished" / ".."), marker="_DONE", loose=False)


def test_manifest(spark, tmp_path):
    """Files that it does not list are no part; a drop with one missing is not complete."""
    for at, name in enumerate(("first", "second")):
        for part in ("a.csv", "b.csv", "stray.csv"):
            put(tmp_path / name, part, 1000 * (at + 1))
        put(tmp_path / name, "manifest", 9000, "a.csv\n\nb.csv\n" + ("c.csv\n" if at else ""))
    drop = latest_drop(spark, str(tmp_path), manifest="manifest")
    assert drop.path.endswith("/first") and names(drop) == ["a.csv", "b.csv"]
    put(tmp_path / "second", "c.csv", 2000)
    drop = latest_drop(spark, str(tmp_path), manifest="manifest")
    assert drop.path.endswith("/second") and names(drop) == ["a.csv", "b.csv", "c.csv"]


def test_ingest_a_drop_of_many_files(spark, tmp_path):
    schema = T.StructType().add("IDVente", T.IntegerType()).add("Total", T.DoubleType())
    for i in range(4):
        put(tmp_path / "in" / "d", f"p{i}.csv", 1000, f"IDVente,Total\n{i},1.5\n{i},2\n")
    (tmp_path / "in" / "d" / "_SUCCESS").touch()
    topic = Topic.files("t", str(tmp_path / "t"))
    row = ingest_latest_file(spark, str(tmp_path / "in"), topic, schema).first()
    assert (row.path.rpartition("/")[2], row.files, row.rows) == ("d", 4, 8)
    assert read_topic(spark, topic).count() == 8
