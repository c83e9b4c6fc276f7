"""Runs every registered query and its SQL on the same tables and compares the rows."""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def rows_of(names, rows) -> tuple[list[str], list[tuple]]:
    """Columns by name, rows in a canonical order; floats by their exact text."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    cells = [tuple(repr(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(cells)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cur = con.execute(sql)
    return rows_of([d[0] for d in cur.description], cur.fetchall())


def difference(spark, con, sf, fn, sql) -> str | None:
    cols, got = spark_rows(fn(spark, sf))
    want_cols, want = sql_rows(con, sql)
    if cols != want_cols:
        return f"columns {cols} != {want_cols}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:2]
        missing = [r for r in want if r not in set(got)][:2]
        return f"{len(got)} rows, want {len(want)}; extra {extra}; missing {missing}"
    return None


if __name__ == "__main__":
    from tests.conftest import make_session

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    session, con = make_session(), connect(sf)
    oracles = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        began = time.time()
        try:
            fault = difference(session, con, sf, fn, oracles[name])
        except Exception as e:  # report and go on with the next query
            fault = f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{'ok  ' if fault is None else 'FAIL'} {name} {time.time() - began:.2f}s", fault or "")
