from tillflow.operators.aggregates import (
    group_stats,
    group_stats_each,
    group_totals,
    limit_rows,
    row_count,
    top_k,
)
from tillflow.operators.filters import filter_header_row, filter_nonempty, filter_threshold
from tillflow.operators.messages import big_sale_alert, category_message, city_message
from tillflow.operators.projections import expand_struct, rename_by_name, rename_by_position
from tillflow.plans.batch import clean_sales
from tillflow.schemas import SALE_FIELDS, SALE_RAW, SALE_TABLE


def rule_sales(n=120):
    """Sales by rule, each with Total = quantity * price * (1 - discount)."""
    rows = []
    for i in range(n):
        quantity, price, discount = i % 9 + 1, 23 + 7 * i % 474, (i % 5) * 5
        total = quantity * price * (100 - discount) / 100
        rows.append((
            str(i), f"2024-{i % 12 + 1:02}-{i % 28 + 1:02}", f"P{i % 7}", f"C{i % 4}",
            str(quantity), str(price), f"client {i}", f"ville {i % 50}", "FR",
            str(discount / 100), "CB", str(total),
        ))
    return rows


def test_turnover_of_cleaned_text(spark):
    rows = rule_sales()
    clean = clean_sales(spark.createDataFrame(rows, SALE_RAW))
    assert clean.columns == SALE_TABLE.names
    assert clean.filter(" OR ".join(f"{c} IS NULL" for c in clean.columns)).count() == 0
    off = "abs(total - quantite * prixUnitaire * (1 - remise)) > 1e-9"
    assert clean.filter(off).count() == 0
    want = {}
    for r in rows:
        want.setdefault(r[7], []).append(float(r[11]))
    got = {r.ville: r for r in group_stats(clean, "ville", "total").collect()}
    assert {k: (r.n, round(r.total, 2)) for k, r in got.items()} == {
        k: (len(v), round(sum(v), 2)) for k, v in want.items()
    }
    best = sorted(((round(sum(v), 2), k) for k, v in want.items()), key=lambda x: (-x[0], x[1]))
    top = top_k(group_totals(clean, "ville", "total", "decimal(18,2)"), "ville")
    assert [(float(r.total), r.ville) for r in top.collect()] == best[:5]


def test_top_k_keeps_k_rows_per_task(spark):
    plan = top_k(spark.range(100).selectExpr("id AS Ville", "id AS total"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in text


def test_counts_and_limits(spark):
    assert row_count(spark.range(7)).first().n == 7
    assert [r.id for r in limit_rows(spark.range(9), "id").collect()] == [0, 1, 2, 3, 4]
    assert limit_rows(spark.range(3), "id", 10).count() == 3


def test_mean_counts_every_row(spark):
    df = spark.createDataFrame([("a", 3.0), ("a", None), (None, 1.0)], "Categorie string, Total double")
    got = {r.Categorie: (r.n, r.total, r.mean) for r in group_stats(df).collect()}
    assert got == {"a": (2, 3.0, 1.5), None: (1, 1.0, 1.0)}


def test_threshold_is_strict_and_no_nan(spark):
    values = [1000.0, 1000.01, float("nan"), None, float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "Total double")
    assert [r.Total for r in filter_threshold(df).collect()] == [1000.01, float("inf")]


def test_threshold_reaches_the_scan(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "x", 5)], "Total double, s string, n int")
    df.write.parquet(str(tmp_path / "t"))
    plan = filter_threshold(spark.read.parquet(str(tmp_path / "t"))).select("n")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(Total,1000.0)" in text
    assert "ReadSchema: struct<Total:double,n:int>" in text


def test_header_and_empty_rows(spark):
    df = spark.createDataFrame([("IDVente",), ("1",), (None,), ("",)], "_c0 string")
    assert [r[0] for r in filter_header_row(df).collect()] == ["1", ""]
    assert [r[0] for r in filter_nonempty(df, "_c0").collect()] == ["IDVente", "1"]


def test_renames(spark):
    df = spark.createDataFrame([tuple("abcdefghijkl")], [f"_c{i}" for i in range(12)])
    named = rename_by_position(df)
    assert named.columns == list(SALE_FIELDS)
    assert rename_by_name(named).columns == [
        "id", "dateVente", "produit", "Categorie", "quantite", "prixUnitaire", "client",
        "ville", "Pays", "remise", "moyenPaiement", "total",
    ]


def test_null_struct_is_a_row_of_nulls(spark):
    df = spark.createDataFrame([((1, "a"),), (None,)], "data struct<x int, y string>")
    assert sorted(map(repr, map(tuple, expand_struct(df).collect()))) == ["(1, 'a')", "(None, None)"]


def test_message_texts(spark):
    stats = spark.createDataFrame(
        [("Déco", 2, 2.675, 0.125)], "Categorie string, n long, total double, mean double"
    )
    assert category_message(stats).first().message == "📊 Déco: 2 ventes, CA: 2.68€, Moyenne: 0.13€"
    city = spark.createDataFrame([("Lyon", 12345678.5)], "Ville string, total double")
    assert city_message(city).first().message == "🏙️  Lyon: 12345678.50€"
    sale = spark.createDataFrame([("Lit", 1e7, "Ann")], "Produit string, Total double, Client string")
    assert big_sale_alert(sale).first().message == "🚨 GROSSE VENTE! Lit - 1.0E7€ - Ann"


def test_each_key_in_one_pass(spark):
    rows = [("a", 1, 1.0), ("a", None, 2.0), (None, 1, 4.0), (None, None, 8.0), ("b", 2, 16.0)]
    df = spark.createDataFrame(rows, "x string, y int, Total double")
    got = group_stats_each(df, ["x", "y"])
    want = [
        (by, *row)
        for by in ("x", "y")
        for row in group_stats(df, by).withColumn(by, df[by].cast("string")).collect()
    ]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want)))
