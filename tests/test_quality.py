from decimal import Decimal

from zilverspoor.operators.quality import (
    enum_violations,
    fk_orphans,
    pk_violations,
    reconcile_counts,
    reconcile_values,
)


def test_pk_violations(spark, rows):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, None), (3, 1)], "a int, b int")
    assert rows(pk_violations(df, ["a", "b"])) == [(1, 1, 2), (2, None, 1)]


def test_fk_orphans_ignore_null(spark, rows):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "p int")
    parent = spark.createDataFrame([(1,), (None,)], "id int")
    assert rows(fk_orphans(child, ["p"], parent, ["id"])) == [(2, 2)]
    assert rows(enum_violations(child, "p", parent, "id")) == [(2, 2)]


def test_reconcile_counts(spark, rows):
    a, b = spark.range(3), spark.range(2)
    assert rows(reconcile_counts({"x": a, "y": a}, {"x": a, "y": b})) == [
        ("x", 3, 3, True),
        ("y", 3, 2, False),
    ]


def test_reconcile_values_counts_copies(spark, rows):
    left = spark.createDataFrame([(Decimal("1.000001"), "a"), (Decimal("1.000001"), "a")], "n decimal(9,6), t string")
    right = spark.createDataFrame([(Decimal("1.000002"), "a")], "n decimal(9,6), t string")
    assert [r[2:] for r in rows(reconcile_values(left, right))] == [(2, 1)]
    assert rows(reconcile_values(left, left)) == []
