import pytest
from pyspark.sql import functions as F

from zilverspoor.operators.columns import (
    MissingSource,
    NameCollision,
    coerce_labels,
    lower_columns,
    project,
    resolve_columns,
    resolve_table,
)


def frame(spark, *names):
    return spark.range(1).select(*[F.lit(i).alias(n) for i, n in enumerate(names)])


def test_lower_columns(spark):
    assert lower_columns(frame(spark, "A", "bC")).columns == ["a", "bc"]
    with pytest.raises(NameCollision):
        lower_columns(frame(spark, "A", "a"))


def test_coerce_labels(spark):
    assert coerce_labels(frame(spark, "Ab"), "upper").columns == ["AB"]
    assert coerce_labels(frame(spark, "Ab")).columns == ["Ab"]
    with pytest.raises(ValueError):
        coerce_labels(frame(spark, "Ab"), "title")


def test_project_order_and_types(spark):
    df = project(frame(spark, "a"), {"X": "a"}, {"D": "date"}, {"C": "k"})
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [
        ("X", "int"),
        ("D", "date"),
        ("C", "string"),
    ]


def test_variant_with_the_required_columns_wins(spark):
    tables = {"wvbesl": frame(spark, "besluitnr"), "WVBESL": frame(spark, "BESLUITNR", "CLIENTNR")}
    assert resolve_table(tables, "wvbesl", ["besluitnr", "clientnr"]) is tables["WVBESL"]
    assert resolve_table(tables, "wvbesl", ["besluitnr"]) is tables["wvbesl"]
    assert resolve_table(tables, "wvbesl", ["besluitnr"], prefer="upper") is tables["WVBESL"]


def test_matching_modes(spark):
    tables = {"WvBesl": frame(spark, "x")}
    assert resolve_table(tables, "wvbesl") is tables["WvBesl"]
    with pytest.raises(MissingSource, match="not found"):
        resolve_table(tables, "wvbesl", matching="strict")
    with pytest.raises(MissingSource, match=r"lacks required columns \['y'\]"):
        resolve_table(tables, "wvbesl", ["x", "y"])


def test_resolve_columns(spark):
    df = resolve_columns(frame(spark, "A", "a", "Bb"), ["a", "bb"])
    assert df.columns == ["a", "bb"]
    assert df.first() == (1, 2)
    assert resolve_columns(frame(spark, "A", "a"), ["a"], prefer="upper").first() == (0,)
    with pytest.raises(MissingSource):
        resolve_columns(frame(spark, "Bb"), ["bb"], matching="strict")
