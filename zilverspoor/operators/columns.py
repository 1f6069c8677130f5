"""Column naming and projection rules of the bronze and silver layers."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class NameCollision(ValueError):
    """Two columns would end up with the same name."""


class MissingSource(KeyError):
    """A table, or a column a mapping needs, is not in bronze."""

    def __str__(self) -> str:
        return str(self.args[0]) if self.args else ""


def _rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    twice = sorted(n for n, times in Counter(n.lower() for n in names).items() if times > 1)
    if twice:
        raise NameCollision(f"column names differ only in case: {twice}")
    return df.toDF(*names)


def lower_columns(df: DataFrame) -> DataFrame:
    """Bronze convention: all column names in lower case."""
    return _rename_all(df, [c.lower() for c in df.columns])


def coerce_labels(df: DataFrame, case: str = "none") -> DataFrame:
    """Output labels in upper or lower case, or as they are."""
    change = {"upper": str.upper, "lower": str.lower, "none": str}
    if case not in change:
        raise ValueError(f"label case must be one of {sorted(change)}")
    return _rename_all(df, [change[case](c) for c in df.columns])


def typed_null(data_type: str) -> Column:
    """A NULL that already has its column's type, so unions and writes accept it."""
    return F.lit(None).cast(data_type)


def project(
    df: DataFrame,
    renames: Mapping[str, str],
    nulls: Mapping[str, str] | None = None,
    constants: Mapping[str, object] | None = None,
) -> DataFrame:
    """Select ``target <- source`` columns, then typed NULLs, then constants."""
    return df.select(
        *[F.col(source).alias(target) for target, source in renames.items()],
        *[typed_null(kind).alias(target) for target, kind in (nulls or {}).items()],
        *[F.lit(value).alias(target) for target, value in (constants or {}).items()],
    )


def _candidates(name: str, prefer: str | None) -> list[str]:
    order = {"upper": [name.upper(), name], "lower": [name.lower(), name.upper()]}
    return list(dict.fromkeys(order.get(prefer or "", [name, name.upper()])))


def resolve_table(
    tables: Mapping[str, DataFrame],
    name: str,
    required: Iterable[str] = (),
    matching: str = "auto",
    prefer: str | None = None,
) -> DataFrame:
    """The case variant of a table that has all required columns.

    Preferred spellings are tried first; ``strict`` tries nothing else. Variants
    that lack a required column are passed over.
    """
    names = [n for n in _candidates(name, prefer) if n in tables]
    if matching != "strict":
        names += [n for n in tables if n.lower() == name.lower() and n not in names]
    if not names:
        raise MissingSource(f"table {name} not found")
    wanted = {c.lower() for c in required}
    for candidate in names:
        if wanted <= {c.lower() for c in tables[candidate].columns}:
            return tables[candidate]
    missing = sorted(wanted - {c.lower() for c in tables[names[0]].columns})
    raise MissingSource(f"table {name} lacks required columns {missing}")


def resolve_columns(
    df: DataFrame, wanted: Sequence[str], matching: str = "auto", prefer: str | None = None
) -> DataFrame:
    """The wanted columns under their lower-case names, however the source spells them."""
    picked = []
    for name in wanted:
        options = [c for c in _candidates(name, prefer) if c in df.columns]
        if matching != "strict":
            options += [c for c in df.columns if c.lower() == name.lower() and c not in options]
        if not options:
            raise MissingSource(f"column {name} not found")
        # by position: two spellings of one name are ambiguous to the analyzer
        picked.append(df.columns.index(options[0]))
    slots = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return slots.select(*[F.col(f"c{i}").alias(n.lower()) for i, n in zip(picked, wanted)])
