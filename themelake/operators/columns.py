"""Projections that depend on the schema only."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import LEAD_COLUMNS


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def _leaves(field: T.StructField, parent: Column, name: str, sep: str) -> Iterator[Column]:
    if isinstance(field.dataType, T.StructType):
        for child in field.dataType.fields:
            yield from _leaves(child, parent[child.name], f"{name}{sep}{child.name}", sep)
    else:
        yield parent.alias(name)


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested objects become ``a.b`` columns at any depth; arrays stay arrays."""
    return df.select(
        *[leaf for f in df.schema.fields for leaf in _leaves(f, _quoted(f.name), f.name, sep)]
    )


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Further columns, each computed once per row.

    Filters on them are not pushed below a generator, so they read the computed
    column where they would otherwise repeat its expression.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def evaluated(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with the named columns computed here, once per row, and put last.

    Expressions further up read the value; they would otherwise each repeat what
    it was computed from, until generated code grows too large to be compiled.
    """
    others = [_quoted(c) for c in df.columns if c not in names]
    return df.select(*others, F.inline(F.array(F.struct(*[_quoted(n) for n in names]))))


def lead_columns(df: DataFrame, names: Iterable[str] = LEAD_COLUMNS) -> DataFrame:
    """The listed columns that exist come first, the others follow in order."""
    first = [c for c in names if c in df.columns]
    return df.select(*[_quoted(c) for c in first + [c for c in df.columns if c not in first]])


def keep(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Projection that skips names the table does not have."""
    return df.select(*[_quoted(c) for c in names if c in df.columns])


def standardise_names(df: DataFrame, mapping: dict[str, str], date_like: str = "DATE") -> DataFrame:
    """Fixed renames; without a ``date`` column the first date-like one becomes it."""
    df = df.withColumnsRenamed(mapping)
    if "date" not in df.columns:
        named = next((c for c in df.columns if date_like in c.upper()), None)
        if named is not None:
            df = df.withColumnRenamed(named, "date")
    return df
