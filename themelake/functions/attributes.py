"""Open attribute lists and fallback chains.

An attribute is a map (or struct) with a ``Name`` and a value under one of
several keys. Maps keep ``Value`` and ``value`` apart whatever
``spark.sql.caseSensitive`` says, so the readers use them.

The chains test for null, not for falsy values: cloud cover 0, latitude 0 and
the empty string are values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import ATTRIBUTE_VALUE_FIELDS
from .text import _col


def attr(attrs: Column | str, key: str, value_fields: list[str] = ATTRIBUTE_VALUE_FIELDS) -> Column:
    """Value of the first attribute whose name contains ``key``, any case."""
    named = F.filter(_col(attrs), lambda a: F.lower(a["Name"]).contains(key.lower()))
    first = F.get(named, F.lit(0))
    return F.coalesce(*[first[f] for f in value_fields])


def any_attr_le(attrs: Column | str, name: str, limit: int, value_field: str = "Value") -> Column:
    """True if an attribute of exactly that name has a value up to ``limit``."""
    hit = F.exists(
        _col(attrs),
        lambda a: (a["Name"] == name) & (a[value_field].try_cast("double") <= limit),
    )
    return F.coalesce(hit, F.lit(False))


def fallback(primary: Column | str, *others: Column | str) -> Column:
    """First non-null value, decided row by row."""
    return F.coalesce(_col(primary), *[_col(o) for o in others])


def center_or_point(own: Column | str, center: Column | str) -> Column:
    """An element's own coordinate, else that of its center."""
    return fallback(own, center)


def tagged_as(kind: Column | str, tags: Column | str, rules: list[tuple[str, str, str]]) -> Column:
    """True where one (kind, tag, value) rule holds."""
    tests = [
        (_col(kind) == k) & (F.try_element_at(_col(tags), F.lit(tag)) == value)
        for k, tag, value in rules
    ]
    return reduce(lambda a, b: a | b, tests)
