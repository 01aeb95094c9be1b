"""Aggregations, pivots, unions and counts."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _present(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with all keys; a missing key forms no group."""
    return df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def _numbers(df: DataFrame) -> DataFrame:
    """NaN as null, as a missing reading must not spoil a mean."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(f"`{c}`"), F.lit(None)) for c in floats}) if floats else df


def collapse(df: DataFrame, keys: list[str], label: str, order_col: str) -> DataFrame:
    """One row per key: mean of each other number column, first non-null label.

    "First" is by ``order_col``, a missing one being the last; a NaN is a missing
    number. Two aggregations: the first is per key and label with number
    buffers only, a hash aggregation in which nearly all rows fold before the
    shuffle; the second picks among the labels of a key, and sorts what the
    first has left. A label kept in the first buffer would make Spark sort all
    rows instead.
    """
    numbers = [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in keys and f.name != order_col
    ]
    df = _numbers(df)
    if label in keys:
        return _present(df, keys).groupBy(*keys).agg(*[F.avg(c).alias(c) for c in numbers])
    by_label = (
        _present(df, keys).groupBy(*keys, label)
        .agg(
            F.min(order_col).alias("_order"),
            *[F.sum(F.col(c).cast("double")).alias(f"_sum_{c}") for c in numbers],
            *[F.count(c).alias(f"_count_{c}") for c in numbers],
        )
    )
    order = F.struct(F.col("_order").isNull(), "_order")
    first_label = F.min_by(label, F.when(F.col(label).isNotNull(), order))
    means = [
        F.try_divide(F.sum(f"_sum_{c}"), F.sum(f"_count_{c}")).alias(c) for c in numbers
    ]
    return by_label.groupBy(*keys).agg(*means, first_label.alias(label))


def pivot_mean(
    df: DataFrame, index: list[str], column: str, value: str, categories: list[str], names: dict[str, str]
) -> DataFrame:
    """One row per index, one mean per category; rows without any mean are dropped.

    Conditional means instead of ``pivot``: one shuffle, not two.
    """
    means = [
        F.avg(F.when(F.col(column) == c, F.col(value))).alias(names.get(c, c)) for c in categories
    ]
    known = _present(_numbers(df), index).where(F.col(column).isin(categories))
    return known.groupBy(*index).agg(*means).dropna("all", subset=[names.get(c, c) for c in categories])


def count_distinct(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """Number of different non-missing values, as one row."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(count(F.col(column)).alias("distinct_values"))


def counts(df: DataFrame, top: int | None = None, max_pages: int = 1) -> DataFrame:
    """All rows, and how many of them a capped page set holds."""
    total = F.count(F.lit(1))
    capped = total if top is None else F.least(total, F.lit(top * max_pages).cast("bigint"))
    return df.agg(total.alias("total"), capped.alias("returned"))


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """The different non-missing values in order, as rows."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def stack(frames: Iterable[DataFrame]) -> DataFrame | None:
    """Rows of all frames by column name, duplicates kept; none gives ``None``."""
    frames = list(frames)
    if not frames:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
