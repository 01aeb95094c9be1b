"""Equi-joins with small or large dimensions.

No hints: Spark broadcasts a dimension below its own size threshold and joins
by shuffle above it, where adaptive execution splits the partition of a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import normalise


def join(df: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join by name."""
    return df.join(right, keys, how)


def _dictionary(dim: DataFrame, key: str, value: str, normalised: bool) -> DataFrame:
    """One row per key, so that the join cannot add rows."""
    name = normalise(key) if normalised else F.col(key)
    return (
        dim.select(name.alias("_key"), F.col(value).alias("_value"))
        .where(F.col("_key").isNotNull())
        .groupBy("_key").agg(F.min("_value").alias("_value"))
    )


def lookup(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    value: str,
    default: str,
    dim_key: str | None = None,
    out: str | None = None,
    normalised: bool = True,
) -> DataFrame:
    """``value`` of the dimension for each row's key, ``default`` where there is none.

    Both sides are normalised, so an accented dictionary key still matches.
    """
    names = _dictionary(dim, dim_key or key, value, normalised)
    own = normalise(key) if normalised else F.col(key)
    return (
        df.withColumn("_key", own)
        .join(names, "_key", "left")
        .withColumn(out or value, F.coalesce("_value", F.lit(default)))
        .drop("_key", "_value")
    )


def unmatched(
    df: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None, normalised: bool = True
) -> DataFrame:
    """Rows the lookup does not cover."""
    own = normalise(key) if normalised else F.col(key)
    other = normalise(dim_key or key) if normalised else F.col(dim_key or key)
    names = dim.select(other.alias("_key")).distinct()
    return df.withColumn("_key", own).join(names, "_key", "left_anti").drop("_key")
