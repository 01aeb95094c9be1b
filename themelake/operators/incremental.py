"""Keeping a keyed table complete: what to fetch again, and the upsert."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .filters import complete


def restrict(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is among ``keys``.

    Repeats of a key fold before they are sent anywhere.
    """
    return df.join(keys.select(*on).distinct(), on, "left_semi")


def needs_refresh(targets: DataFrame, store: DataFrame, on: list[str], required: dict[str, str]) -> DataFrame:
    """Target keys with no stored row, or with a stored row that lacks a value.

    The store is cut down to the targets first: few keys go out to it, and it is
    not shuffled.
    """
    stored = complete(restrict(store, targets, on), required)
    return targets.join(stored.select(*on), on, "left_anti")


def latest_per_key(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """The row with the greatest ``order_col`` for each key, a missing one being the least.

    The group limit keeps one row per key and map task before the shuffle, so a
    key that holds much of the batch stays small.
    """
    newest = Window.partitionBy(*keys).orderBy(F.col(order_col).desc_nulls_last())
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def upsert(base: DataFrame, updates: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """``base`` with the rows of ``updates`` inserted or put in place by key.

    All non-key columns are replaced. Of several updates for a key the last by
    ``order_col`` wins; that column is dropped unless the table has it. A key is
    in ``base`` once. Either side is read once and shuffled once: the batch meets
    the table where it was folded. Cut ``base`` to what the batch may touch first,
    as :func:`upsert_table` does.
    """
    new = latest_per_key(updates, keys, order_col).select(*[F.col(c).alias(f"_new_{c}") for c in base.columns], F.lit(True).alias("_hit"))
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_new_{k}") for k in keys])
    return base.join(new, same, "full").select(*[F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in base.columns])
