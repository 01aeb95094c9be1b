"""Latest rows per series, and ordered pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def latest_n(
    df: DataFrame, series: list[str], period: str, n: int | None, tie_break: list[str] | None = None
) -> DataFrame:
    """The last ``n`` rows of each series by period; ``None`` keeps all.

    Rows are counted by series and period, which folds them in the map tasks. Of
    those counts a running sum from the newest period on finds the period in
    which the n-th row lies: newer rows stay without being ranked, and only rows
    of that period are. So a series that holds much of the table is never sorted
    by one task, whatever ``n``. Missing periods are the oldest.

    Rows of one period are ordered by ``tie_break``, without it by all other
    columns that have an order; which of rows equal in those stays is left open.
    """
    if n is None:
        return df
    ordered = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType)) and f.name not in (*series, period)]
    ties = [F.asc(f"`{c}`") for c in tie_break or ordered] or [F.lit(0)]
    newest = Window.partitionBy(*series).orderBy(F.col(period).desc_nulls_last())
    counts = df.groupBy(*series, period).agg(F.count(F.lit(1)).alias("_n"))
    # n periods have n rows at least
    counts = counts.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= n)
    before = F.coalesce(F.sum("_n").over(newest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cuts = counts.withColumn("_before", before).where((F.col("_before") < n) & (F.col("_before") + F.col("_n") >= n)).select(
        *[F.col(c).alias(f"_series{i}") for i, c in enumerate(series)], F.col(period).alias("_cut"), (n - F.col("_before")).alias("_need")
    )
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_series{i}")) for i, c in enumerate(series)])
    at = F.col(period)
    newer = F.col("_need").isNull() | (at > F.col("_cut")) | (F.col("_cut").isNull() & at.isNotNull())
    kept = df.join(cuts, same, "left").where(newer).select(*df.columns)
    tied = df.join(cuts, same & at.eqNullSafe(F.col("_cut")))
    rank = F.row_number().over(Window.partitionBy(*series).orderBy(*ties))
    tied = tied.withColumn("_rank", rank).where((F.col("_rank") <= n) & (F.col("_rank") <= F.col("_need")))
    return kept.unionByName(tied.select(*df.columns))


def page(
    df: DataFrame, order: list[Column | str], top: int, max_pages: int = 1, skip: int = 0
) -> DataFrame:
    """At most ``top * max_pages`` rows in order, after ``skip``.

    End ``order`` with a unique column: a page is only defined by a total order.
    """
    return df.orderBy(*order).offset(skip).limit(top * max_pages)
