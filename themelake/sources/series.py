"""Nested series: one row per entity and observation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import SERIES_DEFAULTS


def last_periods(df: DataFrame, n: int, items: str = "Data", period: str = "Anyo") -> DataFrame:
    """Each entity's series cut to its last ``n`` periods, with or without values."""
    pairs = F.transform(items, lambda x: F.struct(x[period].alias("p"), x.alias("x")))
    newest = F.transform(F.slice(F.sort_array(pairs, asc=False), 1, n), lambda s: s["x"])
    return df.withColumn(items, newest)


def explode_series(
    df: DataFrame,
    items: str = "Data",
    fields: dict[str, str] | None = None,
    defaults: dict[str, str] = SERIES_DEFAULTS,
    period: str = "Anyo",
    value: str = "Valor",
) -> DataFrame:
    """Entity fields repeated for each observation that has a value.

    ``fields`` maps source names to output names; an absent one takes its
    default. An absent or empty series gives no row.
    """
    fields = fields or {"CODPROV": "cod_prov", "CODMUNI": "cod_muni", "Nombre": "municipio"}
    entity = [
        F.coalesce(F.col(source), F.lit(defaults[source])).alias(out) if source in defaults
        else F.col(source).alias(out)
        for source, out in fields.items()
    ]
    rows = df.select(*entity, F.explode(items).alias("obs"))
    return rows.where(F.col(f"obs.{value}").isNotNull()).select(
        *fields.values(),
        F.col(f"obs.{period}").alias("year"),
        F.col(f"obs.{value}").alias("population"),
    )
