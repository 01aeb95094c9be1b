"""Catalogue products by collection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import LEAD_COLUMNS, SENTINEL_1, SENTINEL_1_COLUMNS, SENTINEL_2, SENTINEL_2_COLUMNS
from ..functions import attr, fallback, geojson_text, identifier, instant, json_text, level
from .columns import flatten, keep, lead_columns

COLLECTION_OF = {"sentinel1": SENTINEL_1, "sentinel2": SENTINEL_2}
COLUMNS_OF = {"sentinel1": SENTINEL_1_COLUMNS, "sentinel2": SENTINEL_2_COLUMNS}


def product_columns(df: DataFrame, theme: str) -> DataFrame:
    """The product columns of one collection, plus ``collection`` itself.

    The footprint is taken as JSON from the nested column, before anything
    flattens it.
    """
    if theme not in COLUMNS_OF:
        raise ValueError(f"unknown product theme {theme!r}; known: {', '.join(COLUMNS_OF)}")
    has = set(df.columns)
    attrs = F.col("Attributes") if "Attributes" in has else None
    missing = F.lit(None).cast("string")

    def attribute(key: str):
        return missing if attrs is None else attr(attrs, key)

    own_cover = F.col("CloudCover").cast("double") if "CloudCover" in has else F.lit(None).cast("double")
    shaped = df.withColumns(
        {
            "identifier": identifier("Name", "Id"),
            "content_start": instant("ContentDate.Start"),
            "cloudcover": fallback(own_cover, attribute("cloud").try_cast("double")),
            "polarizations": attribute("polar"),
            "footprint": geojson_text("GeoFootprint") if "GeoFootprint" in has else missing,
            "product_level": level("Name"),
            "s3_asset": json_text("Assets") if "Assets" in has else missing,
            "collection": F.lit(COLLECTION_OF[theme]),
        }
    )
    return keep(shaped, ["collection", *COLUMNS_OF[theme]])


def flat_products(df: DataFrame, sep: str = ".") -> DataFrame:
    """All catalogue fields as flat columns, usual ones first, with identifier and start instant."""
    return lead_columns(
        flatten(df, sep).withColumns(
            {"identifier": identifier("Name", "Id"), "content_start": instant(f"`ContentDate{sep}Start`")}
        ),
        [c.replace(".", sep) for c in LEAD_COLUMNS],
    )
