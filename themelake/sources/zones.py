"""Polygon zones from GeoJSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geometry import geojson_rings
from ..operators.columns import evaluated
from .paged_json import read_paged_json

# Coordinates nest one level deeper in a multipolygon, so they come in as text.
FEATURE = "properties map<string,string>, geometry struct<type:string,coordinates:string>"


def features_to_zones(features: DataFrame, properties: dict[str, str] | list[str]) -> DataFrame:
    """One row per feature: the named properties and ``rings``."""
    names = properties if isinstance(properties, dict) else {p: p for p in properties}
    return evaluated(features, "geometry").where("geometry.type IN ('Polygon', 'MultiPolygon') AND geometry.coordinates IS NOT NULL").select(
        *[F.try_element_at("properties", F.lit(p)).alias(out) for p, out in names.items()],
        geojson_rings("geometry").alias("rings"),
    )


def read_zones(
    spark: SparkSession,
    path: str | list[str],
    properties: dict[str, str] | list[str],
    one_feature_per_line: bool = False,
) -> DataFrame:
    """Zones of a feature collection, or of features landed one per line."""
    if one_feature_per_line:
        features = spark.read.schema(T.StructType.fromDDL(FEATURE)).json(path)
    else:
        features = read_paged_json(spark, path, FEATURE, items="features")
    return features_to_zones(features, properties)
