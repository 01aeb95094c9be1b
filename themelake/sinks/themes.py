"""One folder per theme, one dataset per name, replaced as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import THEME_DIRS
from ..functions.text import json_text


def theme_path(theme: str, name: str, base: str) -> str:
    if theme not in THEME_DIRS:
        raise ValueError(f"unknown theme {theme!r}; known: {', '.join(THEME_DIRS)}")
    return f"{base.rstrip('/')}/{THEME_DIRS[theme]}/{name}"


def nested_as_json(df: DataFrame) -> DataFrame:
    """Maps, arrays, structs and variants as JSON text, the rest as it is."""
    nested = (T.MapType, T.ArrayType, T.StructType, T.VariantType)
    return df.select(
        *[
            json_text(F.col(f"`{f.name}`"), empty_as_null=False).alias(f.name)
            if isinstance(f.dataType, nested) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def save_theme(df: DataFrame, theme: str, name: str, base: str, fmt: str = "csv") -> str:
    """Write ``<base>/<theme>/<name>`` as a folder of part files; returns the path.

    CSV for exchange (header, no index, nested values as JSON, text untrimmed),
    Parquet for everything read again by Spark.
    """
    path = theme_path(theme, name, base)
    if fmt == "csv":
        (
            nested_as_json(df).write.mode("overwrite")
            .option("header", True)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(path)
        )
    elif fmt == "parquet":
        df.write.mode("overwrite").parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}; known: csv, parquet")
    return path


def save_theme_json(df: DataFrame, theme: str, name: str, base: str) -> str:
    """The same in JSON, one object per line, non-ASCII text as it is, missing values as null."""
    path = theme_path(theme, name, base)
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path
