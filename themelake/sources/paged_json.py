"""Item rows out of landed API pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def struct_of(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_paged_json(
    spark: SparkSession,
    path: str | list[str],
    item_schema: str | T.StructType,
    items: str = "value",
    one_page_per_line: bool = False,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Every item of every page under ``path``; a page without items adds none.

    A page that is cut off or not JSON stops the job; ``mode="PERMISSIVE"`` reads
    it as a page without items.

    A page that spans lines is one unsplittable record of bounded size, and many
    pages share a task. Land pages one per line where files are large, and set
    ``one_page_per_line`` so that Spark splits the files.
    """
    page = T.StructType([T.StructField(items, T.ArrayType(struct_of(item_schema)))])
    pages = spark.read.schema(page).option("multiLine", not one_page_per_line).option("mode", mode).json(path)
    return pages.select(F.inline(F.col(items)))
