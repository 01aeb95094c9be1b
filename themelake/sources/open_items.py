"""Items of API pages whose fields are not known before.

An item is a VARIANT: it keeps every field, whatever its type in other items.
One aggregation over the items finds the fields there are; the table is then
flat, a column for every scalar at any depth.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.columns import _quoted

# More fields than this mean that keys are data, as in a map of ids; such items need a schema.
MAX_FIELDS = 2000


def read_open_items(
    spark: SparkSession, path: str | list[str], items: str = "value", one_page_per_line: bool = False, mode: str = "FAILFAST"
) -> DataFrame:
    """Every item of every page as a VARIANT column ``item``; a page without items adds none.

    Pages, torn pages and ``mode`` are as in :func:`read_paged_json`.
    """
    pages = (
        spark.read.option("singleVariantColumn", "page").option("multiLine", not one_page_per_line).option("mode", mode).json(path)
    )
    listed = F.try_variant_get("page", _path([items]), "array<variant>")
    return pages.select(F.explode(listed).alias("item"))


def _path(names: list[str]) -> str:
    """JSON path of a field; names with quotes of both kinds cannot be written."""
    return "$" + "".join(f"['{n}']" if "'" not in n else f'["{n}"]' for n in names)


def item_fields(items: DataFrame, item: str = "item") -> T.StructType:
    """The fields of all items, nested, with types that hold every value.

    One aggregation, one text back, whose length grows with the number of
    different fields and not with the items. A field that is an object in one
    item and something else in another is a VARIANT; so is one of mixed scalars.
    """
    text = items.agg(F.schema_of_variant_agg(item)).first()[0]
    # the text names structs OBJECT; names that need it stand in backticks
    ddl = re.sub(r"(`(?:[^`]|``)*`)|\bOBJECT<", lambda m: m[1] or "STRUCT<", text)
    kind = T.StructType.fromDDL(f"item {ddl}")["item"].dataType if ddl != "VOID" else T.StructType()
    if not isinstance(kind, T.StructType):
        raise ValueError(f"items are not objects but {text}")
    return kind


def _leaves(kind: T.StructType, path: list[str]) -> Iterator[tuple[list[str], T.DataType]]:
    for field in kind.fields:
        if isinstance(field.dataType, T.StructType) and field.dataType.fields:
            yield from _leaves(field.dataType, [*path, field.name])
        else:
            yield [*path, field.name], field.dataType


def _scalar(kind: T.DataType) -> str | None:
    if isinstance(kind, (T.DecimalType, T.DoubleType, T.FloatType)):
        return "double"
    if isinstance(kind, (T.LongType, T.StringType, T.BooleanType)):
        return kind.simpleString()
    return "string" if isinstance(kind, T.NullType) else None


def flatten_open(items: DataFrame, sep: str = ".", item: str = "item", fields: T.StructType | None = None, max_fields: int = MAX_FIELDS) -> DataFrame:
    """Open items as flat columns in order of their names: ``a.b`` for nested fields, an absent one null.

    Whole numbers are bigint, others double, mixed ones and arrays stay VARIANT.
    A name that another one equals but for its case gets a number. Pass
    ``fields`` to fix the columns beforehand, for pages that arrive in turns; the
    items are then not read to find them.
    """
    leaves = list(_leaves(item_fields(items, item) if fields is None else fields, []))
    if len(leaves) > max_fields:
        raise ValueError(f"{len(leaves)} different fields, more than {max_fields}; give a schema")
    columns: list[Column] = []
    taken: set[str] = set()
    for path, kind in leaves:
        name, k = sep.join(path), 1
        while name.lower() in taken:
            k += 1
            name = f"{sep.join(path)}{sep}{k}"
        taken.add(name.lower())
        columns.append(F.try_variant_get(item, _path(path), _scalar(kind) or "variant").alias(name))
    return items.select(*[_quoted(c) for c in items.columns if c != item], *columns)
