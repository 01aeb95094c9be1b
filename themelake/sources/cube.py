"""Sparse statistics cubes: flat index -> number, plus dimension labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import _col
from ..operators.columns import computed_once


def read_cube(spark: SparkSession, path: str | list[str], order: Sequence[str]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Cells and dimension tables of landed cube documents, see :func:`split_cube`."""
    docs = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("doc"), F.col("value").alias("text")
    )
    return split_cube(docs, order)


def split_cube(docs: DataFrame, order: Sequence[str], text: str = "text", doc: str = "doc") -> tuple[DataFrame, dict[str, DataFrame]]:
    """Long form of cube documents.

    ``order`` names the dimensions, the last varies fastest. Returns the cells
    (doc, one position per dimension, value; ``in_range`` is false for an index
    past the axes) and one table per dimension (doc, position, code, label).
    A value that is no number, as a text that marks a gap, is a cell with null.
    Codes keep their order in the text, which a parsed map would not.
    """

    def labels(dim: str):
        return F.get_json_object(_col(text), f"$.dimension.{dim}.category.label")

    sized = docs.select(
        doc,
        *[F.size(F.json_object_keys(labels(d))).cast("bigint").alias(f"n_{d}") for d in order],
        F.explode(
            F.from_json(F.get_json_object(_col(text), "$.value"), "map<string,string>")
        ).alias("flat", "value"),
    ).withColumn("value", F.col("value").try_cast("double"))

    rest = F.col("flat").cast("bigint")
    positions = {}
    for d in reversed(order[1:]):
        positions[d] = rest % F.col(f"n_{d}")
        rest = F.call_function("div", rest, F.col(f"n_{d}"))
    positions[order[0]] = rest
    cells = sized.select(
        doc,
        "flat",
        *[positions[d].alias(f"{d}_pos") for d in order],
        (positions[order[0]] < F.col(f"n_{order[0]}")).alias("in_range"),
        "value",
    )

    dims = {}
    for d in order:
        codes = docs.select(
            doc,
            F.from_json(labels(d), "map<string,string>").alias("names"),
            F.posexplode(F.json_object_keys(labels(d))).alias("pos", "code"),
        )
        dims[d] = codes.select(
            doc,
            F.col("pos").cast("bigint").alias(f"{d}_pos"),
            F.col("code").alias(f"{d}_code"),
            F.try_element_at("names", F.col("code")).alias(f"{d}_label"),
        )
    return cells, dims


def decode_documents(
    docs: DataFrame, order: Sequence[str], text: str = "text", doc: str = "doc", strict: bool = False
) -> DataFrame:
    """Codes, labels and value of every cell, as :func:`split_cube` and :func:`decode_cube` give them.

    Each document is parsed once, and its cells are decoded before they become
    rows: the position of an index is looked up in the document's own arrays of
    codes and labels. One scan, no join.
    """
    parsed = {"_value": F.from_json(F.get_json_object(_col(text), "$.value"), "map<string,string>")}
    for d in order:
        parsed[f"_json_{d}"] = F.get_json_object(_col(text), f"$.dimension.{d}.category.label")
    rows = computed_once(docs.select(doc, text), **parsed).drop(text)
    rows = computed_once(
        rows, **{f"_codes_{d}": F.json_object_keys(f"_json_{d}") for d in order},
        **{f"_names_{d}": F.from_json(f"_json_{d}", "map<string,string>") for d in order},
    )
    rows = computed_once(rows, **{f"_labels_{d}": F.expr(f"transform(_codes_{d}, c -> try_element_at(_names_{d}, c))") for d in order})
    places, rest = {}, "cast(e.key AS bigint)"
    for d in reversed(order[1:]):
        places[d] = f"{rest} % size(_codes_{d})"
        rest = f"({rest}) div size(_codes_{d})"
    places[order[0]] = rest
    past = f"{rest} >= size(_codes_{order[0]})"
    late = "raise_error(concat('cube index past the axes: ', e.key))" if strict else "null"
    fields = ", ".join(f"'{d}_code', get(_codes_{d}, cast({places[d]} AS int)), '{d}_label', get(_labels_{d}, cast({places[d]} AS int))" for d in order)
    cell = f"named_struct({fields}, 'value', try_cast(e.value AS double))"
    cells = f"filter(transform(map_entries(_value), e -> if({past}, {late}, {cell})), c -> c IS NOT NULL)"
    return rows.select(doc, F.expr(f"inline({cells})"))


def cube_out_of_range(cells: DataFrame) -> DataFrame:
    """Cells whose index lies past the axes."""
    return cells.where(~F.col("in_range"))


def decode_cube(
    cells: DataFrame,
    dims: dict[str, DataFrame],
    order: Sequence[str],
    doc: str = "doc",
    strict: bool = False,
) -> DataFrame:
    """Codes and labels instead of positions.

    Out-of-range cells are left for :func:`cube_out_of_range`, or fail the job
    with ``strict``. The dimension tables are joined, not collected: Spark
    broadcasts them while they are small.
    """
    if strict:
        kept = cells.where(
            F.when(F.col("in_range"), F.lit(True)).otherwise(
                F.raise_error(F.concat(F.lit("cube index past the axes: "), F.col("flat"))).cast("boolean")
            )
        )
    else:
        kept = cells.where("in_range")
    for d in order:
        kept = kept.join(dims[d], [doc, f"{d}_pos"])
    return kept.select(doc, *[f"{d}_{part}" for d in order for part in ("code", "label")], "value")
