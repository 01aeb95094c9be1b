"""CSV tables: by header name, missing cells as null, no NaN."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import CSV_MISSING
from ..session import cut_lineage, scratch
from .paged_json import struct_of

# A set whose largest file is no larger is read file by file, each as one text.
WHOLE_BYTES = 1 << 20
# Headers of a set up to this size, with the paths of their files, are broadcast.
BROADCAST_BYTES = 64 << 20


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in a float column becomes null, so aggregates skip it."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(
        *[F.nanvl(F.col(f"`{c}`"), F.lit(None)).alias(c) if c in floats else F.col(f"`{c}`") for c in df.columns]
    )


def _text_cells(spark: SparkSession, path: str | list[str], multi_line: bool) -> DataFrame:
    raw = (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )
    cells = [F.col(f"`{c}`") for c in raw.columns]
    return raw.select(*[F.when(~c.isin(CSV_MISSING), c).alias(n) for c, n in zip(cells, raw.columns)])


def _quotes(text: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))


def _has_open_quotes(spark: SparkSession, path: str | list[str]) -> bool:
    """Does a line hold an odd number of quotes? The look ends at the first one."""
    lines = spark.read.text(path)
    return not lines.where(_quotes("value") % 2 == 1).isEmpty()


def _number_types(cells: DataFrame) -> dict[str, str]:
    """bigint or double for the columns whose present cells all read as such.

    One aggregation over all columns, one row back.
    """
    counts: list[Column] = []
    for i, c in enumerate(cells.columns):
        cell = F.col(f"`{c}`")
        whole = F.when(cell.rlike(r"^\s*[-+]?\d+\s*$"), cell.try_cast("bigint"))
        counts += [
            F.count(cell).alias(f"present_{i}"),
            F.count(whole).alias(f"bigint_{i}"),
            F.count(cell.try_cast("double")).alias(f"double_{i}"),
        ]
    seen = cells.agg(*counts).first()
    types = {}
    for i, c in enumerate(cells.columns):
        present = seen[f"present_{i}"]
        if present and seen[f"bigint_{i}"] == present:
            types[c] = "bigint"
        elif seen[f"double_{i}"] == present:
            types[c] = "double"
    return types


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: str | T.StructType | None = None,
    multi_line: bool | None = None,
) -> DataFrame:
    """A headed CSV table.

    Quoted cells may hold line breaks, and then a file is one task. Unless
    ``multi_line`` says so or denies it, one pass looks whether a line leaves a
    quote open; tables without such lines are split like any text.

    Columns are taken by header name, so a schema may list some of them in any
    order, and only those are parsed. Cells that do not read as their type are
    missing. Without a schema one extra pass finds the number columns; give one
    for large inputs.
    """
    if multi_line is None:
        multi_line = _has_open_quotes(spark, path)
    cells = _text_cells(spark, path, multi_line)
    if schema is None:
        types = _number_types(cells)
        wanted = [(c, types.get(c, "string")) for c in cells.columns]
    else:
        wanted = [(f.name, f.dataType) for f in struct_of(schema).fields]
    typed = cells.select(*[F.col(f"`{c}`").try_cast(t).alias(c) for c, t in wanted])
    return nan_to_null(typed)


def _cells(record: str) -> str:
    """SQL: the cells of a CSV record, quotes taken off."""
    raw = rf"""regexp_extract_all(concat(',', {record}), r',("[^"]*+(?:""[^"]*+)*+"|[^,]*+)', 1)"""
    return rf"""transform({raw}, c -> if(startswith(c, '"'), replace(substring(c, 2, length(c) - 2), '""', '"'), c))"""


def _records(text: str) -> str:
    """SQL: the records of a CSV text; a line break between quotes ends none."""
    return rf"""regexp_extract_all({text}, r'(?:[^"\r\n]++|"[^"]*+")++', 0)"""


def _unmarked(text: str) -> str:
    """SQL: a text without the byte order marks that it begins with."""
    return rf"trim(LEADING '\uFEFF' FROM {text})"


def _texts(spark: SparkSession, folder: str, prefix: str, **options: str | bool) -> DataFrame:
    return spark.read.format("text").option("pathGlobFilter", f"{prefix}*.csv").options(**options).load(folder)


def _records_over_lines(spark: SparkSession, texts: DataFrame) -> DataFrame:
    """The records of a set, by file, block and line, where a quoted cell may go over lines.

    ``texts`` are cut at line feeds. How many lines of the file that leave a
    quote open or close one come before a line says whether it begins inside a
    quoted cell, and to which record it belongs. They are counted by block and
    then inside the block. The last quote of a file that leaves it open encloses nothing.
    """
    # with the line breaks: a carriage return alone ends a line too
    cut = F.split(F.concat("value", F.lit("\n")), r"(?<=\r)(?!\n)")
    pieces = texts.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.explode(cut).alias("_text"))
    # landed, since the places of blocks and the numbers of lines are used twice
    at = scratch(spark, "csv-lines")
    pieces.withColumn("_line", F.monotonically_increasing_id()).write.parquet(at, compression="zstd")
    lines = spark.read.parquet(at).withColumn("_quotes", _quotes("_text")).select(
        "_file", "_block", "_line", "_text", (F.col("_quotes") % 2).alias("_turns"), F.signum("_quotes").cast("int").alias("_quoted")
    )
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("_file", "_block").agg(F.sum("_turns").alias("_turned"), F.sum("_quoted").alias("_with_quotes")).select(
        "_file", "_block",
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_earlier") for c in ("_turned", "_with_quotes")],
        F.sum("_with_quotes").over(Window.partitionBy("_file")).alias("_with_quotes_all"),
    )
    above = Window.partitionBy("_file", "_block").orderBy("_line").rowsBetween(Window.unboundedPreceding, -1)
    counted = lines.join(blocks, ["_file", "_block"]).select(
        "_file", "_block", "_line", "_text", "_turns", "_with_quotes_all",
        (F.col("_turned_earlier") + F.coalesce(F.sum("_turns").over(above), F.lit(0))).alias("_turned"),
        (F.col("_with_quotes_earlier") + F.coalesce(F.sum("_quoted").over(above), F.lit(0))).alias("_with_quotes"),
    )
    alone = F.expr("_turned % 2 = 0 AND _turns = 0 OR _with_quotes = _with_quotes_all")
    single = counted.where(alone).select("_file", "_block", (F.col("_line") * 2).alias("_line"), F.rtrim("_text", F.lit("\r\n")).alias("record"))
    parts = counted.where(~alone).groupBy("_file", F.expr("_turned DIV 2")).agg(
        F.array_sort(F.collect_list(F.struct("_block", "_line", "_text"))).alias("_parts")
    ).select("_file", F.col("_parts")[0].alias("_at"), F.array_join("_parts._text", "").alias("_text"))
    # two records only where the last quote of a file encloses nothing
    over_lines = parts.select("_file", "_at", F.posexplode(F.expr(_records("_text"))).alias("_nth", "record")).select(
        "_file", "_at._block", (F.col("_at._line") * 2 + F.col("_nth")).alias("_line"), "record"
    )
    at = scratch(spark, "csv-records")
    single.union(over_lines).write.parquet(at, compression="zstd")
    return spark.read.parquet(at)


def _headers(lines: DataFrame, multi_line: bool) -> DataFrame:
    """By file its header, how many records follow, and whether a line leaves a quote open.

    The header is the first line, with ``multi_line`` the first that is not empty.
    """
    at = F.when(F.col("record") != "", F.col("_line")) if multi_line else F.col("_line")
    # collect_set puts first lines into a hash table; beside a plain max they would be found by a sort of all lines
    by_block = lines.withColumn("_open", _quotes("record") % 2 == 1).groupBy("_file", "_block").agg(
        F.min_by("record", at).alias("_header"), ((F.col("_block") == 0) & (F.min(at) == F.min("_line"))).alias("_on_top"),
        F.count_if(F.col("record") != "").alias("_lines"), F.collect_set("_open").alias("_open"),
    )
    by_file = by_block.where("_header IS NOT NULL").groupBy("_file").agg(
        F.min_by("_header", "_block").alias("_header"), F.min_by("_on_top", "_block").alias("_on_top"), F.sum("_lines").alias("_lines"),
        F.max(F.array_max("_open")).alias("_open"),
    )
    return cut_lineage(by_file.withColumn("_lines", F.col("_lines") - (F.col("_header") != "").cast("int")))


def _lines_and_headers(spark: SparkSession, folder: str, prefix: str, multi_line: bool) -> tuple[DataFrame, DataFrame]:
    """The lines of a set that are its records, headers included; the headers."""
    lines = _texts(spark, folder, prefix).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line"),
        F.col("value").alias("record"),
    )
    headers = _headers(lines, multi_line)
    if multi_line and headers.agg(F.max("_open")).first()[0]:
        lines = _records_over_lines(spark, _texts(spark, folder, prefix, lineSep="\n"))
        headers = _headers(lines, multi_line)
    names = F.expr(f"if(_on_top, {_unmarked('_header')}, _header)")
    files = headers.withColumn("_names", names).select("_file", "_header", "_lines", F.expr(_cells("_names")).alias("header"))
    return lines.where("record <> ''"), files


def _below_headers(lines: DataFrame, headers: DataFrame, broadcast_bytes: int) -> DataFrame:
    """The lines with what belongs to their header, which is left out: one of the lines that are equal to it."""
    size = headers.agg(F.sum(F.octet_length("_file") + F.octet_length("_header") + 4 * F.size("places") + 64)).first()[0]
    met = lines.join(F.broadcast(headers) if (size or 0) <= broadcast_bytes else headers, "_file")
    first = Window.partitionBy("_file").orderBy("_block", "_line")
    equal = met.where("record = _header").withColumn("_nth", F.row_number().over(first)).where("_nth > 1")
    return met.where("record <> _header").select("places", "record").union(equal.select("places", "record"))


def read_csv_set(
    spark: SparkSession,
    folder: str,
    prefix: str,
    schema: str | T.StructType | None = None,
    multi_line: bool = True,
    whole_bytes: int = WHOLE_BYTES,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame | None:
    """All ``prefix*.csv`` files of a folder, stacked by column name.

    With a schema, columns that a file lacks are null, and no name and no path
    comes to the driver; without one, the different names do, once, and one
    pass finds the number columns. No file: ``None``.

    Quoted cells may hold line breaks, unless ``multi_line`` is false. A set of
    files up to ``whole_bytes`` is one scan, each file one text that is cut
    into its records. If a file is larger, files are split like any text: a
    first pass finds the header of each and looks whether a line leaves a quote
    open. If none does, lines are records, else records are landed (see
    ``_records_over_lines``). Headers meet the lines of their file by a join, in
    which no line moves while headers are below ``broadcast_bytes``.
    """
    sizes = spark.read.format("binaryFile").option("pathGlobFilter", f"{prefix}*.csv").load(folder).select("length")
    largest = sizes.agg(F.max("length")).first()[0]
    if largest is None:
        return None
    whole = multi_line and largest <= whole_bytes
    if whole:
        files = _texts(spark, folder, prefix, wholetext=True).select(F.expr(_records(_unmarked("value"))).alias("records")).select(
            F.expr(_cells("get(records, 0)")).alias("header"), F.expr("slice(records, 2, greatest(size(records) - 1, 0))").alias("records"),
        )
        headers = files.where("size(records) > 0")
    else:
        lines, files = _lines_and_headers(spark, folder, prefix, multi_line)
        headers = files.where("_lines > 0")
    if schema is None:
        names = headers.agg(F.array_sort(F.flatten(F.collect_set("header")))).first()[0]
        wanted = T.StructType([T.StructField(n, T.StringType()) for n in dict.fromkeys(names)])
    else:
        wanted = struct_of(schema)
    places = F.transform(F.array(*[F.lit(n) for n in wanted.names]), lambda n: F.array_position("header", n).cast("int") - 1)
    files = files.withColumn("places", places).drop("header")
    if whole:
        records = files.select("places", F.explode("records").alias("record"))
    else:
        records = _below_headers(lines, files.drop("_lines"), broadcast_bytes)
    cells = records.select("places", F.expr(_cells("record")).alias("cells"))
    texts = cells.select(*[F.expr(f"get(cells, places[{i}])").alias(n) for i, n in enumerate(wanted.names)])
    texts = texts.select(*[F.when(~F.col(f"`{n}`").isin(CSV_MISSING), F.col(f"`{n}`")).alias(n) for n in wanted.names])
    if schema is None:
        types = _number_types(texts)
        wanted = T.StructType.fromDDL(", ".join(f"`{n}` {types.get(n, 'string')}" for n in wanted.names))
    return nan_to_null(texts.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in wanted.fields]))
