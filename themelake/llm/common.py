"""Small helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch

ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def let_workers_import(spark: SparkSession) -> None:
    """Python workers find this package where the driver found it, unless the session names another path."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def query(sql: str | None = None):
    """Register a query of this package under its function's name, with its SQL if there is one."""

    def register(f):
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            let_workers_import(spark)
            return f(spark, sf_dir)

        QUERIES[f.__name__] = run
        if sql is not None:
            SQL[f.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def landed(df: DataFrame, label: str, path: str | None = None, spent: list[str] | None = None) -> DataFrame:
    """Write the rows to the shared folder and read them back.

    Lineage ends there, so a lost executor costs nothing before it, and the
    shuffle files that led to the rows are removed when the write ends. The path
    is added to ``spent``, a list of those to :func:`forget` at a later point.
    """
    spark = df.sparkSession
    path, before = path or scratch(spark, label), spark.conf.get(SHUFFLE_CLEANUP)
    if spent is not None:
        spent.append(path)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, *paths: str) -> None:
    """Remove landed tables that nothing reads any more: every later step starts from another landed table."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def runs(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Neighbouring items in groups of at most ``limit`` in total, a larger item alone."""
    first, total = 0, 0
    for i, n in enumerate(sizes):
        if i > first and total + n > limit:
            yield first, i
            first, total = i, 0
        total += n
    if first < len(sizes):
        yield first, len(sizes)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))
