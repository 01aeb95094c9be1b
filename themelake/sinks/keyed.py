"""Keyed tables: Parquet, partitioned by a column that is part of the key.

An upsert reads and rewrites only the partitions that its batch touches, so a
week of new days in a table of many years costs a week's worth of partitions.
The merged partitions are landed beside the table first and then put in place by
Spark's dynamic partition overwrite, which leaves all others alone. A run that
dies while merging leaves the table as it was; one that dies while partitions
are put in place is finished by :func:`publish` from the landed ones.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.incremental import upsert
from ..session import scratch
from ..sources.paged_json import struct_of


def ensure_table(spark: SparkSession, path: str, schema: str | T.StructType, partition: str) -> DataFrame:
    """Create the table if it is not there; an existing one is left alone."""
    spark.createDataFrame([], struct_of(schema)).write.mode("ignore").partitionBy(partition).parquet(path)
    return read_table(spark, path, schema)


def read_table(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    fields = struct_of(schema)
    return spark.read.schema(fields).parquet(path).select(*fields.names)


def _with_whole_keys(updates: DataFrame, keys: list[str]) -> DataFrame:
    """The batch; a row whose key is not all there fails the job."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    broken = F.raise_error(F.concat(F.lit("row without a whole key: "), F.to_json(F.struct(*keys)))).cast("boolean")
    return updates.where(F.when(whole, F.lit(True)).otherwise(broken))


def merged_partitions(stored: DataFrame, updates: DataFrame, keys: list[str], order_col: str, partition: str) -> DataFrame:
    """The partitions that a batch touches, with the batch in them; Spark skips the folders of all others."""
    touched = updates.select(partition).distinct()
    return upsert(stored.join(touched, partition, "left_semi").select(*stored.columns), updates, keys, order_col)


def publish(landed: DataFrame, path: str, partition: str) -> None:
    """Put whole partitions in place of those of the table; may be repeated."""
    landed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def upsert_table(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    updates: DataFrame,
    keys: list[str],
    order_col: str,
    partition: str,
) -> str:
    """Insert or replace by key; returns where the merged partitions are landed.

    The partition column must be one of the keys, else a key could be in two
    partitions. A run repeated after a failure gives the same table. One writer
    at a time.
    """
    if partition not in keys:
        raise ValueError(f"the partition column {partition!r} must be one of the keys")
    fields = struct_of(schema)
    batch = scratch(spark, "batch")
    _with_whole_keys(updates, keys).write.parquet(batch)
    updates = spark.read.schema(updates.schema).parquet(batch)
    merged = scratch(spark, "merged")
    stored = read_table(spark, path, fields)
    merged_partitions(stored, updates, keys, order_col, partition).select(*fields.names).write.parquet(merged)
    publish(spark.read.schema(fields).parquet(merged), path, partition)
    return merged
