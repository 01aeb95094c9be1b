"""Row filters. Plain comparisons come first so that the scan gets them."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import SENTINEL_2, STATION_RULES
from ..functions import any_attr_le
from ..functions.attributes import tagged_as


def _literal_like(df: DataFrame, column: str, at: datetime) -> Column:
    """A literal of the column's own type: a cast on the column stops pushdown."""
    kind = df.select(column).schema[0].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(at.isoformat(sep=" ") + "+00:00").cast("timestamp")


def in_window(
    df: DataFrame,
    collection: str,
    start: date,
    end: date,
    closed: str = "both",
    start_col: str = "content_start",
    collection_col: str = "collection",
) -> DataFrame:
    """One collection, content start within days.

    ``both``: from the first instant of ``start`` to 23:59:59.999 of ``end``.
    ``neither``: strictly between the two midnights, so ``end`` is out.
    ISO text is compared as the instant it names, whatever its fraction or
    offset; for the scan, its day is compared as text first, a day wider on
    either side. Text that names no instant is outside.
    """
    low = datetime.combine(start, time())
    at = F.col(start_col)
    if isinstance(df.select(start_col).schema[0].dataType, T.StringType):
        first, behind = start - timedelta(days=1), end + timedelta(days=2)
        df = df.where((at >= first.isoformat()) & (at < behind.isoformat()))
        at = at.try_cast("timestamp")
    if closed == "both":
        high = datetime.combine(end, time()) + timedelta(days=1) - timedelta(milliseconds=1)
        inside = (at >= _literal_like(df, start_col, low)) & (at <= _literal_like(df, start_col, high))
    elif closed == "neither":
        high = datetime.combine(end, time())
        inside = (at > _literal_like(df, start_col, low)) & (at < _literal_like(df, start_col, high))
    else:
        raise ValueError("closed is 'both' or 'neither'")
    return df.where(F.col(collection_col) == collection).where(inside)


def any_attribute_le(
    df: DataFrame,
    limit: int | None,
    name: str = "CloudCover",
    attrs: str = "Attributes",
    collection_col: str = "collection",
) -> DataFrame:
    """Attribute threshold, for Sentinel-2 rows and only if a limit is given."""
    if limit is None:
        return df
    other = ~F.upper(F.col(collection_col)).contains(SENTINEL_2)
    return df.where(other | any_attr_le(attrs, name, int(limit)))


def name_filter(
    df: DataFrame,
    include: str | None = None,
    exclude: str | None = "L1C",
    name: str = "Name",
    collection_col: str | None = "collection",
) -> DataFrame:
    """Names that contain a tile, and for Sentinel-2 not the excluded level."""
    if include:
        df = df.where(F.col(name).contains(include))
    if exclude:
        kept = ~F.col(name).contains(exclude)
        if collection_col:
            kept = kept | ~F.upper(F.col(collection_col)).startswith(SENTINEL_2)
        df = df.where(kept)
    return df


def in_bbox(df: DataFrame, lat: str, lon: str, box: tuple[float, float, float, float]) -> DataFrame:
    """Points inside (south, west, north, east), the border included."""
    south, west, north, east = box
    return df.where(F.col(lat).between(south, north) & F.col(lon).between(west, east))


def tagged(
    df: DataFrame,
    rules: list[tuple[str, str, str]] = STATION_RULES,
    kind: str = "type",
    tags: str = "tags",
) -> DataFrame:
    """Elements that meet a (kind, tag, value) rule; each once, in one pass."""
    return df.where(tagged_as(kind, tags, rules))


def prefix(df: DataFrame, column: str, start: str, length: int | None = None) -> DataFrame:
    """Codes with a prefix, of any length unless one is given."""
    df = df.where(F.col(column).startswith(start))
    return df if length is None else df.where(F.length(column) == length)


def complete(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Rows whose listed values are all present and read as their types.

    Null, NaN and text that cannot be cast all drop the row.
    """
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}

    def value(c: str, t: str) -> Column:
        # A NaN would turn into a number on its way to a whole type.
        own = F.nanvl(F.col(c), F.lit(None)) if c in floats else F.col(c)
        return own.try_cast(t)

    return df.withColumns({c: value(c, t) for c, t in types.items()}).dropna("any", subset=list(types))
