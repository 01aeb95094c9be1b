"""Text columns: names, categories, levels, JSON text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import NORMALISE_FROM, NORMALISE_TO


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim every kind of white space; ``trim`` would only take spaces."""
    return F.regexp_replace(_col(c), r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def head_segment(c: Column | str, sep: str = ".") -> Column:
    """Text before the first literal ``sep``, trimmed."""
    return strip(F.split_part(_col(c), F.lit(sep), F.lit(1)))


def identifier(name: Column | str, id_: Column | str) -> Column:
    """Product name up to its first dot; the id where there is no name."""
    named = F.nullif(_col(name), F.lit(""))
    return F.coalesce(F.split_part(named, F.lit("."), F.lit(1)), _col(id_))


def extract_category(c: Column | str, values: list[str]) -> Column:
    """First of ``values`` that appears as a whole word, else null."""
    words = "|".join(re.escape(v) for v in values)
    return F.nullif(F.regexp_extract(_col(c), rf"(?U)\b({words})\b", 1), F.lit(""))


def normalise(c: Column | str) -> Column:
    """Lower-case name with the Spanish accents folded, other marks kept."""
    return F.translate(F.lower(strip(c)), NORMALISE_FROM, NORMALISE_TO)


def level(name: Column | str) -> Column:
    """``L2A`` for names that say so, ``unknown`` for all others."""
    return F.when(_col(name).contains("L2A"), F.lit("L2A")).otherwise(F.lit("unknown"))


def json_text(c: Column | str, empty_as_null: bool = True) -> Column:
    """A nested value as JSON text; an empty one is missing unless asked for."""
    text = F.to_json(_col(c))
    if empty_as_null:
        text = F.when(~text.isin("{}", "[]"), text)
    return text
