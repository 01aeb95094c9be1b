"""Archive members by glob, and run outcomes."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import ASSET_GLOBS


def asset_patterns(mode: str, bands: list[str] | None = None, collection: str = "SENTINEL-2") -> list[str]:
    """Globs of a selection; Sentinel-1 has one set of its own."""
    if collection.upper().startswith("SENTINEL-1"):
        return ASSET_GLOBS["sentinel-1"]
    globs = ASSET_GLOBS.get(mode.lower(), [])
    if mode.lower() == "bands":
        return [g.format(band=b.strip().upper()) for b in bands or [] for g in globs]
    return globs


def glob_regex(globs: list[str]) -> str:
    """One regex for any of the globs; ``*`` also crosses ``/``.

    Each part is taken where it first occurs and never given back: with ``*``
    alone an earlier place is as good as any, and matching stays linear.
    """

    def one(glob: str) -> str:
        first, *rest = [re.escape(part) for part in re.split(r"\*+", glob)]
        if not rest:
            return first
        *middle, last = rest
        return first + "".join(f"(?>.*?{part})" for part in middle) + ".*" + last

    # A glob that another one matches, stars included, adds nothing to it.
    needed: list[str] = []
    for glob in sorted(set(globs), key=len):
        if not any(re.fullmatch(one(n), glob) for n in needed):
            needed.append(glob)
    return r"(?s)\A(?:" + "|".join(one(g) for g in needed) + r")\z"


def select_assets(
    members: DataFrame, patterns: list[str], member: str = "member", unique: bool = True
) -> DataFrame:
    """Members that match any glob, each once.

    A listing already free of repeats needs no ``unique``, and then no shuffle.
    """
    if not patterns:
        return members.limit(0)
    hits = members.where(F.col(member).rlike(glob_regex(patterns)))
    return hits.distinct() if unique else hits


def outcomes(df: DataFrame) -> DataFrame:
    """Products per status."""
    return df.groupBy("status").agg(F.count(F.lit(1)).alias("products"))
