"""Column builders: built-in expressions only."""

from .attributes import any_attr_le, attr, center_or_point, fallback
from .geometry import bbox, box_of, edge_list, even_odd, geojson_rings, geojson_text, parse_rings, rings_of
from .temporal import day_label, instant, local_date, month_label
from .text import (
    extract_category, head_segment, identifier, json_text, level, normalise, strip,
)

__all__ = [
    "any_attr_le", "attr", "bbox", "box_of", "center_or_point", "day_label", "edge_list",
    "even_odd", "extract_category", "fallback", "geojson_rings", "geojson_text", "head_segment", "identifier",
    "instant", "json_text", "level", "local_date", "month_label", "normalise",
    "parse_rings", "rings_of", "strip",
]
