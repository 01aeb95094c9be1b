"""DataFrame -> DataFrame operators."""

from .areas import area_table, intersects_aoi, with_areas
from .assets import asset_patterns, outcomes, select_assets
from .columns import computed_once, flatten, keep, lead_columns, standardise_names
from .coverage import pixel_weights, pixels_by_zone
from .filters import (
    any_attribute_le, complete, in_bbox, in_window, name_filter, prefix, tagged,
)
from .incremental import needs_refresh, restrict, upsert
from .lookups import join, lookup, unmatched
from .products import flat_products, product_columns
from .ranking import latest_n, page
from .reshape import collapse, count_distinct, counts, distinct_sorted, pivot_mean, stack
from .spines import expand_daily, month_spine, trailing_days, window_bounds
from .zonal import point_in_zone, summarise_zones, zonal_stats, zone_cells

__all__ = [
    "any_attribute_le", "area_table", "asset_patterns", "collapse", "complete", "computed_once", "count_distinct", "counts",
    "distinct_sorted", "expand_daily", "flat_products", "flatten", "in_bbox", "in_window", "intersects_aoi",
    "join", "keep", "latest_n", "lead_columns", "lookup", "month_spine", "name_filter",
    "needs_refresh", "outcomes", "page", "pivot_mean", "pixel_weights", "pixels_by_zone", "point_in_zone", "prefix",
    "product_columns", "restrict", "select_assets", "stack", "standardise_names",
    "summarise_zones", "tagged", "trailing_days", "unmatched", "upsert", "window_bounds", "with_areas",
    "zonal_stats", "zone_cells",
]
