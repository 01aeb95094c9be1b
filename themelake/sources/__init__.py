"""Readers of landed responses and files."""

from .csv_tables import nan_to_null, read_csv, read_csv_set
from .cube import cube_out_of_range, decode_cube, decode_documents, read_cube
from .open_items import flatten_open, item_fields, read_open_items
from .paged_json import read_paged_json
from .schemas import CATALOGUE_ITEM, MAP_ELEMENT, SERIES_ITEM, WEATHER_RESPONSE
from .series import explode_series, last_periods
from .zones import features_to_zones, read_zones

__all__ = [
    "CATALOGUE_ITEM", "MAP_ELEMENT", "SERIES_ITEM", "WEATHER_RESPONSE",
    "cube_out_of_range", "decode_cube", "decode_documents", "explode_series", "features_to_zones", "flatten_open", "item_fields",
    "last_periods", "nan_to_null", "read_csv", "read_csv_set", "read_cube", "read_open_items", "read_paged_json",
    "read_zones",
]
