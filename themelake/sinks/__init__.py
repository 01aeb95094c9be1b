"""Writers: themed tables and keyed tables."""

from .keyed import ensure_table, merged_partitions, publish, read_table, upsert_table
from .themes import save_theme, save_theme_json, theme_path

__all__ = ["ensure_table", "merged_partitions", "publish", "read_table", "save_theme", "save_theme_json", "theme_path", "upsert_table"]
