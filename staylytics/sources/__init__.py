"""Readers, writers and the shared staging folder."""

from staylytics.sources.staging import drop_staged, materialize, scratch_path
from staylytics.sources.tables import (
    centers_table,
    folders,
    literal_table,
    path_exists,
    read_bucketed,
    read_listings,
    read_sources,
    read_table,
    write_bucketed,
    write_table,
)

__all__ = [
    "centers_table",
    "drop_staged",
    "folders",
    "literal_table",
    "materialize",
    "path_exists",
    "read_bucketed",
    "read_listings",
    "read_sources",
    "read_table",
    "scratch_path",
    "write_bucketed",
    "write_table",
]
