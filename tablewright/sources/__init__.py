"""Readers with declared schemas, staging, and table writers."""

from tablewright.sources.key_history import KeyHistory
from tablewright.sources.ledger import Load
from tablewright.sources.merge import upsert_files
from tablewright.sources.readers import dated_path, read_csv, read_csv_rejects, read_json, read_parquet, register_views
from tablewright.sources.release import Release, current_release, drop_releases, read_release
from tablewright.sources.staging import stage
from tablewright.sources.writers import (
    create_table,
    drop_table,
    load_table,
    publish_table,
    write_bucketed,
    write_csv,
    write_table,
)

__all__ = [
    "KeyHistory",
    "Load",
    "Release",
    "create_table",
    "current_release",
    "dated_path",
    "drop_releases",
    "drop_table",
    "load_table",
    "publish_table",
    "read_csv",
    "read_csv_rejects",
    "read_json",
    "read_parquet",
    "read_release",
    "register_views",
    "stage",
    "upsert_files",
    "write_bucketed",
    "write_csv",
    "write_table",
]
