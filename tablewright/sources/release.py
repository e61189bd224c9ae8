"""Several tables that readers see change at one moment.

A release writes tables into folders that no reader knows yet. Publishing it creates one small file, numbered, that names the
folder of every table: those it wrote, and for all others the folders of the release before. Creating that file is
the switch: a reader takes the file with the highest number and finds all its tables there, whatever is published meanwhile.
Folders are never written twice, so a reader keeps its version until ``drop_releases`` takes it away.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tablewright.storage import create_small, list_files, list_folders, read_small, remove_path

_NAMES, _TABLES = "_releases", "_versions"


class Release:
    """Tables of ``root`` that are to change together; each is written to its ``path`` by the caller, then ``publish`` is called.

    Of two releases begun on the same version the one published first stands; the other is an error, and nothing of it is seen.
    One that is never published leaves its folders, which ``drop_releases`` removes.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.before = current_release(spark, root)
        self.folder = f"{_TABLES}/{uuid4().hex}"
        self.tables: dict[str, str] = {}

    def path(self, table: str) -> str:
        """Where to write a table."""
        if not table or "/" in table or table.startswith(("_", ".")):
            raise ValueError(f"{table!r} cannot name a table")
        self.tables[table] = f"{self.folder}/{table}"
        return f"{self.root}/{self.tables[table]}"

    def publish(self) -> int:
        """Let readers see the tables; returns the number of the release. All of them must be written."""
        number, kept = (0, {}) if self.before is None else (self.before, _named(self.spark, self.root, self.before))
        content = json.dumps({"tables": {**kept, **self.tables}})
        if not create_small(self.spark, f"{self.root}/{_NAMES}/{number + 1:010d}.json", content):
            raise RuntimeError(f"release {number + 1} of {self.root} was published meanwhile")
        return number + 1


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(f[:-5]) for f in list_files(spark, f"{root.rstrip('/')}/{_NAMES}") if f[:-5].isdigit() and f.endswith(".json"))


def _named(spark: SparkSession, root: str, number: int) -> dict[str, str]:
    return json.loads(read_small(spark, f"{root.rstrip('/')}/{_NAMES}/{number:010d}.json"))["tables"]


def current_release(spark: SparkSession, root: str) -> int | None:
    """Number of the release that readers see; None before the first."""
    return max(_numbers(spark, root), default=None)


def read_release(spark: SparkSession, root: str, number: int | None = None) -> Mapping[str, DataFrame]:
    """All tables of one release, by default the current one, by name."""
    root = root.rstrip("/")
    number = current_release(spark, root) if number is None else number
    if number is None:
        raise FileNotFoundError(f"nothing is published in {root}")
    return {table: spark.read.parquet(f"{root}/{folder}") for table, folder in _named(spark, root, number).items()}


def drop_releases(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Forget all but the last ``keep`` releases, and remove the folders that none of these names. No release may be under way."""
    if keep < 1:
        raise ValueError("the current release stays")
    root = root.rstrip("/")
    numbers = _numbers(spark, root)
    used = {folder for number in numbers[-keep:] for folder in _named(spark, root, number).values()}
    for number in numbers[:-keep]:
        remove_path(spark, f"{root}/{_NAMES}/{number:010d}.json")
    for version in list_folders(spark, f"{root}/{_TABLES}"):
        for table in list_folders(spark, f"{root}/{_TABLES}/{version}"):
            if f"{_TABLES}/{version}/{table}" not in used:
                remove_path(spark, f"{root}/{_TABLES}/{version}/{table}")
        if not list_folders(spark, f"{root}/{_TABLES}/{version}"):
            remove_path(spark, f"{root}/{_TABLES}/{version}")
