"""Loads that can be repeated, and that readers see as one.

A load writes all its tables aside. When everything is written it says so in a small file, and from there on only renames are
left: appended files take names that begin with the load's mark, replaced tables are exchanged. A record per finished
load stays in the ledger of the folder, and a load whose record is there is not run again.

A load that broke off before its tables were complete leaves nothing in them; one that broke off between the renames is finished
by the next load, before that begins. Loads into one folder must not run at the same time.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from hashlib import md5
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablewright.storage import exists, list_files, list_folders, read_small, remove_path, rename_path, replace_path, write_small

APPEND, OVERWRITE = "append", "overwrite"


def rows_mark(df: DataFrame) -> list[Column]:
    """Aggregates that tell the rows of a frame from others, in any order and any division into tasks: their number and two sums of hashes."""
    hashes = [F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in sorted(df.columns)]).cast("decimal(20,0)") for seed in (1, 2)]
    return [F.count("*").alias("n"), *[F.sum(h).alias(f"h{i}") for i, h in enumerate(hashes)]]


def observed_mark(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` to be written, and what its mark will be once it has been: no scan of its own."""
    seen = Observation()
    return df.observe(seen, *rows_mark(df)), seen


class Load:
    """One load into the tables of ``root``; tables go to ``path`` first."""

    def __init__(self, spark: SparkSession, root: str, name: str, fresh: bool = False) -> None:
        self.spark, self.root, self.name, self.fresh = spark, root.rstrip("/"), name, fresh
        self.mark = md5(name.encode()).hexdigest()
        self.aside = f"{self.root}/_loads/{self.mark}"
        self.modes: dict[str, str] = {}
        #: files of a table, by their names in its folder, that the rows appended to it stand for
        self.remove: dict[str, list[str]] = {}

    def path(self, table: str, mode: str = OVERWRITE) -> str:
        """Where the load writes its rows of a table, to be appended to it or to replace it."""
        self.modes[table] = mode
        return f"{self.aside}/{table}"

    def publish(self, record: Mapping[str, Any] | None = None) -> None:
        """Put everything in place and record the load. All tables must be written."""
        kept = {"load": self.name, "fresh": self.fresh, "tables": self.modes, "remove": self.remove, **(record or {})}
        write_small(self.spark, f"{self.aside}/_complete", json.dumps(kept))
        _put_in_place(self.spark, self.root, self.aside)


def _put_in_place(spark: SparkSession, root: str, aside: str) -> None:
    """The renames of a complete load. What is done already is skipped, so it may run again."""
    record = json.loads(read_small(spark, f"{aside}/_complete"))
    mark = aside.rsplit("/", 1)[1]
    for table, mode in sorted(record["tables"].items()):
        source, target = f"{aside}/{table}", f"{root}/{table}"
        if not exists(spark, source):
            continue
        if mode == OVERWRITE or not exists(spark, target):
            replace_path(spark, source, target)
            continue
        for file in list_files(spark, source):
            folder, _, name = file.rpartition("/")
            rename_path(spark, f"{source}/{file}", f"{target}/{folder}{'/' * bool(folder)}{mark}-{name}")
        remove_path(spark, source)
    for table, files in record["remove"].items():
        for file in files:
            remove_path(spark, f"{root}/{table}/{file}")
    for table in record["tables"]:
        for folder in list_folders(spark, root):
            if folder.startswith(f"{table}-replaced-"):
                remove_path(spark, f"{root}/{folder}")
    if record["fresh"]:
        # the tables that older records speak of are gone
        for file in list_files(spark, f"{root}/_ledger"):
            if not file.endswith(f"-{mark}.json"):
                remove_path(spark, f"{root}/_ledger/{file}")
    if not any(file.endswith(f"-{mark}.json") for file in list_files(spark, f"{root}/_ledger")):
        number = 1 + max([0, *(int(file.split("-")[0]) for file in list_files(spark, f"{root}/_ledger"))])
        write_small(spark, f"{root}/_ledger/{number:010d}-{mark}.json", json.dumps(record))
    remove_path(spark, aside)


def records(spark: SparkSession, root: str) -> list[dict[str, Any]]:
    """What the ledger holds, oldest load first."""
    root = root.rstrip("/")
    return [json.loads(read_small(spark, f"{root}/_ledger/{file}")) for file in sorted(list_files(spark, f"{root}/_ledger"))]


def finish_loads(spark: SparkSession, root: str) -> None:
    """Finish the loads whose tables are complete, drop what others have left."""
    root = root.rstrip("/")
    for folder in list_folders(spark, f"{root}/_loads"):
        aside = f"{root}/_loads/{folder}"
        if exists(spark, f"{aside}/_complete"):
            _put_in_place(spark, root, aside)
        else:
            remove_path(spark, aside)


def loaded(spark: SparkSession, root: str, name: str) -> bool:
    """Whether the load ``name`` is recorded."""
    mark = md5(name.encode()).hexdigest()
    return any(file.endswith(f"-{mark}.json") for file in list_files(spark, f"{root.rstrip('/')}/_ledger"))


def table_records(spark: SparkSession, root: str, table: str) -> Iterator[dict[str, Any]]:
    """Records of the loads whose rows a table holds: the last that replaced it, and those that appended since."""
    kept: list[dict[str, Any]] = []
    for record in records(spark, root):
        mode = record["tables"].get(table)
        kept = [record] if mode == OVERWRITE else [*kept, record] if mode else kept
    yield from kept
