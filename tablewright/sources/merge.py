"""Upserts into a written table that rewrite only the files that hold changed keys."""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.dimensions import last_wins, table_upsert
from tablewright.sources.ledger import APPEND, Load, finish_loads, loaded
from tablewright.sources.writers import write_table
from tablewright.storage import exists, stash


def upsert_files(
    spark: SparkSession, root: str, table: str, changes: DataFrame, key: Sequence[str], order: Sequence[str], cluster: bool = True, load: str | None = None
) -> list[str]:
    """Apply ``changes`` to the Parquet table ``root/table`` (one row per key); the row last in ``order`` wins. Returns the names of the files replaced.

    The scan for changed keys reads the key columns; then the files that hold one are read whole and written anew, new keys along with them. All
    other files stay as they are. With ``cluster`` new files are ranges of the key, so a table that is written that way
    (``write_table`` with ``cluster_by``) keeps few files per change. New files are put in place before old ones go; a load that breaks off in
    between is finished by the next, and a named ``load`` that the ledger in ``root`` holds is not run again.
    """
    root = root.rstrip("/")
    finish_loads(spark, root)
    if load is not None and loaded(spark, root, load):
        return []
    path = f"{root}/{table}"
    newest = stash(last_wins(changes, key, order).select(*changes.columns), "changes")
    this = Load(spark, root, load or uuid4().hex)
    columns = list(key) if cluster else []
    if not exists(spark, path):
        write_table(newest, this.path(table, APPEND), cluster_by=columns)
        this.publish()
        return []
    base = spark.read.parquet(path)
    held = base.select(*key, F.col("_metadata.file_name").alias("_file")).join(newest.select(*key), list(key), "left_semi")
    # names of files, not rows
    names = sorted(r["_file"] for r in held.select("_file").distinct().collect())
    touched = spark.read.schema(base.schema).parquet(*[f"{path}/{name}" for name in names]) if names else base.limit(0)
    merged = table_upsert(touched, newest.select(*base.columns), key, order)
    write_table(merged, this.path(table, APPEND), cluster_by=columns)
    this.remove[table] = names
    this.publish()
    return names
