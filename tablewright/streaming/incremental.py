"""File-by-file load as a file-source stream: new files are found, loaded once and committed per batch.

Each batch writes its own folder per table, named by batch id, so a batch that runs again after a
failure replaces its output. A dimension folder holds partial first/last states per key, already
reduced to one row per key and batch; reading merges them. Loading a batch therefore never rewrites,
or even reads, what earlier batches wrote.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewright.operators.dimensions import merge_states, state_rows, upsert_state
from tablewright.operators.keys import sequence_key
from tablewright.storage import exists, list_files, read_small, remove_path, stash, write_small

_BATCH = "batch"


@dataclass(frozen=True)
class UpsertDimension:
    """A dimension fed by every batch; ``prepare`` turns staged rows into its source rows."""

    name: str
    key: Sequence[str]
    order: Sequence[str]
    keep_first: Sequence[str]
    take_last: Sequence[str]
    prepare: Callable[[DataFrame], DataFrame] | None = None


@dataclass(frozen=True)
class AppendFact:
    """A fact table to which every batch appends ``build(staged rows)``.

    ``number`` names a key that counts the rows over all batches, without gaps, from ``number_from`` on; within a batch they are
    counted in ``number_order``, which should name all columns that tell rows apart. A batch reserves its range in the
    ledger of the folder before it writes and finds it there when it is run again.
    """

    name: str
    build: Callable[[DataFrame], DataFrame] | None = None
    number: str | None = None
    number_from: int = 1
    number_order: Sequence[str] = ()


@dataclass(frozen=True)
class RollUp:
    """Averages and sums per key over all batches; ``prepare`` turns staged rows into its source rows."""

    name: str
    key: Sequence[str]
    averages: Sequence[str] = ()
    sums: Sequence[str] = ()
    prepare: Callable[[DataFrame], DataFrame] | None = None


def incremental_load(
    spark: SparkSession,
    in_dir: str,
    schema: StructType,
    out: str,
    facts: Sequence[AppendFact] = (),
    dimensions: Sequence[UpsertDimension] = (),
    max_files: int = 1000,
    source_format: str = "json",
    rollups: Sequence[RollUp] = (),
    **options: str,
) -> list[int]:
    """Load the files in ``in_dir`` that earlier runs have not; returns the ids of the batches run.

    ``max_files`` bounds a batch. Rows are staged as Parquet once per batch; facts and dimensions read
    their columns from there.
    """
    out = out.rstrip("/")
    done: list[int] = []

    def load(batch: DataFrame, batch_id: int) -> None:
        staged = stash(batch, "staging", f"{out}/_staging")
        for fact in facts:
            rows = fact.build(staged) if fact.build else staged
            if fact.number:
                rows = _numbered(spark, rows, fact, out, batch_id)
            rows.write.mode("overwrite").parquet(f"{out}/{fact.name}/{_BATCH}={batch_id}")
        for dim in dimensions:
            rows = dim.prepare(staged) if dim.prepare else staged
            states = upsert_state(rows, dim.key, dim.order, dim.keep_first, dim.take_last)
            states.write.mode("overwrite").parquet(f"{out}/{dim.name}/{_BATCH}={batch_id}")
        for rollup in rollups:
            rows = rollup.prepare(staged) if rollup.prepare else staged
            _partial_sums(rows, rollup).write.mode("overwrite").parquet(f"{out}/{rollup.name}/{_BATCH}={batch_id}")
        done.append(batch_id)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).options(**options)
    query = (
        stream.format(source_format)
        .load(in_dir)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", f"{out}/_checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return done


def _partial_sums(rows: DataFrame, rollup: RollUp) -> DataFrame:
    """Sums, and for averages the number of values, of each key of a batch."""
    sums = [F.sum(c).alias(f"sum_{c}") for c in dict.fromkeys([*rollup.averages, *rollup.sums])]
    return rows.groupBy(*rollup.key).agg(*sums, *[F.count(c).alias(f"n_{c}") for c in rollup.averages])


def _merged_sums(spark: SparkSession, root: str, rollup: RollUp) -> DataFrame:
    states = spark.read.parquet(root)
    if exists(spark, f"{root}/_compacted"):
        # sums must not be added twice: this file says which folder stands for the batches up to which
        kept = json.loads(read_small(spark, f"{root}/_compacted"))
        states = states.where((F.col(_BATCH) == kept["folder"]) | (F.col(_BATCH) > kept["upto"]))
    numbers = [c for c in states.columns if c not in (*rollup.key, _BATCH)]
    return states.groupBy(*rollup.key).agg(*[F.sum(c).alias(c) for c in numbers])


def read_rollup(spark: SparkSession, out: str, rollup: RollUp) -> DataFrame:
    """The roll-up as of the last batch; a key whose values are all NULL has a NULL average and sum."""
    states = _merged_sums(spark, f"{out.rstrip('/')}/{rollup.name}", rollup)
    averages = [(F.col(f"sum_{c}") / F.nullif(F.col(f"n_{c}"), F.lit(0))).alias(c) for c in rollup.averages]
    return states.select(*rollup.key, *averages, *[F.col(f"sum_{c}").alias(c) for c in rollup.sums])


def compact_rollup(spark: SparkSession, out: str, rollup: RollUp) -> None:
    """Put one folder in the place of a roll-up's batches. Run it between loads.

    Readers take the new folder once a small file names it, and old ones until then, so no batch is ever counted twice.
    """
    root = f"{out.rstrip('/')}/{rollup.name}"
    batches = [row[_BATCH] for row in spark.read.parquet(root).select(_BATCH).distinct().collect()]
    if len(batches) < 2:
        return
    # folders of merged batches count down from -1, which no batch id uses
    target = min(0, *batches) - 1
    _merged_sums(spark, root, rollup).write.mode("overwrite").parquet(f"{root}/{_BATCH}={target}")
    write_small(spark, f"{root}/_compacted", json.dumps({"folder": target, "upto": max(batches)}))
    for batch_id in batches:
        remove_path(spark, f"{root}/{_BATCH}={batch_id}")


def _numbered(spark: SparkSession, rows: DataFrame, fact: AppendFact, out: str, batch_id: int) -> DataFrame:
    """Rows with the numbers that the ledger reserves for this batch."""
    ranges = f"{out}/_ranges/{fact.name}"
    held = {int(name.split(".")[0]): json.loads(read_small(spark, f"{ranges}/{name}")) for name in sorted(list_files(spark, ranges))[-2:]}
    placed = f"{out}/_placed/{fact.name}"
    if batch_id in held:
        start = held[batch_id]["start"]
    else:
        start = max([fact.number_from, *(r["start"] + r["rows"] for k, r in held.items() if k < batch_id)])
    keyed = sequence_key(rows, fact.number, start, fact.number_order, path=placed)
    number = keyed.count()
    if batch_id not in held:
        write_small(spark, f"{ranges}/{batch_id:012d}.json", json.dumps({"start": start, "rows": number}))
    elif held[batch_id]["rows"] != number:
        raise RuntimeError(f"batch {batch_id} of {fact.name} has {number} rows, but has had {held[batch_id]['rows']}")
    return keyed


def read_fact(spark: SparkSession, out: str, name: str) -> DataFrame:
    """All loaded rows of a fact table."""
    return spark.read.parquet(f"{out.rstrip('/')}/{name}").drop(_BATCH)


def read_dimension(spark: SparkSession, out: str, dim: UpsertDimension) -> DataFrame:
    """The dimension as of the last batch: one row per key."""
    states = spark.read.parquet(f"{out.rstrip('/')}/{dim.name}")
    return state_rows(merge_states(states, dim.key), dim.key, dim.keep_first, dim.take_last)


def compact_dimension(spark: SparkSession, out: str, dim: UpsertDimension) -> None:
    """Replace the folders of a dimension's batches by a single merged one.

    Run it between loads. Merging the same state twice changes nothing, so readers stay right while
    both the merged folder and the old ones exist, also if the clean-up is cut short.
    """
    root = f"{out.rstrip('/')}/{dim.name}"
    states = spark.read.parquet(root)
    # one number per folder, not per row
    merged = [row[_BATCH] for row in states.select(_BATCH).distinct().collect()]
    if len(merged) < 2:
        return
    # merged folders count down from -1, which no batch id uses
    target = min(0, *merged) - 1
    merge_states(states, dim.key).write.mode("overwrite").parquet(f"{root}/{_BATCH}={target}")
    for batch_id in merged:
        remove_path(spark, f"{root}/{_BATCH}={batch_id}")
