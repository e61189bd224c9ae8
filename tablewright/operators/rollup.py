"""Aggregation to a coarser grain, and row counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def roll_up(df: DataFrame, keys: Sequence[str], averages: Sequence[str] = (), sums: Sequence[str] = ()) -> DataFrame:
    """One row per key with averages and sums under the columns' own names, in the order of ``df``."""
    aggregates = {c: F.avg(c).alias(c) for c in averages} | {c: F.sum(c).alias(c) for c in sums}
    rolled = df.groupBy(*keys).agg(*aggregates.values())
    return rolled.select(*[c for c in df.columns if c in aggregates or c in keys])


def row_counts(df: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """One row: ``n`` rows and ``n_distinct`` different rows, with ``key`` also ``n_repeated`` keys held by several.

    One scan. Rows are told apart by a 128-bit fingerprint of all columns, so 16 bytes a row and the key are
    shuffled, whatever the width of the table, and copies are combined inside the tasks first. That two different rows
    share a fingerprint has a chance of about n * n / 2 ** 129.
    """
    marks = [F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in df.columns]).alias(f"_mark{seed}") for seed in (1, 2)]
    rows = df.select(*[F.col(f"`{c}`").alias(f"_key{i}") for i, c in enumerate(key)], *marks)
    rows = rows.groupBy(*rows.columns).agg(F.count("*").alias("_copies"))
    total = F.coalesce(F.sum("_copies"), F.lit(0)).alias("n")
    if not key:
        return rows.agg(total, F.count("*").alias("n_distinct"))
    keys = rows.groupBy(*[f"_key{i}" for i in range(len(key))]).agg(
        F.sum("_copies").alias("_copies"), F.count("*").alias("_distinct")
    )
    distinct = F.coalesce(F.sum("_distinct"), F.lit(0)).alias("n_distinct")
    return keys.agg(total, distinct, F.count_if(F.col("_copies") > 1).alias("n_repeated"))


def numbered_counts(df: DataFrame, key: str) -> DataFrame:
    """What ``row_counts`` gives with a ``key`` that is a whole number, for tables whose keys are mostly different and lie near one another.

    Keys are counted and marked in blocks of 64: where no key repeats all rows differ, so nothing else of the rows is shuffled, and for keys
    that rise as rows lie a row per block. Rows of blocks with a repeated key, or with several NULL keys, are counted one by one.
    Whether there are such blocks is found out at once, not when the result is read, for a scan of the key: without any, nothing else is scanned then.
    """
    block = F.shiftright(F.col(f"`{key}`").cast("bigint"), 6)
    bit = F.expr(f"shiftleft(1L, CAST(`{key}` & 63 AS INT))")
    blocks = df.groupBy(block.alias("_block")).agg(F.count("*").alias("n"), F.bit_or(bit).alias("_bits"))
    clean = F.col("n") == F.coalesce(F.bit_count("_bits"), F.lit(1))
    total = F.coalesce(F.sum("n"), F.lit(0))
    parts = blocks.where(clean).agg(total.alias("n"), total.alias("n_distinct"), F.lit(0).cast("bigint").alias("n_repeated"))
    faulty = blocks.where(~clean).select("_block")
    if faulty.isEmpty():
        return parts
    rows = df.withColumn("_of", block)
    rows = rows.join(faulty, F.col("_of").eqNullSafe(F.col("_block")), "left_semi").drop("_of")
    parts = parts.unionAll(row_counts(rows, [key]).select("n", "n_distinct", "n_repeated"))
    return parts.agg(*[F.sum(c).alias(c) for c in parts.columns])
