"""Surrogate keys. The content hash key is ``tablewright.functions.content_key``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.storage import stash

_ROW = "_row"
_POSITION = "_position"
_PART = "_part"
_OFFSET = "_offset"
# a monotonic id is the partition number above 33 bits of row number
_ROW_BITS = 33


def monotonic_key(df: DataFrame, name: str) -> DataFrame:
    """Unique ids with gaps, different from run to run; no shuffle."""
    return df.withColumn(name, F.monotonically_increasing_id())


def sequence_key(
    df: DataFrame,
    name: str,
    start: int = 0,
    order_by: Sequence[str] = (),
    order_is_unique: bool = False,
    path: str | None = None,
) -> DataFrame:
    """Ids ``start``, ``start + 1``, ... without gaps.

    The rows are written once with their position inside their partition, then each partition's
    start is the sum of the sizes before it (one number per partition, so it is broadcast). Without
    ``order_by`` nothing but these sizes is shuffled. With it rows are range-partitioned and sorted
    first; unless ``order_is_unique``, rows equal in ``order_by`` are told apart by a stored row id,
    so that even a huge group of ties splits over partitions.

    ``path`` names a folder for the written rows, by default one below ``spark.checkpoint.dir``.
    """
    keys = list(order_by)
    if keys:
        if not order_is_unique:
            df = stash(df.withColumn(_ROW, F.monotonically_increasing_id()), "rows", path and f"{path}/rows")
            keys.append(_ROW)
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    columns = [c for c in df.columns if c != _ROW]
    placed = stash(
        df.select(*columns, F.monotonically_increasing_id().alias(_POSITION)), "placed", path and f"{path}/placed"
    )
    placed = placed.withColumn(_PART, F.shiftright(_POSITION, _ROW_BITS))
    sizes = placed.groupBy(_PART).agg(F.count("*").alias("n"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(_PART, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(_OFFSET))
    within = F.col(_POSITION).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    numbered = placed.join(F.broadcast(offsets), _PART)
    return numbered.select((F.col(_OFFSET) + within + F.lit(start)).cast("bigint").alias(name), *columns)


def running_starts(df: DataFrame, weights: Mapping[str, Column], order_by: Sequence[str], path: str | None = None) -> DataFrame:
    """``df`` with, for each of ``weights``, its sum over all rows before, in the order of ``order_by``.

    As in ``sequence_key`` the rows are range-partitioned and written once, and of each partition only its sums are added up in one place.
    Rows equal in ``order_by`` lie in one partition; weights may use ``same_before`` and ``same_after``, which say whether a neighbour is equal.
    """
    placed = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    placed = stash(placed.withColumn(_POSITION, F.monotonically_increasing_id()), "weighed", path)
    lies, equal = Window.partitionBy(_PART).orderBy(_POSITION), F.struct(*order_by)
    placed = placed.withColumn(_PART, F.shiftright(_POSITION, _ROW_BITS)).withColumns(
        {"same_before": F.lag(equal).over(lies).eqNullSafe(equal), "same_after": F.lead(equal).over(lies).eqNullSafe(equal)}
    )
    own = {name: f"_own_{name}" for name in weights}
    placed = placed.withColumns({own[name]: weight.cast("bigint") for name, weight in weights.items()})
    sizes = placed.groupBy(_PART).agg(*[F.sum(c).alias(name) for name, c in own.items()])
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(_PART, *[F.coalesce(F.sum(name).over(before), F.lit(0)).alias(f"{_OFFSET}_{name}") for name in own])
    lies = lies.rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumns({name: F.coalesce(F.sum(c).over(lies), F.lit(0)) for name, c in own.items()})
    placed = placed.join(F.broadcast(offsets), _PART)
    starts = [(F.col(name) + F.col(f"{_OFFSET}_{name}")).alias(name) for name in own]
    return placed.select(*df.columns, "same_before", "same_after", *starts)
