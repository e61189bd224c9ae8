"""Equi-joins on natural keys.

The join strategy is left to Spark: a side is broadcast only if its measured size is under
``spark.sql.autoBroadcastJoinThreshold``, otherwise both are shuffled and adaptive execution splits
skewed partitions. ``hot_keys`` adds explicit salting for clusters that run without it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SALT = "_salt"
_HOT_LIMIT = 100


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(key) for key in keys])


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = 0.02) -> list[int]:
    """Hashes of the keys that hold at least ``share`` of the rows: at most 100 of them.

    One pass over the key columns with a fixed-size sketch. The sketch is approximate, but it only
    decides which keys are salted, never which rows are joined.
    """
    if share < 1 / _HOT_LIMIT:
        raise ValueError(f"share must be at least {1 / _HOT_LIMIT}")
    hashes = df.dropna(subset=list(keys)).select(_key_hash(keys).alias("h"))
    found = hashes.agg(F.count("*").alias("n"), F.expr(f"approx_top_k(h, {_HOT_LIMIT})").alias("top")).first()
    return [item["item"] for item in found["top"] if item["count"] >= share * found["n"]]


def natural_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    how: str = "inner",
    take: Sequence[str] | None = None,
    hot: Sequence[int] = (),
    salts: int = 64,
    spread_nulls: bool = False,
    side_by_side: bool = False,
) -> DataFrame:
    """Join on pairs of (left column, right column); returns all left columns and ``take`` of the right.

    Keys repeated on the right multiply the left row, as in SQL. ``how`` is ``inner`` or ``left``.
    Without the options below this is a plain join, so filters and column choices above it reach the scans.

    Left rows of the ``hot`` keys are spread over ``salts`` shuffle keys and the right rows of those
    keys alone are repeated for each. The salt depends on key and input partition only, so a
    recomputed task repeats it. It keeps filters above the join from reaching the left scan.

    ``spread_nulls`` is for a left join whose NULL keys hold much of the left side: those rows match nothing, so they
    are added behind the join and never shuffled. The left side is read twice for it.

    ``side_by_side`` is for keys that multiply many rows: both sides are sorted by the key, however small the right one is, so rows of one
    key come out together and repeat in the same order, which Parquet stores in a fraction of the bytes.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    left_keys, right_keys = [pair[0] for pair in on], [pair[1] for pair in on]
    take = list(right.columns if take is None else take)
    if spread_nulls and how == "left":
        null = F.lit(False)
        for key in left_keys:
            null = null | F.col(f"`{key}`").isNull()
        kinds = {f.name: f.dataType for f in right.schema.fields}
        unmatched = left.where(null).select(
            *[F.col(f"`{c}`") for c in left.columns], *[F.lit(None).cast(kinds[c]).alias(c) for c in take]
        )
        return natural_join(left.where(~null), right, on, how, take, hot, salts, side_by_side=side_by_side).unionAll(unmatched)
    left_columns = left.columns
    if hot:
        # both sides must hash a key alike, or a salted row would miss its match
        kinds = dict(left.dtypes), dict(right.dtypes)
        unlike = [pair for pair in on if kinds[0][pair[0]] != kinds[1][pair[1]]]
        if unlike:
            raise ValueError(f"salted keys must have equal types on both sides: {unlike}")
        spread = F.pmod(_key_hash(left_keys) + F.spark_partition_id(), F.lit(salts)).cast("int")
        left = left.withColumn(_SALT, F.when(_key_hash(left_keys).isin(list(hot)), spread).otherwise(F.lit(0)))
        copies = F.when(_key_hash(right_keys).isin(list(hot)), F.sequence(F.lit(0), F.lit(salts - 1)))
        right = right.select(*dict.fromkeys([*right_keys, *take]))
        right = right.withColumn(_SALT, F.explode(copies.otherwise(F.array(F.lit(0)))))
        on = [*on, (_SALT, _SALT)]
    if side_by_side:
        right = right.hint("merge")
    condition = None
    for left_key, right_key in on:
        equal = F.col(f"l.`{left_key}`") == F.col(f"r.`{right_key}`")
        condition = equal if condition is None else condition & equal
    joined = left.alias("l").join(right.alias("r"), condition, how)
    return joined.select(*[F.col(f"l.`{c}`") for c in left_columns], *[F.col(f"r.`{c}`") for c in take])


def lookup_one(
    left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], take: Sequence[str], hot: Sequence[int] = ()
) -> DataFrame:
    """Left join with at most one match per row: of several, the one with the smallest ``take`` values."""
    right_keys = [pair[1] for pair in on]
    one = (
        right.dropna(subset=right_keys)
        .groupBy(*right_keys)
        .agg(F.min(F.struct(*take)).alias("_one"))
        .select(*right_keys, *[F.col(f"_one.`{c}`").alias(c) for c in take])
    )
    return natural_join(left, one, on, "left", take, hot)
