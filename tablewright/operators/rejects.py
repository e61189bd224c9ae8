"""Rows of text that do not fit their declared types, told apart from rows that are empty."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_FAULTS = "_faults"


def cast_faults(schema: StructType, required: Sequence[str] = ()) -> Column:
    """Array of texts that say which columns of a row of texts do not fit; empty if all do. NULL fits unless the column is ``required``."""
    faults = []
    for field in schema.fields:
        text = F.col(f"`{field.name}`")
        kind = field.dataType.simpleString()
        faults.append(F.when(text.isNotNull() & text.try_cast(field.dataType).isNull(), F.lit(f"{field.name}: no {kind}")))
        if field.name in required:
            faults.append(F.when(text.isNull(), F.lit(f"{field.name}: missing")))
    return F.array_compact(F.array(*faults))


def split_typed(
    df: DataFrame, schema: StructType, required: Sequence[str] = (), keep: Sequence[str] = (), faults: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows of texts as (rows that fit, with the types of ``schema``; rows that do not, as texts with ``reasons``).

    Every row is in exactly one of the two. Rejected rows have the columns of ``keep``, by default all of ``df``. ``faults`` adds
    reasons of other kinds, as an array of texts. Which columns are read later changes neither: all casts are tried.
    """
    found = cast_faults(schema, required)
    if faults is not None:
        found = F.concat(faults, found)
    marked = df.withColumn(_FAULTS, found)
    good = marked.where(F.size(_FAULTS) == 0).select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields])
    rejected = marked.where(F.size(_FAULTS) > 0).select(*[F.col(f"`{c}`") for c in keep or df.columns], F.col(_FAULTS).alias("reasons"))
    return good, rejected
