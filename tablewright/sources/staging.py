"""Bulk load of raw files into a staging table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tablewright.sources.readers import read_json


def stage(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    mapping: Mapping[str, str] | None = None,
    target: str | None = None,
    mode: str = "overwrite",
    recursive: bool = False,
) -> DataFrame:
    """Read JSON into the columns of ``schema``.

    Without ``mapping`` fields are matched by name. With it, ``mapping[column]`` names the JSON field
    that fills a column (columns left out keep their own name). With ``target`` the rows are written
    as Parquet, by default replacing the previous content, and the written table is returned: later
    steps then read single columns instead of parsing the JSON again.
    """
    mapping = mapping or {}
    source = StructType([StructField(mapping.get(f.name, f.name), f.dataType) for f in schema.fields])
    raw = read_json(spark, path, source, recursive=recursive)
    staged = raw.select(*[F.col(f"`{mapping.get(f.name, f.name)}`").alias(f.name) for f in schema.fields])
    if target is None:
        return staged
    staged.write.mode(mode).parquet(target)
    return spark.read.schema(staged.schema).parquet(target)
