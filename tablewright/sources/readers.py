"""File readers. A schema is always given: inference would scan the data once more."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tablewright.operators.rejects import split_typed


def read_json(
    spark: SparkSession, path: str | list[str], schema: StructType, recursive: bool = False, name_filter: str = "*.json"
) -> DataFrame:
    """JSON lines. ``path`` may hold globs; ``recursive`` takes every matching file below it at any depth."""
    reader = spark.read.schema(schema)
    if recursive:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", name_filter)
    return reader.json(path)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    sep: str = ",",
    header: bool = True,
    multiline: bool = True,
) -> DataFrame:
    """Delimited files of one layout.

    With a header each file's column names are checked against the schema, since Spark would
    otherwise bind the columns by position only. ``header=False`` takes the first line as data.

    Quoted fields may hold line breaks, so work is divided by file, not within one; ``write_csv`` can bound the
    size of its files. ``multiline=False`` divides large files too. It is for data known to hold no line break:
    a record that is broken or does not fit the schema is then an error, never a row of NULLs.
    An empty field is NULL, a quoted empty one too.
    """
    reader = spark.read.schema(schema).option("sep", sep).option("header", header).option("multiLine", multiline)
    reader = reader.option("mode", "PERMISSIVE" if multiline else "FAILFAST")
    return reader.option("enforceSchema", not header).option("quote", '"').option("escape", '"').csv(path)


def read_csv_rejects(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    sep: str = ",",
    header: bool = True,
    multiline: bool = True,
    required: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Delimited files as (rows that fit the schema, rejected records).

    A record is rejected if it has more or fewer fields than the schema, if a field is no value of its type, or if a ``required`` one is
    empty. Rejects are rows (file, record, reasons): the record as it stands in the file. Together the two hold each record
    once, whatever is selected from them; each reads the files. An empty field is NULL, which fits any type. Options as for ``read_csv``.
    """
    texts = StructType([StructField(f.name, StringType()) for f in schema.fields] + [StructField("_record", StringType())])
    reader = spark.read.schema(texts).option("sep", sep).option("header", header).option("multiLine", multiline)
    # without pruning a record's fields are counted even if few of its columns are read
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_record").option("columnPruning", False)
    raw = reader.option("enforceSchema", not header).option("quote", '"').option("escape", '"').csv(path)
    fields = F.when(F.col("_record").isNotNull(), F.array(F.lit(f"not {len(schema.fields)} fields"))).otherwise(F.array().cast("array<string>"))
    raw = raw.select("*", F.col("_metadata.file_path").alias("file"))
    # the reader keeps the text of records with a wrong number of fields only
    whole = F.coalesce("_record", F.concat_ws(sep, *[_as_field(f"`{f.name}`", sep) for f in schema.fields]))
    rows = raw.select(*[f"`{f.name}`" for f in schema.fields], "file", whole.alias("record"), fields.alias("_fields"))
    return split_typed(rows, schema, required, ["file", "record"], F.col("_fields"))


def _as_field(column: str, sep: str) -> Column:
    """A value as it is written in a file: in quotes if it holds a quote, the separator or a line break."""
    text = F.coalesce(column, F.lit(""))
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    special = F.contains(text, F.lit(sep)) | F.contains(text, F.lit('"')) | F.contains(text, F.lit("\n")) | F.contains(text, F.lit("\r"))
    return F.when(special, quoted).otherwise(text)


def read_parquet(spark: SparkSession, path: str | list[str], schema: StructType | None = None) -> DataFrame:
    """Parquet files by path or glob, or a whole table folder."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(*([path] if isinstance(path, str) else path))


def dated_path(template: str, run_date: date, pad: bool = True) -> str:
    """Fill ``{year}``, ``{month}`` and ``{day}`` of a path; month and day get two digits when ``pad``."""
    width = 2 if pad else 1
    return template.format(
        year=run_date.year, month=f"{run_date.month:0{width}d}", day=f"{run_date.day:0{width}d}"
    )


def register_views(spark: SparkSession, base: str, tables: Sequence[str]) -> None:
    """Make written tables ``base/<table>`` known to SQL under their names."""
    for table in tables:
        read_parquet(spark, f"{base.rstrip('/')}/{table}").createOrReplaceTempView(table)
