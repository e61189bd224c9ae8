"""Table writers and table definitions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    mode: str = "overwrite",
    touched_only: bool = False,
    observe: Callable[[DataFrame], DataFrame] | None = None,
    index: Sequence[str] = (),
    files: int | None = None,
    row_group_bytes: int | None = None,
    laid_out: bool = False,
) -> None:
    """Write Parquet. Overwriting replaces the whole table, or with ``touched_only`` just the partitions in ``df``.

    ``partition_by`` sets the folder columns. Rows are first rebalanced by them: small partitions
    share a task instead of every task writing a file per folder, and adaptive execution splits a
    folder that holds much of the data over many tasks.

    ``laid_out`` says that the rows of each task are sorted by ``partition_by`` already: they are written as they come, without a shuffle or
    sort, and a task writes one file per folder that it has rows of. Numbers that rise evenly, as keys do in such rows, are stored as differences.

    ``cluster_by`` range-partitions by key so that a point read touches few files; ``sort_by`` orders
    rows within a key. Both are range columns, so a hot key spreads over several files. ``files`` sets the number of ranges.

    ``index`` names columns that point reads ask for though rows do not lie in their order. Each row group gets a Bloom filter of
    their values, 64 KB to 1 MB by how many there are, so a read with ``column = value`` skips the row groups without the value. ``row_group_bytes``
    makes them smaller than Parquet's 128 MB, so that a read that finds its value reads less.

    ``observe`` gets the rows as they are written, to attach ``DataFrame.observe`` to them.
    """
    if cluster_by:
        keys = [*partition_by, *cluster_by, *sort_by]
        df = df.repartitionByRange(*([files] if files else []), *keys).sortWithinPartitions(*keys)
    elif partition_by and not laid_out:
        df = df.hint("rebalance", *partition_by)
        if sort_by:
            df = df.sortWithinPartitions(*partition_by, *sort_by)
    elif sort_by:
        df = df.sortWithinPartitions(*sort_by)
    if observe:
        df = observe(df)
    if unknown := set(index) - set(df.columns):
        raise ValueError(f"no columns {sorted(unknown)} to index")
    writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic" if touched_only else "static")
    if laid_out:
        writer = writer.option("parquet.writer.version", "v2")
    if index:
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    for column in index:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_bucketed(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    buckets: int,
    sort_by: Sequence[str] = (),
    path: str | None = None,
    mode: str = "overwrite",
) -> None:
    """Catalog table bucketed by key: joins and groupings on the key then need no shuffle.

    Rows of one key share a bucket by definition; for keys that hold much of the data use
    ``write_table`` with ``cluster_by``, which splits them.
    """
    writer = df.repartition(buckets, *keys).write.mode(mode).format("parquet").bucketBy(buckets, *keys)
    writer = writer.sortBy(*(sort_by or keys))
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def write_csv(
    df: DataFrame,
    path: str,
    quote_all: bool = False,
    mode: str = "overwrite",
    records_per_file: int | None = None,
    compression: str | None = None,
) -> None:
    """CSV with a header line; ``quote_all`` quotes every field and header. Empty texts and NULL are read back as NULL.

    Texts with line breaks are written in quotes, and such files are read whole by one task each, so give
    ``records_per_file`` where the rows of a task would make too large a file. ``compression`` (``gzip``) makes the text some eight times smaller;
    compressed files are read whole by one task each too.
    """
    writer = df.write.mode(mode).option("header", True).option("quoteAll", quote_all).option("escape", '"')
    if records_per_file:
        writer = writer.option("maxRecordsPerFile", records_per_file)
    writer.csv(path, compression=compression)


def load_table(df: DataFrame, target: str, columns: Sequence[str], mode: str = "append") -> None:
    """Load rows into a table; ``columns`` names the target columns in the order of ``df``'s columns.

    ``target`` is a Parquet path (anything with a slash) or a catalog table, whose columns not named
    are filled with NULL. ``mode`` is ``append`` or ``truncate`` (replace the content).
    """
    if mode not in ("append", "truncate"):
        raise ValueError(f"mode must be append or truncate, not {mode!r}")
    if len(columns) != len(df.columns):
        raise ValueError(f"{len(columns)} target columns for {len(df.columns)} source columns")
    named = df.toDF(*columns)
    if "/" in target:
        # static mode, so that the whole table and not single partitions is replaced
        writer = named.write.mode("overwrite" if mode == "truncate" else "append")
        writer.option("partitionOverwriteMode", "static").parquet(target)
        return
    schema = df.sparkSession.table(target).schema
    unknown = set(columns) - set(schema.names)
    if unknown:
        raise ValueError(f"{target} has no columns {sorted(unknown)}")
    row = [F.col(f.name) if f.name in columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    named.select(*row).write.insertInto(target, overwrite=mode == "truncate")


def publish_table(df: DataFrame, table: str, base_path: str) -> str:
    """Refresh a catalog table without a moment in which readers see it empty.

    The rows go to a new folder below ``base_path``; then the table is pointed at it. ``df`` may read
    the table's previous content. Returns the new folder; old ones are left to the caller.
    """
    spark = df.sparkSession
    path = f"{base_path.rstrip('/')}/{uuid4().hex}"
    df.write.parquet(path)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=path, source="parquet", schema=df.schema)
    return path


def create_table(
    spark: SparkSession, table: str, schema: StructType, path: str | None = None, if_not_exists: bool = True
) -> None:
    """Declare an empty Parquet table; an existing one is kept or, without ``if_not_exists``, an error."""
    if if_not_exists and spark.catalog.tableExists(table):
        return
    spark.catalog.createTable(table, path=path, source="parquet", schema=schema)


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")
