"""Keys that several loads bring: each load leaves fingerprints of its keys, and a new one is checked against these alone."""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.storage import exists

_MARKS = ["_mark1", "_mark2"]


class KeyHistory:
    """Fingerprints of the keys of all loads into a table, below ``root``.

    A key is 128 bits, whatever its columns; a load is a folder named after it, so recording a load again replaces what it left.
    Fingerprints lie in their order, with a Bloom filter for single look-ups, so that files and row groups hold narrow ranges. That two
    different keys of n share a fingerprint has a chance of about n * n / 2 ** 129.
    """

    def __init__(self, spark: SparkSession, root: str, key: Sequence[str]) -> None:
        self.spark, self.root, self.key = spark, root.rstrip("/"), list(key)

    def _folder(self, load: str) -> str:
        return md5(load.encode()).hexdigest()

    def _marked(self, rows: DataFrame) -> DataFrame:
        keys = [F.col(f"`{c}`") for c in self.key]
        marks = {name: F.xxhash64(F.lit(seed), *keys) for seed, name in enumerate(_MARKS)}
        return rows.groupBy(*self.key).agg(F.count("*").alias("cnt")).withColumns(marks)

    def repeated(self, rows: DataFrame, load: str) -> DataFrame:
        """Keys of ``rows`` held by more than one row or by an earlier load: the key, ``cnt`` (rows here), ``earlier``. NULLs are equal.

        Old tables are not read, nor what an earlier run of the same load has left.
        """
        own = self._marked(rows)
        if exists(self.spark, self.root):
            old = self.spark.read.parquet(self.root).where(F.col("load") != self._folder(load)).select(*_MARKS)
            # a left join with distinct marks; loads that all repeat a key hold it once each
            found = own.join(old.distinct().withColumn("earlier", F.lit(True)), _MARKS, "left")
        else:
            found = own.withColumn("earlier", F.lit(None).cast("boolean"))
        found = found.withColumn("earlier", F.coalesce("earlier", F.lit(False)))
        return found.where(F.col("earlier") | (F.col("cnt") > 1)).select(*self.key, "cnt", "earlier")

    def record(self, rows: DataFrame, load: str) -> None:
        """Keep the keys of a load."""
        marks = self._marked(rows).select(*_MARKS)
        writer = marks.repartitionByRange(*_MARKS).sortWithinPartitions(*_MARKS).write.mode("overwrite")
        writer.option("parquet.bloom.filter.enabled#_mark1", "true").parquet(f"{self.root}/load={self._folder(load)}")

    def check(self, rows: DataFrame, load: str, name: str) -> DataFrame:
        """A check row: no key is repeated within the load or from earlier ones."""
        n = F.col("n")
        return self.repeated(rows, load).agg(F.count("*").alias("n")).select(
            F.lit(name).alias("table_name"),
            F.lit(f"unique_key_over_loads({', '.join(self.key)})").alias("check_name"),
            (n == 0).alias("passed"),
            F.concat(n.cast("string"), F.lit(" repeated keys")).alias("detail"),
        )
