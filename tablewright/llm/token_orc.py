"""Token ids as ORC files (operator 1).

A row holds one document: its key, its ids as ``array<int>`` (ORC writes them run-length encoded) and where they
start and end among the ids of its part. Parts are ranges of the key; rows ascend within a part, so a stripe's
minimum and maximum and the Bloom filter on the key decide whether a reader opens it. Readers split files by
stripe. The parts' sizes (one row per part) turn starts within a part into starts in the whole corpus.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from tablewright.llm.hashing import small_batches, text_bytes
from tablewright.llm.tokens import default_tokenizer, encoder


def write_token_orc(
    docs: DataFrame,
    path: str,
    tokenizer: str | None = None,
    end_id: int | None = 2,
    key: str = "doc_id",
    text: str = "text",
    stripe_bytes: int = 64 << 20,
    rows_per_index: int = 1000,
    bloom_error: float = 0.01,
) -> None:
    """Encode every whole text and write the ids in ascending order of ``key``.

    NULL text counts as empty (just the end id); NULL keys come first; rows with equal keys are all kept,
    ordered by text. Other columns are not read. An empty table gives a readable empty one.
    Texts are shuffled once, by ranges of (key, text), then encoded, so ids are never shuffled and a key that many
    rows share spreads over parts.
    """
    tokenizer = tokenizer or default_tokenizer()
    schema = StructType(
        [
            StructField(key, docs.schema[key].dataType), StructField("part", IntegerType()), StructField("part_start", LongType()), StructField("part_end", LongType()),
            StructField("ids", ArrayType(IntegerType(), False)),
        ]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts, part, done = encoder(tokenizer, end_id), TaskContext.get().partitionId(), 0
        for batch in small_batches(batches, text):
            ids, bounds = encode_texts.encode(*text_bytes(batch.column(text)))
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.view(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.repeat(pa.scalar(part, pa.int32()), len(lists)), pa.array(done + bounds[:-1]), pa.array(done + bounds[1:]), lists],
                names=schema.names,
            )
            done += int(bounds[-1])

    rows = docs.select(key, text).repartitionByRange(key, F.xxhash64(text)).sortWithinPartitions(key, text)
    writer = rows.mapInArrow(encode, schema).write.mode("overwrite")
    for option, value in {
        "orc.stripe.size": stripe_bytes,
        "orc.row.index.stride": rows_per_index,
        "orc.bloom.filter.columns": key,
        "orc.bloom.filter.fpp": bloom_error,
    }.items():
        writer = writer.option(option, str(value))
    writer.orc(path)


def read_token_orc(spark: SparkSession, path: str, keys: Sequence | None = None, key: str = "doc_id") -> DataFrame:
    """Rows of the files; with ``keys`` only those, skipping stripes and row groups by their statistics and Bloom filters."""
    rows = spark.read.orc(path)
    return rows if keys is None else rows.where(F.col(key).isin(list(keys)))


def token_digest(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row of a whole token table: key, start in the corpus, number of ids, crc32 of the ids as little-endian bytes."""
    schema = StructType(
        [StructField(key, rows.schema[key].dataType), StructField("part", IntegerType()), StructField("part_start", LongType()), StructField("n_tokens", LongType()), StructField("ids_crc32", LongType())]
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            bounds = lists.offsets.to_numpy().astype(np.int64) * 4
            ids = memoryview(np.ascontiguousarray(lists.values.to_numpy(), "<u4").view(np.uint8))
            sums = [crc32(ids[s:e]) for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), batch.column("part"), batch.column("part_start"), pa.array(np.diff(bounds) // 4), pa.array(sums, pa.int64())],
                names=schema.names,
            )

    found = rows.select(key, "part", "part_start", "ids").mapInArrow(digest, schema)
    # one row per part; the ids are not read again for it
    sizes = rows.groupBy("part").agg(F.max("part_end").alias("part_size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("part", F.coalesce(F.sum("part_size").over(before), F.lit(0)).alias("part_base"))
    return found.join(F.broadcast(sizes), "part").select(
        key, (F.col("part_base") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32"
    )
