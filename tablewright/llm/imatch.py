"""I-Match document fingerprints (operator 5).

Terms whose inverse document frequency lies in a band make up the lexicon; what is too common says nothing, what is too rare is
noise. A fingerprint has many parts, each the hash of a document's distinct terms, sorted, within one random subset of
the lexicon. Subsets of several densities are used, so that short and long documents both have parts with a few terms, and two
documents agree in about as many of these as they share terms.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import sha256
from zlib import compress, decompress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tablewright.llm.hashing import mix, small_batches, word_hashes

DENSITIES = (1 / 6, 1 / 36, 1 / 216, 1 / 1296)
SUBSETS = 24
_CHUNK = 4_000_000
_SEEDS = mix(np.arange(1, len(DENSITIES) * SUBSETS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_LIMITS = np.repeat([np.uint64(int(d * 2**64)) for d in DENSITIES], SUBSETS)


def lexicon(docs: DataFrame, low: float = math.log(20), high: float = math.log(5000), text: str = "text") -> np.ndarray:
    """Ascending hashes of the terms with low <= ln(documents / documents with the term) <= high, in two documents or more.

    Counts cover all documents. There are at most exp(high) times as many terms as a document has distinct terms on
    average, whatever the number of documents: with the defaults some ten MB, which is what gets broadcast.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            term, found = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(found)], names=["term", "docs"])

        for batch in small_batches(batches, text):
            words, first = word_hashes(batch.column(text))
            held += [np.unique(words[s:e]) for s, e in zip(first[:-1], first[1:], strict=True)]
            size += len(words)
            if size > _CHUNK:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    counts = docs.select(text).mapInArrow(count, "term long, docs long").groupBy("term").agg(F.sum("docs").alias("docs"))
    number = docs.count()
    band = counts.where((F.col("docs") >= 2) & F.col("docs").between(number * math.exp(-high), number * math.exp(-low)))
    return np.sort(band.select("term").toArrow().column("term").to_numpy().view(np.uint64))


def fingerprint(words: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """16-bit hashes of the distinct words within each subset of the lexicon, 0 for none. Without a word in the lexicon all words count."""
    distinct = np.unique(words)
    at = np.searchsorted(terms, distinct)
    known = at < len(terms)
    known[known] = terms[at[known]] == distinct[known]
    kept = distinct[known] if known.any() else distinct
    out = np.zeros(len(_SEEDS), np.uint64)
    for s in range(0, len(kept), 4096):
        marks = mix(kept[s : s + 4096, None] ^ _SEEDS[None, :])
        row, subset = np.nonzero(marks < _LIMITS[None, :])
        # the sum of well-mixed hashes of distinct terms: the hash of the set, whatever the order
        np.add.at(out, subset, mix(marks[row, subset] + np.uint64(1)))
    return np.where(out > 0, np.uint64(1) + (out >> np.uint64(16)) % np.uint64(65535), np.uint64(0)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of agreeing parts among those in which either has a term: of the density where it is largest, given eight such parts. 1 if both are empty."""
    filled = ((a > 0) | (b > 0)).reshape(len(DENSITIES), SUBSETS)
    same = ((a == b) & (a > 0)).reshape(len(DENSITIES), SUBSETS)
    count = filled.sum(1)
    if not count.any():
        return 1.0
    share = same.sum(1) / np.maximum(count, 1)
    return float(share[count >= 8].max()) if (count >= 8).any() else float(same.sum() / count.sum())


def _text(parts: np.ndarray) -> str:
    return parts.astype(">u2").tobytes().hex()


def compare_with_next(docs: DataFrame, terms: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the second half (n // 2 code points) replaced by the first as many of the next row's text, in ascending
    order of key (NULL keys first, equal ones by a hash of their text; after the last row comes the first). NULL text is empty. Rows are
    dealt out by ranges of the key, and the first row of each range also goes to the range before, so each text is shuffled once, packed,
    and no task needs another's rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.xxhash64(text).alias("tie"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    points = F.array(*[F.lit(i / parts) for i in range(1, parts)] or [F.lit(0.5)])
    row = docs.agg(F.percentile_approx("key", points, F.lit(10_000)).alias("cuts"), F.min("key").alias("least"), F.count_if(F.col("key").isNull()).alias("nulls")).first()
    least = None if row["nulls"] else row["least"]
    # ranges start at keys that exist, above the smallest
    cuts = np.array(sorted({c for c in row["cuts"] or [] if c > row["least"]}), np.int64)
    dealt_schema = StructType([StructField("bucket", IntegerType()), StructField("ahead", IntegerType()), StructField("key", LongType()), StructField("tie", LongType()), StructField("packed", BinaryType())])
    out_schema = StructType(
        [StructField(key, LongType()), StructField("n_chars", LongType()), StructField("edited_sha256", StringType()), StructField("fingerprint", StringType()),
         StructField("edited_fingerprint", StringType()), StructField("near_edited", DoubleType()), StructField("near_next", DoubleType())]
    )

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            packed = pa.array([compress(t.encode(), 1) for t in batch.column("text").to_pylist()], pa.binary())
            batch = pa.RecordBatch.from_arrays([batch.column("key"), batch.column("tie"), packed], names=["key", "tie", "packed"])
            keys = batch.column("key").fill_null(0).to_numpy().astype(np.int64)
            null = ~batch.column("key").is_valid().to_numpy(zero_copy_only=False)
            bucket = np.where(null, 0, np.searchsorted(cuts, keys, "right"))
            first = np.zeros(len(keys), bool)
            if len(cuts):
                first = ~null & np.isin(keys, cuts)
            start = null if least is None else ~null & (keys == least)
            copies = np.concatenate([np.flatnonzero(first), np.flatnonzero(start)])
            to = np.concatenate([bucket[first] - 1, np.full(int(start.sum()), len(cuts))])
            taken = batch.take(pa.array(copies))
            for rows, where, ahead in ((batch, bucket, 0), (taken, to, 1)):
                if rows.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(where, pa.int32()), pa.array(np.full(len(where), ahead), pa.int32()), *rows.columns], names=dealt_schema.names
                    )

    shared = spark.sparkContext.broadcast(terms)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value
        held: tuple | None = None  # the last row, waiting for its next: bucket, key, text, fingerprint
        for batch in small_batches(batches, "packed", 1 << 20):
            texts = [decompress(p).decode() for p in batch.column("packed").to_pylist()]
            words, bounds = word_hashes(pa.array(texts, pa.string()))
            rows = zip(*(batch.column(c).to_pylist() for c in ("bucket", "ahead", "key")), texts, strict=True)
            pairs = []
            for i, (bucket, ahead, key_, text_) in enumerate(rows):
                if ahead and (held is None or held[0] != bucket):
                    continue
                mark = fingerprint(words[bounds[i] : bounds[i + 1]], terms)
                if held is not None and held[0] == bucket:
                    half = len(held[2]) // 2
                    pairs.append((held, held[2][: len(held[2]) - half] + text_[:half], mark))
                held = None if ahead else (bucket, key_, text_, mark)
            edited_words, edited_bounds = word_hashes(pa.array([p[1] for p in pairs], pa.string()))
            out = []
            for i, (own, edited, next_mark) in enumerate(pairs):
                mark = fingerprint(edited_words[edited_bounds[i] : edited_bounds[i + 1]], terms)
                out.append((own[1], len(own[2]), sha256(edited.encode()).hexdigest(), _text(own[3]), _text(mark), likeness(own[3], mark), likeness(own[3], next_mark)))
            if out:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=out_schema.names)

    dealt = docs.mapInArrow(deal, dealt_schema).repartitionById(len(cuts) + 1, F.col("bucket"))
    return dealt.sortWithinPartitions("bucket", "ahead", "key", "tie").mapInArrow(compare, out_schema)
