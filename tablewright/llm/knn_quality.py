"""Quality by nearest labelled neighbours in a latent semantic space (operator 6).

A document is a bag of terms: hashed words, the shapes of its words (length, capitals, symbols, digits) and of neighbouring
words, words that repeat the one before, and how many of its words are distinct. Terms are weighted by inverse document
frequency over all documents; the space is the truncated singular value decomposition of the labelled sample. The
sample's vectors are broadcast; every document is compared with all of them in blocks and its nearest ones vote.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tablewright.llm.hashing import mix, small_batches, span_hashes, text_bytes, word_spans

WORD_TERMS, SHAPES, PAIR_TERMS, SHARES = 2048, 256, 512, 11
TERMS = WORD_TERMS + SHAPES + PAIR_TERMS + 1 + SHARES
#: labelled rows of each class that may be broadcast, and components of the space
PER_CLASS = 2048
RANK = 48
NEIGHBOURS = 128
SHARPNESS = 12.0

_KIND = np.zeros((3, 256), np.int64)
_KIND[0, 65:91] = 1
_KIND[1, 48:58] = 1
_KIND[2, [c for c in range(33, 127) if not chr(c).isalnum()]] = 1


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number below ``SHAPES`` for each word."""
    out = np.digitize(ends - starts, (3, 6, 11))
    for kind in _KIND:
        sums = np.zeros(len(data) + 1, np.int32)
        np.cumsum(kind[data], out=sums[1:])
        count = sums[ends] - sums[starts]
        out = out * 4 + np.where(count > 1, np.where(count * 2 >= ends - starts, 3, 2), count)
    return out


def term_counts(column: pa.Array) -> np.ndarray:
    """Rows x ``TERMS``: how often each term stands in each text; NULL counts as empty."""
    data, bounds = text_bytes(column)
    starts, ends, first = word_spans(data, bounds)
    words, shapes = span_hashes(data, starts, ends, lower=True), _shapes(data, starts, ends)
    out = np.zeros((len(first) - 1, TERMS), np.float32)
    term = (words >> np.uint64(53)).astype(np.int64)
    pairs = (mix((shapes[:-1] * SHAPES + shapes[1:]).astype(np.uint64)) >> np.uint64(55)).astype(np.int64)
    again = words[:-1] == words[1:]
    for row, (s, e) in enumerate(zip(first[:-1], first[1:], strict=True)):
        if s == e:
            continue
        out[row, :WORD_TERMS] = np.bincount(term[s:e], minlength=WORD_TERMS)
        at = WORD_TERMS
        out[row, at : at + SHAPES] = np.bincount(shapes[s:e], minlength=SHAPES)
        at += SHAPES
        out[row, at : at + PAIR_TERMS] = np.bincount(pairs[s : e - 1], minlength=PAIR_TERMS)
        at += PAIR_TERMS
        out[row, at] = again[s : e - 1].sum()
        distinct = len(np.unique(words[s:e])) / (e - s)
        out[row, at + 1 + int(distinct * (SHARES - 1))] = e - s
    return out


@dataclass(frozen=True)
class Space:
    """Term weights, the projection, the labelled vectors with their votes, and the score of a text without any term."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    votes: np.ndarray
    prior: float

    def project(self, counts: np.ndarray) -> np.ndarray:
        return _unit(_weighted(counts, self.idf) @ self.axes)

    def score(self, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        if not len(self.vectors):
            return np.full(len(counts), self.prior)
        likeness = self.project(counts) @ self.vectors.T
        k = min(neighbours, len(self.vectors))
        near = np.argpartition(-likeness, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(likeness, near, 1), 0.0) ** SHARPNESS * self.votes[near]
        total = weight.sum(1)
        score = (weight * self.labels[near]).sum(1) / np.maximum(total, 1e-300)
        return np.where(total > 0, np.clip(score, 0.0, 1.0), self.prior)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    rows = np.sqrt(counts / np.maximum(counts[:, :WORD_TERMS].sum(1, keepdims=True), 1)) * idf
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """In how many of all documents each term stands, and how many documents there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows = np.zeros(TERMS + 1, np.int64), 0
        for batch in small_batches(batches, text):
            for row in range(0, batch.num_rows, 512):
                part = batch.slice(row, 512)
                found[:TERMS] += (term_counts(part.column(text)) > 0).sum(0)
            rows += batch.num_rows
        found[TERMS] = rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(TERMS + 1)), pa.array(found)], names=["term", "docs"])

    rows = docs.select(text).mapInArrow(count, "term long, docs long").groupBy("term").agg(F.sum("docs").alias("docs")).collect()
    out = np.zeros(TERMS + 1, np.int64)
    for r in rows:
        out[r["term"]] = r["docs"]
    return out[:TERMS], int(out[TERMS])


def fit(docs: DataFrame, labelled: DataFrame, label: str, key: str = "doc_id", text: str = "text", per_class: int = PER_CLASS, rank: int = RANK) -> Space:
    """Space from the rows of ``labelled`` (key, label 0 or 1): of each class the ``per_class`` documents with the smallest hash of their key.

    Labels other than 0 and 1 and keys without a document do not count; of contradicting labels the smaller one does.
    """
    found, number = document_frequencies(docs, text)
    idf = np.log((number + 1) / (found + 1)).astype(np.float32) + 0.05
    labelled = labelled.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).where("y IN (0, 1) AND k IS NOT NULL")
    labelled = labelled.groupBy("k").agg(F.min("y").alias("y"))
    total = {r["y"]: r["count"] for r in labelled.groupBy("y").count().collect()}
    if not total:
        return Space(idf, np.zeros((TERMS, 1)), np.zeros((0, 1)), np.zeros(0), np.zeros(0), 0.5)
    order = (F.xxhash64("k"), "k")
    chosen = labelled.where("y = 0").orderBy(*order).limit(per_class).union(labelled.where("y = 1").orderBy(*order).limit(per_class))

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text, 1 << 20):
            raw = [row.astype("<f4").tobytes() for row in term_counts(batch.column(text))]
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("y"), pa.array(raw, pa.binary())], names=["k", "y", "counts"])

    # at most 2 * per_class rows
    rows = docs.select(F.col(key).alias("k"), text).join(F.broadcast(chosen), "k").mapInArrow(counts, "k long, y int, counts binary").toArrow()
    if not rows.num_rows:
        return Space(idf, np.zeros((TERMS, 1)), np.zeros((0, 1)), np.zeros(0), np.zeros(0), total.get(1, 0) / sum(total.values()))
    rows = rows.sort_by("k")
    labels = rows.column("y").to_numpy().astype(np.float64)
    matrix = _weighted(np.frombuffer(b"".join(rows.column("counts").to_pylist()), "<f4").reshape(-1, TERMS), idf)
    del rows
    rank = min(rank, *matrix.shape)
    basis = np.random.default_rng(11).standard_normal((TERMS, min(rank + 16, *matrix.shape))).astype(np.float32)
    for _ in range(5):
        basis, _ = np.linalg.qr(matrix.T @ (matrix @ basis))
    _, _, right = np.linalg.svd(matrix @ basis, full_matrices=False)
    axes = (basis @ right.T)[:, :rank]
    # classes are sampled alike, so votes give them their share back
    share = {y: total[y] / max(1, int((labels == y).sum())) for y in total}
    votes = np.array([share[y] for y in labels.astype(int)])
    return Space(idf, axes, _unit(matrix @ axes), labels, votes, float(total.get(1, 0) / sum(total.values())))


def score(docs: DataFrame, space: Space, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text, 0 to 1. NULL and empty texts get the share of label 1. The column must be new."""
    if name in docs.columns:
        raise ValueError(f"column {name} exists already")
    shared = docs.sparkSession.sparkContext.broadcast(space)
    schema = StructType([*docs.schema.fields, StructField(name, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text):
            for row in range(0, batch.num_rows, 512):
                part = batch.slice(row, 512)
                found = shared.value.score(term_counts(part.column(text)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.float64())], names=schema.names)

    return docs.mapInArrow(run, schema)
