"""Vector code compression: product codes whose codebooks are fitted in whole numbers, searched by LAESA pivots (operator 12).

Components become whole numbers, so distances, sums and codes are exact and do not depend on how rows are dealt out. A vector
is cut into parts of equal width, each with a codebook of its own. A few entries of the first codebook are fixed as pivots. The distances of
every part to them are computed once and kept beside the vector; in each round the distances from the pivots to the current
entries give, by the triangle inequality, a lower bound of the distance of each part and entry. The entries of the least bounds
are evaluated first, the others only where their bound does not exceed the best distance found so far.

A round is one pass over the written table: tasks return counts and sums of their parts per entry, which Spark adds up. Only
codebooks, whose size does not depend on the number of vectors, meet on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from tablewright.storage import stash

#: rows that are compared with a codebook at once, and entries that are evaluated before the bounds prune
BLOCK, FIRST = 4096, 4
#: sums that a row of partial results holds
_WIDE = 16
_OWN = ("_whole", "_far")


class Books:
    """Codebooks of vectors of one length: ``entries`` (parts x entries x width), with pivots that stay through all rounds."""

    def __init__(self, entries: np.ndarray, pivots: np.ndarray) -> None:
        self.entries, self.pivots = entries, pivots
        # parts x pivots x entries
        self._far = np.stack([np.sqrt(squares(p, e)) for p, e in zip(pivots, entries, strict=True)])

    @classmethod
    def start(cls, vectors: np.ndarray, parts: int, pivots: int) -> Books:
        """The parts of ``vectors`` as first entries; of each part the pivots are entries far from each other, the first entry first."""
        entries = np.ascontiguousarray(vectors.reshape(len(vectors), parts, -1).transpose(1, 0, 2))
        fixed = []
        for part in entries:
            chosen = [0]
            near = squares(part[:1], part)[0]
            while len(chosen) < min(pivots, len(part)):
                chosen.append(int(near.argmax()))
                near = np.minimum(near, squares(part[chosen[-1:]], part)[0])
            fixed.append(part[chosen])
        return cls(entries, np.stack(fixed))

    def distances(self, vectors: np.ndarray) -> np.ndarray:
        """Of each vector's parts to their pivots: rows x parts x pivots."""
        cut = self.cut(vectors)
        return np.stack([np.sqrt(squares(part, p)) for part, p in zip(cut, self.pivots, strict=True)], axis=1).astype(np.float32)

    def cut(self, vectors: np.ndarray) -> np.ndarray:
        return vectors.reshape(len(vectors), len(self.entries), -1).transpose(1, 0, 2)

    def assign(self, vectors: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest entry (ties: the lowest) and squared distance of each part (rows x parts), and how many pairs were evaluated."""
        code = np.empty((len(vectors), len(self.entries)), np.int64)
        best = np.empty_like(code)
        evaluated = 0
        for i, (part, entries) in enumerate(zip(self.cut(vectors), self.entries, strict=True)):
            for row in range(0, len(part), BLOCK):
                rows = slice(row, row + BLOCK)
                code[rows, i], best[rows, i], n = self._search(part[rows], entries, far[rows, i], self._far[i])
                evaluated += n
        return code, best, evaluated

    def _search(self, part: np.ndarray, entries: np.ndarray, far: np.ndarray, entry_far: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        least = np.zeros((len(entries), len(part)), np.float32)  # lower bounds, an entry a row
        for to_part, to_entry in zip(far.T, entry_far.astype(np.float32), strict=True):
            np.maximum(least, np.abs(to_entry[:, None] - to_part[None, :]), out=least)
        # single precision errs by less than this
        least -= np.float32(1e-6) * (far.max(initial=0) + np.float32(entry_far.max(initial=0)))
        np.maximum(least, 0, out=least)
        least *= least
        least *= np.float32(1 - 1e-6)
        place = np.arange(len(part))
        number = min(FIRST, len(entries))
        order = np.argpartition(least, number - 1, axis=0)[:number]
        first = np.take_along_axis(least, order, 0).argsort(axis=0, kind="stable")
        best, code, evaluated = np.full(len(part), np.iinfo(np.int64).max), np.full(len(part), len(entries)), 0
        for e in np.take_along_axis(order, first, 0):
            self._better(((part - entries[e]) ** 2).sum(1), e, place, best, code)
            least[e, place] = np.inf
            evaluated += len(part)
        # the bound of an entry's nearest parts tells which entry prunes most
        for e in np.argsort(least.min(axis=1), kind="stable") if len(part) else ():
            rows = np.flatnonzero(least[e] <= best)
            if len(rows):
                self._better(((part[rows] - entries[e]) ** 2).sum(1), np.full(len(rows), e), rows, best, code)
                evaluated += len(rows)
        return code, best, evaluated

    @staticmethod
    def _better(distance: np.ndarray, entry: np.ndarray, rows: np.ndarray, best: np.ndarray, code: np.ndarray) -> None:
        take = (distance < best[rows]) | ((distance == best[rows]) & (entry < code[rows]))
        best[rows[take]], code[rows[take]] = distance[take], entry[take]

    def digest(self) -> str:
        """Lowercase sha256 of all components by part, entry and place, decimal and comma-joined."""
        return sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``a`` and ``b``, one of which is a codebook."""
    out = np.zeros((len(a), len(b)), np.int64)
    for i in range(a.shape[1]):
        out += (a[:, i, None] - b[None, :, i]) ** 2
    return out


def _whole_rows(column: pa.Array, parts: int, scale: int) -> list[np.ndarray]:
    """Each vector in whole numbers, as long as its padded length."""
    bounds = np.append(0, np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))).astype(np.int64)
    found = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    length = int(np.diff(bounds).max(initial=0)) + parts
    # so that a sum of squared differences fits 64 bits
    if len(found) and np.abs(found).max() > isqrt(2**60 // length):
        raise ValueError(f"components beyond {isqrt(2**60 // length) / scale:.0f} do not fit 64-bit distances")
    whole = found.astype(np.int32)
    return [np.pad(whole[s:e], (0, -int(e - s) % parts)) for s, e in zip(bounds[:-1], bounds[1:], strict=True)]


def _by_length(whole: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, places and matrix of the vectors of each length."""
    sizes = np.fromiter(map(len, whole), np.int64, len(whole)) // 4
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        yield size, at, np.frombuffer(b"".join([whole[i] for i in at]), "<i4").reshape(len(at), size).astype(np.int64)


def _first_vectors(own: DataFrame, key: str, vector: str, entries: int) -> list[list]:
    """Of each of the ``entries`` smallest keys its (smallest) vector, in ascending order."""
    # keys alone are ordered; vectors are read for the chosen ones only
    ids = own.select(F.col(key).alias("_id")).distinct().orderBy(F.col("_id").asc_nulls_last()).limit(entries)
    rows = own.join(F.broadcast(ids), F.col(key).eqNullSafe(F.col("_id"))).groupBy("_id").agg(F.min(vector).alias("v"))
    return [r["v"] for r in rows.orderBy(F.col("_id").asc_nulls_last()).collect()]


def _moved(table: DataFrame, books: dict[int, Books]) -> dict[int, Books]:
    """Books after one round: entries become the rounded-down means of their parts, those without parts stay."""
    shared = table.sparkSession.sparkContext.broadcast(books)
    names = ["length", "part", "entry", "chunk", "n", *[f"s{i}" for i in range(_WIDE)]]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            far = batch.column("_far").to_pylist()
            for length, at, vectors in _by_length(batch.column("_whole").to_pylist()):
                book = shared.value[length]
                parts, entries, width = book.entries.shape
                if length not in counts:
                    counts[length], sums[length] = np.zeros((parts, entries), np.int64), np.zeros(book.entries.shape, np.int64)
                code, _, _ = book.assign(vectors, _distances(far, at, book))
                for i, part in enumerate(book.cut(vectors)):
                    np.add.at(counts[length][i], code[:, i], 1)
                    np.add.at(sums[length][i], code[:, i], part)
        for length, found in counts.items():
            part, entry = np.nonzero(found)
            rows = sums[length][part, entry]
            for chunk in range(max(1, -(-rows.shape[1] // _WIDE))):
                wide = np.zeros((len(rows), _WIDE), np.int64)
                own = rows[:, chunk * _WIDE : (chunk + 1) * _WIDE]
                wide[:, : own.shape[1]] = own
                columns = [np.full(len(rows), length), part, entry, np.full(len(rows), chunk), found[part, entry], *wide.T]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    partial = table.select("_whole", "_far").mapInArrow(add, ", ".join(f"{n} long" for n in names))
    rows = partial.groupBy(*names[:4]).agg(*[F.sum(n).alias(n) for n in names[4:]]).collect()
    moved = {length: book.entries.copy() for length, book in books.items()}
    for r in rows:
        place = slice(r["chunk"] * _WIDE, (r["chunk"] + 1) * _WIDE)
        target = moved[r["length"]][r["part"], r["entry"]]
        target[place] = [r[f"s{i}"] // r["n"] for i in range(len(target[place]))]
    return {length: Books(entries, books[length].pivots) for length, entries in moved.items()}


def _distances(far: list[bytes], at: np.ndarray, book: Books) -> np.ndarray:
    return np.frombuffer(b"".join([far[i] for i in at]), "<f4").reshape(len(at), *book.pivots.shape[:2])


def fit(table: DataFrame, books: dict[int, Books], rounds: int) -> dict[int, Books]:
    """Books after ``rounds`` rounds over a table that ``prepare`` has written."""
    for _ in range(rounds):
        books = _moved(table, books)
    return books


def prepare(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", parts: int = 4, entries: int = 256, scale: int = 1024, pivots: int = 16
) -> tuple[DataFrame, dict[int, Books]]:
    """The vectors that count, written once in whole numbers with their distances to the pivots, and the first books by length.

    Vectors that are NULL or hold NULL or non-finite components are dropped.
    """
    if used := {*_OWN, "_id"} & set(vectors.columns):
        raise ValueError(f"columns {sorted(used)} are used inside")
    if not 0 < entries <= 256:
        raise ValueError("a code is one byte: 1 to 256 entries")
    spark: SparkSession = vectors.sparkSession
    kept = vectors.where(F.coalesce(F.forall(vector, lambda x: F.abs(x) < float("inf")), F.lit(False)))
    firsts: dict[int, list] = {}
    # one row per length
    for r in kept.groupBy(F.size(vector).alias("n")).count().orderBy("n").collect():
        padded = r["n"] + -r["n"] % parts
        firsts.setdefault(padded, []).append(r["n"])
    books = {}
    for padded, lengths in firsts.items():
        # lengths that are padded to the same share their books
        zero = F.lit(0).cast(kept.schema[vector].dataType.elementType)
        own = kept.where(F.size(vector).isin(lengths)).withColumn(vector, F.concat(vector, F.array_repeat(zero, F.lit(padded) - F.size(vector))))
        found = _first_vectors(own, key, vector, entries)
        whole = _whole_rows(pa.array(found, pa.list_(pa.float64())), parts, scale)
        books[padded] = Books.start(np.stack(whole).astype(np.int64), parts, pivots)
    shared = spark.sparkContext.broadcast(books)
    others = [f for f in vectors.schema.fields if f.name != vector]
    schema = StructType([*others, StructField("_whole", BinaryType()), StructField("_far", BinaryType())])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = [row.astype("<i4").tobytes() for row in _whole_rows(batch.column(vector), parts, scale)]
            far: list[bytes] = [b""] * len(whole)
            for length, at, rows in _by_length(whole):
                for i, row in zip(at, shared.value[length].distances(rows), strict=True):
                    far[i] = row.astype("<f4").tobytes()
            columns = [batch.column(f.name) for f in others]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(whole, pa.binary()), pa.array(far, pa.binary())], names=schema.names)

    return stash(kept.mapInArrow(measure, schema), "pivot-codes"), books


def compress(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, pivots: int = 16
) -> DataFrame:
    """``vectors`` with ``code`` (two hex digits a part), ``error`` (squared distance to the coded vector, in whole numbers) and
    ``codebooks_sha256`` in place of the vector.

    NULL vectors and those with NULL or non-finite components are dropped; a component too large for exact 64-bit distances is an
    error. Codebooks start with the vectors of the smallest distinct keys (NULL last; of equal keys the smallest vector),
    fewer where there are fewer; all rows count in the means, repeated ones too. Each length of vectors has its own codebooks, a length that
    does not divide is filled up with zeros. An empty table gives an empty one. The new columns must be new; all others pass through.
    """
    new = ("code", "error", "codebooks_sha256")
    if used := set(new) & set(vectors.columns):
        raise ValueError(f"columns {sorted(used)} exist already")
    table, books = prepare(vectors, key, vector, parts, entries, scale, pivots)
    return encode(table, fit(table, books, rounds))


def encode(table: DataFrame, books: dict[int, Books]) -> DataFrame:
    """Codes of a prepared table."""
    shared = table.sparkSession.sparkContext.broadcast(books)
    digests = {length: book.digest() for length, book in books.items()}
    others = [f for f in table.schema.fields if f.name not in _OWN]
    schema = StructType([*others, StructField("code", StringType()), StructField("error", LongType()), StructField("codebooks_sha256", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = batch.column("_far").to_pylist()
            codes, errors, marks = [""] * batch.num_rows, np.zeros(batch.num_rows, np.int64), [""] * batch.num_rows
            for length, at, rows in _by_length(batch.column("_whole").to_pylist()):
                book = shared.value[length]
                code, best, _ = book.assign(rows, _distances(far, at, book))
                errors[at] = best.sum(1)
                for i, own in zip(at, code.astype(np.uint8), strict=True):
                    codes[i], marks[i] = own.tobytes().hex(), digests[length]
            columns = [batch.column(f.name) for f in others]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(codes, pa.string()), pa.array(errors), pa.array(marks, pa.string())], names=schema.names)

    return table.mapInArrow(run, schema)
