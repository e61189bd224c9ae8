"""Embedding near-duplicates with product quantisation (operator 2).

Vectors stand in coarse inverted lists as codes of their residuals in subspaces. Each vector also searches the lists whose
centroids are nearest to it: table look-ups give the product of query and coded vector, and with the coding error of each
entry an upper bound of their cosine; what passes it is compared exactly in double precision. The bound loses no pair; a pair
is missed only if neither of the two searches the other's list. The number of lists searched grows with the root of the number of lists
(``tests/llm`` measures the recall on planted pairs). Each length of vectors has an index of its own.

Equal vectors are one entry that counts its copies. Links are not written out: a task returns for each vector how many
partners it has and the smallest id it is joined with inside the task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.components import components
from tablewright.storage import stash

#: entries and queries of one comparison at most; longer lists are split into blocks
BLOCK = 2048
#: rows whose distances to all centroids are held at once
_ROWS = 512
LINKS = "id long, links long, root long"


def probes_for(lists: int) -> int:
    """How many of ``lists`` lists a vector searches."""
    return min(lists, max(8, round(0.5 * lists**0.5)))


def _closest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each row, worked out for a block of rows at a time."""
    half = 0.5 * (centres**2).sum(1)
    out = np.empty(len(rows), np.int64)
    for s in range(0, len(rows), _ROWS):
        out[s : s + _ROWS] = np.argmax(rows[s : s + _ROWS] @ centres.T - half, axis=1)
    return out


@dataclass(frozen=True)
class Index:
    """Centroids (lists x dim) and codebooks (subspaces x codes x width)."""

    centroids: np.ndarray
    books: np.ndarray

    def nearest(self, unit: np.ndarray, number: int) -> np.ndarray:
        """The nearest lists of each row, nearest first."""
        score = unit @ self.centroids.T - 0.5 * (self.centroids**2).sum(1)
        number = min(number, len(self.centroids))
        top = np.argpartition(-score, number - 1, axis=1)[:, :number]
        return np.take_along_axis(top, np.argsort(-np.take_along_axis(score, top, 1), axis=1, kind="stable"), 1)

    def encode(self, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and the residuals they stand for."""
        parts, _, width = self.books.shape
        codes, back = np.empty((len(residual), parts), np.uint8), np.empty_like(residual)
        for m in range(parts):
            piece = residual[:, m * width : (m + 1) * width]
            codes[:, m] = _closest(piece, self.books[m])
            back[:, m * width : (m + 1) * width] = self.books[m][codes[:, m]]
        return codes, back


def _kmeans(rows: np.ndarray, number: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centres = rows[rng.choice(len(rows), min(number, len(rows)), replace=False)]
    for _ in range(rounds):
        own = _closest(rows, centres)
        sums, count = np.zeros_like(centres), np.bincount(own, minlength=len(centres))
        np.add.at(sums, own, rows)
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return centres


def fit_index(sample: np.ndarray, lists: int, subspaces: int = 16, codes: int = 256, seed: int = 7) -> Index:
    """Index of a sample of unit vectors; at least one. The dimension is cut into at most ``subspaces`` equal parts."""
    rng = np.random.default_rng(seed)
    centroids = _kmeans(sample, lists, rng)
    residual = sample - centroids[_closest(sample, centroids)]
    while sample.shape[1] % subspaces:
        subspaces -= 1
    books = [_kmeans(p, codes, rng) for p in np.split(residual, subspaces, axis=1)]
    return Index(centroids, np.stack(books))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, dim)


def _unit(rows: np.ndarray) -> np.ndarray:
    # scaled first, so that squares neither overflow nor vanish
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _raw_vectors(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows (id, dim, raw): doubles as bytes; raw NULL for vectors that link with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            flat = lists.flatten()
            bad = ~np.isfinite(flat.to_numpy(zero_copy_only=False)) if len(flat) else np.zeros(0, bool)
            values = np.ascontiguousarray(flat.fill_null(0.0).to_numpy(zero_copy_only=False), "<f8") + 0.0
            raw, dims, at = [], [], 0
            for size in (0 if n is None else n for n in lists.value_lengths().to_pylist()):
                piece = values[at : at + size]
                good = size > 0 and not bad[at : at + size].any() and piece.any()
                raw.append(piece.tobytes() if good else None)
                dims.append(size if good else None)
                at += size
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(dims, pa.int32()), pa.array(raw, pa.binary())], names=["id", "dim", "raw"])

    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    return rows.mapInArrow(run, "id long, dim int, raw binary")


def _place(entries: DataFrame, index: Index, dim: int, probes: int) -> DataFrame:
    """Rows (id, weight, raw, own, probes): the list of each entry and the lists it searches."""
    shared = entries.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, batch.num_rows, BLOCK):
                part = batch.slice(row, BLOCK)
                near = shared.value.nearest(_unit(_matrix(part.column("raw"), dim)), probes).astype(np.int32)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(near.ravel()), near.shape[1]).cast(pa.list_(pa.int32()))
                columns = [part.column("id"), part.column("weight"), part.column("raw"), pa.array(near[:, 0]), lists]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "weight", "raw", "own", "probes"])

    return entries.mapInArrow(run, "id long, weight long, raw binary, own int, probes array<int>")


def _links(index: Index, place: int, dim: int, least: float, table: pa.Table) -> pa.Table:
    """One block of a list's entries against one block of the queries that search it: rows (id, links, root)."""
    is_entry = np.array(table.column("entry").to_numpy(), bool)
    e, q = table.filter(pa.array(is_entry)), table.filter(pa.array(~is_entry))
    schema = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])
    if not (e.num_rows and q.num_rows):
        return schema.empty_table()
    ids, weights, units, owns = {}, {}, {}, {}
    for side, rows in (("e", e), ("q", q)):
        rows = rows.combine_chunks()
        ids[side], weights[side], owns[side] = (rows.column(c).to_numpy() for c in ("id", "weight", "own"))
        units[side] = _unit(_matrix(rows.column("raw"), dim))
    centroid = index.centroids[place]
    residual = units["e"] - centroid
    codes, back = index.encode(residual)
    error = residual - back
    norm = np.linalg.norm(error, axis=1)
    # for a pair at the threshold or above, |q - x| <= reach, so q.error <= x.error + reach * |error|
    reach = np.sqrt(max(0.0, 2 - 2 * least))
    slack = np.minimum(norm, (units["e"] * error).sum(1) + reach * norm)
    parts, _, width = index.books.shape
    got = np.repeat((units["q"] @ centroid).astype(np.float32)[:, None], len(codes), axis=1)
    for m in range(parts):
        got += np.take((units["q"][:, m * width : (m + 1) * width] @ index.books[m].T).astype(np.float32), codes[:, m], axis=1)
    i, j = np.nonzero(got >= (least - slack - 1e-4).astype(np.float32))
    keep = ids["q"][i] != ids["e"][j]
    i, j = i[keep], j[keep]
    exact = np.empty(len(i), bool)
    for s in range(0, len(i), 65536):
        t = slice(s, s + 65536)
        exact[t] = np.einsum("ij,ij->i", units["q"][i[t]], units["e"][j[t]]) >= least
    i, j = i[exact], j[exact]
    if not len(i):
        return schema.empty_table()
    # an entry that does not search the query's list would never see this pair
    searched = e.column("probes").combine_chunks()
    searched = searched.flatten().to_numpy().reshape(len(searched), -1)
    blind = ~(searched[j] == owns["q"][i][:, None]).any(axis=1)
    q_links, e_links = np.zeros(len(ids["q"]), np.int64), np.zeros(len(ids["e"]), np.int64)
    np.add.at(q_links, i, weights["e"][j])
    np.add.at(e_links, j[blind], weights["q"][i[blind]])
    # smallest id joined with each inside the block
    q_root, e_root = ids["q"].copy(), ids["e"].copy()
    while True:
        before = q_root.sum(), e_root.sum()
        np.minimum.at(q_root, i, e_root[j])
        np.minimum.at(e_root, j, q_root[i])
        if before == (q_root.sum(), e_root.sum()):
            break
    qs, es = np.unique(i), np.unique(j)
    return pa.table(
        [np.concatenate([ids["q"][qs], ids["e"][es]]), np.concatenate([q_links[qs], e_links[es]]), np.concatenate([q_root[qs], e_root[es]])],
        schema=schema,
    )


def _sample(entries: DataFrame, number: int, rows: int, dim: int) -> np.ndarray:
    """At most ``rows`` unit vectors, those of the smallest hashes of keys; a hash threshold leaves few more before they are ordered."""
    share = min(1.0, (1.2 * rows + 1000) / number)
    hashed = entries.select("raw", F.xxhash64("id").alias("h"), "id").where(F.col("h") / 2.0**64 + 0.5 <= share)
    chosen = hashed.orderBy("h", "id").limit(rows).select("raw").toArrow()
    return _unit(_matrix(chosen.column("raw").combine_chunks(), dim))


def _searched(entries: DataFrame, number: int, dim: int, least: float, probes: int | None, max_lists: int, fit_rows: int) -> DataFrame:
    """Links of the entries of one length, by an index of their own."""
    spark = entries.sparkSession
    index = fit_index(_sample(entries, number, fit_rows, dim), min(max_lists, max(1, round(2 * number**0.5))))
    placed = stash(_place(entries, index, dim, probes or probes_for(len(index.centroids))), "pq-placed")

    # sizes of lists: one row per list
    own = {r["own"]: r["count"] for r in placed.groupBy("own").count().collect()}
    search = {r["list"]: r["count"] for r in placed.select(F.explode("probes").alias("list")).groupBy("list").count().collect()}
    blocks = [(i, -(-own[i] // BLOCK), -(-search.get(i, 0) // BLOCK)) for i in own]
    blocks = F.broadcast(spark.createDataFrame(blocks, "list int, e_blocks long, q_blocks long"))
    held = placed.select(F.lit(True).alias("entry"), F.col("own").alias("list"), *placed.columns)
    asked = placed.select(F.lit(False).alias("entry"), F.explode("probes").alias("list"), *placed.columns)
    mark = F.xxhash64("id")
    held = held.join(blocks, "list").select(
        "*", F.pmod(mark, "e_blocks").alias("e_block"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("q_blocks") - 1)).alias("q_block")
    )
    asked = asked.join(blocks, "list").select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("e_blocks") - 1)).alias("e_block"), F.pmod(mark, "q_blocks").alias("q_block")
    )
    columns = ["list", "e_block", "q_block", "entry", "id", "weight", "raw", "own", "probes"]
    shared = spark.sparkContext.broadcast(index)

    def compare(group: tuple, table: pa.Table) -> pa.Table:
        return _links(shared.value, group[0].as_py(), dim, least, table)

    met = held.select(columns).union(asked.select(columns)).groupBy("list", "e_block", "q_block")
    return met.applyInArrow(compare, LINKS)


def _compared(entries: DataFrame, least: float) -> DataFrame:
    """Links of entries whose lengths are rare: each length is one list, whose code is the zero vector, so all its pairs are compared."""

    def compare(group: tuple, table: pa.Table) -> pa.Table:
        dim = group[0].as_py()
        return _links(Index(np.zeros((1, dim)), np.zeros((1, 1, dim))), 0, dim, least, table)

    columns = ["dim", "id", "weight", "raw", F.lit(0).alias("own"), F.array(F.lit(0)).alias("probes")]
    rows = entries.select(F.explode(F.array(F.lit(True), F.lit(False))).alias("entry"), *columns)
    return rows.groupBy("dim").applyInArrow(compare, LINKS)


def near_duplicates(
    vectors: DataFrame,
    least: float = 0.9,
    probes: int | None = None,
    max_lists: int = 4096,
    fit_rows: int = 32_768,
    index_from: int = 32,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """Per row of ``vectors``: key, n_links, component_id, kept (the key is its component's smallest).

    Vectors of one length link when their cosine is ``least`` or more. Vectors that are NULL, empty, zero, or hold NULL or non-finite
    components link with nothing, as do rows with a NULL key. Rows with equal keys
    count as copies of each other's vectors do. Each length has its own index, fitted on at most ``fit_rows`` vectors, chosen by a hash of
    their keys; it holds every vector in 2 * sqrt(distinct vectors) lists, at most ``max_lists``, of which a vector searches ``probes``
    (default: ``probes_for``). Lengths of fewer than ``index_from`` distinct vectors are compared pair by pair. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    raw = stash(_raw_vectors(vectors, key, vector), "pq-raw")
    usable = F.col("raw").isNotNull() & F.col("id").isNotNull()
    entries = raw.where(usable).groupBy("raw").agg(F.min("id").alias("id"), F.count("*").alias("weight"), F.first("dim").alias("dim"))
    entries = stash(entries.select("id", "weight", "raw", "dim"), "pq-entries")
    sizes = entries.groupBy("dim").count()
    large = {r["dim"]: r["count"] for r in sizes.where(F.col("count") >= index_from).orderBy("dim").collect()}
    links = stash(_compared(entries.join(F.broadcast(spark.createDataFrame([(d,) for d in large], "dim int")), "dim", "left_anti"), least), "pq-links")
    for dim, number in large.items():
        own = entries.where(F.col("dim") == dim).select("id", "weight", "raw")
        links = links.union(stash(_searched(own, number, dim, least, probes, max_lists, fit_rows), "pq-links"))
    total = links.groupBy("id").agg(F.sum("links").alias("links"))
    joined = components(links, "id", "root")
    found = (
        entries.join(total, "id", "left")
        .join(joined, "id", "left")
        .select("raw", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component_id", "id").alias("c"))
    )
    back = raw.join(found.withColumnRenamed("raw", "r"), (F.col("raw") == F.col("r")) & usable, "left")
    component = F.coalesce("c", "id")
    return back.select(
        F.col("id").alias(key), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
