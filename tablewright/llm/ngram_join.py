"""Jaccard join on word shingles by T-occurrence search (operator 7).

A document is the set of its shingle hashes. Two sets of m and n shingles that are similar enough share at least T of them,
T depending on m and n. Each document orders its shingles from rare to frequent; its longest inverted lists, those of
its most frequent shingles, are left out of the merge (DivideSkip), as many as still leave any partner in one of the
short lists. The short lists are merged by an external sort on the shingle over all tasks; a pair that occurs in too few
of them to reach T with the lists left out is dropped, and the rest are probed by binary search in the whole sets.

Sets that are equal are joined once. Pairs are not enumerated where links are known already: first each list links its
documents with its most common one only, which draws groups of near copies together; then only pairs
between different components of those links are enumerated. So no link between different components is lost, and a group of
near copies costs a few probes per document. Documents that meet in a list carry a parity bitmap of their whole set: the bits in which two
bitmaps differ are at most the shingles in which the sets differ, so a pair that differs in too many never becomes a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tablewright.llm.components import components
from tablewright.llm.hashing import release_memory, shingles, small_batches, word_hashes
from tablewright.storage import stash

#: ids that a broadcast may hold (8 bytes each); beyond it the join shuffles
BROADCAST_IDS = 1_000_000
#: shingles whose frequency decides the order; it bounds a broadcast and changes which lists are short, never the result
FREQUENT = 500_000
_CHUNK = 1_000_000
#: bits of a set's parity bitmap, a power of two; it changes how many pairs are probed, never the result
BITS = 512
WORDS = [f"w{i}" for i in range(BITS // 64)]


def _parities(sets: list[np.ndarray]) -> list[np.ndarray]:
    """Columns ``WORDS``: per set a bit for each value of the hashes' highest bits, on if an odd number of shingles has it."""
    shift = np.uint64(64 - (BITS.bit_length() - 1))
    odd = np.zeros((len(sets), BITS), bool)
    for row, found in zip(odd, sets, strict=True):
        row[:] = np.bincount((found >> shift).astype(np.int64), minlength=BITS) & 1
    return list(np.packbits(odd, axis=1).view(np.int64).T)


def _document_sets(docs: DataFrame, width: int, key: str, text: str) -> DataFrame:
    """Rows (id, n, mark, WORDS): size, 128-bit hash and bitmap of each set; and rows (token, docs): shingles frequent within a stretch of rows."""
    schema = "id long, n long, mark binary, token long, docs long, " + ", ".join(f"{w} long" for w in WORDS)
    names = ["id", "n", "mark", "token", "docs", *WORDS]

    def frequent(parts: list[np.ndarray]) -> pa.RecordBatch:
        token, count = np.unique(np.concatenate(parts), return_counts=True)
        keep = count >= 3
        none = pa.nulls(int(keep.sum()), pa.int64())
        columns = [none, none, pa.nulls(len(none), pa.binary()), pa.array(token[keep].view(np.int64)), pa.array(count[keep])]
        columns += [none] * len(WORDS)
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for batch in small_batches(batches, text):
            words, first = word_hashes(batch.column(text))
            sets = [shingles(words[s:e], width) for s, e in zip(first[:-1], first[1:], strict=True)]
            marks = [blake2b(s, digest_size=16).digest() for s in sets]
            none = pa.nulls(len(sets), pa.int64())
            columns = [batch.column(key), pa.array([len(s) for s in sets], pa.int64()), pa.array(marks, pa.binary()), none, none]
            columns += [pa.array(word) for word in _parities(sets)]
            yield pa.RecordBatch.from_arrays(columns, names=names)
            held += sets
            size += sum(map(len, sets))
            if size > _CHUNK:
                yield frequent(held)
                held, size = [], 0
        if held:
            yield frequent(held)

    return docs.select(key, text).mapInArrow(run, schema)


def _short_lists(docs: DataFrame, order: np.ndarray, width: int, percent: int, key: str, text: str) -> DataFrame:
    """Rows (id, n, rare, tokens): the shingles of each set's short lists, and how many of all its shingles are not frequent.

    ``order``: frequent shingles, most frequent last.
    """
    rank = np.argsort(order)
    known = order[rank]
    shared = docs.sparkSession.sparkContext.broadcast((known, rank))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = shared.value
        for batch in small_batches(batches, text):
            words, first = word_hashes(batch.column(text))
            tokens, sizes, rares = [], [], []
            for s, e in zip(first[:-1], first[1:], strict=True):
                found = shingles(words[s:e], width)
                sizes.append(len(found))
                keep = len(found) - -(-percent * len(found) // 100) + 1 if len(found) else 0
                at = np.searchsorted(known, found)
                hit = at < len(known)
                hit[hit] = known[at[hit]] == found[hit]
                rare, often = found[~hit], found[hit][np.argsort(rank[at[hit]])]
                rares.append(len(rare))
                tokens.append(np.concatenate([rare, often])[:keep])
            bounds = np.zeros(len(tokens) + 1, np.int32)
            np.cumsum([len(t) for t in tokens], out=bounds[1:])
            flat = np.concatenate(tokens).view(np.int64) if tokens else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))
            columns = [batch.column(key), pa.array(sizes, pa.int64()), pa.array(rares, pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "rare", "tokens"])

    return docs.select(key, text).mapInArrow(run, "id long, n long, rare long, tokens array<long>")


def _merge_lists(entries: DataFrame) -> DataFrame:
    """Rows (token, id, n) of lists of two or more, with the list's most common document as ``head`` and its size as ``head_n``.

    That is the one with the fewest rare shingles, the smallest id of several: of copies with edits the one with the fewest edits.

    Lists meet by an external sort and stream past, one row of state, so a long list needs no memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None  # the row before, its head with its size, and whether it has been given out
        for batch in batches:
            token, id_, n = (batch.column(i).to_numpy() for i in range(3))
            if not len(token):
                continue
            if last is not None:
                token, id_, n = (np.insert(x, 0, v) for x, v in zip((token, id_, n), last[:3], strict=True))
            # repeated rows of a document count once
            keep = np.ones(len(token), bool)
            keep[1:] = (token[1:] != token[:-1]) | (id_[1:] != id_[:-1])
            token, id_, n = token[keep], id_[keep], n[keep]
            new = np.ones(len(token), bool)
            new[1:] = token[1:] != token[:-1]
            begin = np.maximum.accumulate(np.where(new, np.arange(len(token)), 0))
            head, head_n = id_[begin], n[begin]
            if last is not None:
                head[begin == 0], head_n[begin == 0] = last[3:5]
            again = ~new
            more = np.append(again[1:], False)
            give = again | more
            if last is not None and last[5]:
                give[0] = False
            out = np.flatnonzero(give)
            given = bool(give[-1]) or (len(token) == 1 and last is not None and last[5])
            last = (token[-1], id_[-1], n[-1], head[-1], head_n[-1], given)
            if len(out):
                columns = (token, id_, n, head, head_n)
                yield pa.RecordBatch.from_arrays([pa.array(x[out]) for x in columns], names=["token", "id", "n", "head", "head_n"])

    rows = entries.select("token", "id", "n", "rare").repartition("token").sortWithinPartitions("token", "rare", "id")
    rows = rows.select("token", "id", "n")
    return rows.mapInArrow(run, "token long, id long, n long, head long, head_n long")


def _whole_sets(docs: DataFrame, ids: DataFrame, width: int, key: str, text: str) -> DataFrame:
    """Rows (id, tokens as bytes) of the documents named, from their texts."""
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text):
            words, first = word_hashes(batch.column(text))
            sets = [shingles(words[s:e], width).tobytes() for s, e in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(sets, pa.binary())], names=["id", "tokens"])

    named = docs.select(F.col(key).alias("id"), text).join(ids, "id", "left_semi")
    schema = StructType([StructField("id", LongType()), StructField("tokens", BinaryType())])
    return named.select(F.col("id").alias(key), text).mapInArrow(run, schema)


def _probe(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sets reach the similarity, by binary search of the smaller set in the larger one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                small, large = sorted((np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)), key=len)
                at = np.searchsorted(large, small)
                at[at == len(large)] = 0
                both = int((large[at] == small).sum())
                keep.append(100 * both >= percent * (len(small) + len(large) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        release_memory()

    left = sets.select(F.col("id").alias("b"), F.col("tokens").alias("y"))
    right = sets.select(F.col("id").alias("a"), F.col("tokens").alias("x"))
    return pairs.select("a", "b").join(left, "b").join(right, "a").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: key, n_shingles, component_id (smallest key reachable by links, its own included).

    Links join documents with 100 * shared >= ``percent`` * union of their distinct shingles. A text of fewer words is one shingle;
    NULL, empty and blank texts have none and link with nothing, nor do rows with a NULL key (component NULL).
    Rows with equal keys get one component each; with equal texts it is the same. Other columns are not read.
    """
    found = stash(_document_sets(docs, width, key, text), "ngram-sets")
    sets = found.where("token IS NULL").select("id", "n", "mark", *WORDS)
    classes = sets.where("n > 0 AND id IS NOT NULL").groupBy("mark", "n")
    classes = classes.agg(F.min("id").alias("head"), *[F.any_value(w).alias(w) for w in WORDS])
    classes = stash(classes, "ngram-classes")

    often = found.where("token IS NOT NULL").groupBy("token").agg(F.sum("docs").alias("docs"))
    often = often.orderBy(F.desc("docs"), "token").limit(FREQUENT).select("token").toArrow()
    order = often.column("token").to_numpy().view(np.uint64)[::-1]

    short = _short_lists(docs, order, width, percent, key, text)
    heads = classes.select(F.col("head").alias("id"), F.col("n").alias("m"))
    entries = short.join(heads, "id").where("n = m").select(F.explode("tokens").alias("token"), "id", "n", "rare")
    lists = stash(_merge_lists(entries), "ngram-lists")

    # the lengths that can reach the similarity; and the occurrences needed in the short lists
    fits = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    needed = F.ceil((F.col("na") + F.col("nb")) * percent / (100 + percent))
    skipped = F.greatest(*[F.ceil(F.col(c) * percent / 100) - 1 for c in ("na", "nb")])

    def probed(pairs: DataFrame) -> DataFrame:
        pairs = stash(pairs.where(fits & (F.col("met") >= needed - skipped)).select("a", "b"), "ngram-pairs")
        ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
        whole = stash(_whole_sets(docs, stash(ids, "ngram-named"), width, key, text), "ngram-whole")
        return stash(_probe(pairs, whole, percent), "ngram-links")

    stars = lists.where("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b"), F.col("head_n").alias("na"), F.col("n").alias("nb"))
    first = probed(stars.groupBy("a", "b", "na", "nb").agg(F.count("*").alias("met")))
    known = components(first)

    # lists in which documents of different components meet. What two documents share outside the short lists of both lies in the left-out
    # lists of the one whose short lists end first, so each of them needs as many shared short lists as a pair does.
    met = lists.groupBy("id").agg(F.count("*").alias("met"))
    placed = lists.select("token", "id", "n").join(met.join(known, "id", "left"), "id")
    placed = placed.select("token", "id", "n", "met", F.coalesce("component_id", "id").alias("comp"))
    placed = stash(placed, "ngram-placed")
    mixed = placed.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("token")
    placed = stash(placed.join(mixed, "token", "left_semi"), "ngram-mixed")
    # a head that stands for two sets of one size, as repeated keys allow, has no bitmap
    bitmaps = classes.groupBy(F.col("head").alias("id"), "n").agg(*[F.when(F.count("*") == 1, F.min(w)).alias(w) for w in WORDS])
    placed = placed.join(bitmaps, ["id", "n"], "left")
    share = placed.groupBy("token", "comp").agg(F.count("*").alias("rows"))
    main = share.groupBy("token").agg(F.max_by("comp", F.struct("rows", "comp")).alias("main"))
    rest = placed.join(main, "token").where("comp <> main")
    rest = rest.select("token", "main", *[F.col(c).alias(f"{c[0]}b") for c in ("n", "met", "comp")], F.col("id").alias("b"), *[F.col(w).alias(f"{w}b") for w in WORDS])
    other = placed.select("token", *[F.col(c).alias(f"{c[0]}a") for c in ("n", "met", "comp")], F.col("id").alias("a"), *[F.col(w).alias(f"{w}a") for w in WORDS])
    # each pair once per list: a document outside the list's largest component with one inside, or with a smaller id outside
    once = (F.col("ca") != F.col("cb")) & ((F.col("ca") == F.col("main")) | (F.col("a") < F.col("b")))
    # bits in which the bitmaps differ: each is of a shingle that only one of the sets holds
    apart = sum((F.bit_count(F.col(f"{w}a").bitwiseXOR(F.col(f"{w}b"))) for w in WORDS), F.lit(0))
    near = F.coalesce(apart <= F.col("na") + F.col("nb") - 2 * needed, F.lit(True))
    meet = rest.join(other, "token").where(once & fits & (F.least("ma", "mb") >= needed - skipped) & near)
    up = F.col("a") < F.col("b")
    pair = meet.select(
        F.least("a", "b").alias("a"),
        F.greatest("a", "b").alias("b"),
        F.when(up, F.col("na")).otherwise(F.col("nb")).alias("na"),
        F.when(up, F.col("nb")).otherwise(F.col("na")).alias("nb"),
    )
    pair = pair.groupBy("a", "b", "na", "nb").agg(F.count("*").alias("met"))

    final = components(first.union(probed(pair)))
    joined = classes.join(final, F.col("head") == F.col("id"), "left")
    joined = joined.select("mark", "n", F.coalesce("component_id", "head").alias("component_id"))
    linked = sets.join(joined, ["mark", "n"], "left")
    alone = F.col("id").isNull() | (F.col("n") == 0) | F.col("component_id").isNull()
    return linked.select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id")
    )
