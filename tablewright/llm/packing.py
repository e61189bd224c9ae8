"""Packing documents into sequences by bin completion (operator 10).

Only the number of pieces of each length matters for which lengths share a sequence, and there are at most
``capacity`` lengths, however many documents there are. So the lengths are counted on Spark, the plan (which lengths
stand together, how often) is found on the counts, and pieces take their places by their rank among pieces
of their length: a lookup per row, no grouping of rows by sequence.

The plan is a branch and bound: around the longest piece left it enumerates fillings of the rest of the sequence
that no other filling dominates, takes each as often as the counts allow, and gives up a branch when the room it
has wasted means that it cannot beat the best plan known. The first plan known is best-fit decreasing.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tablewright.llm.hashing import PIECE_BYTES, small_batches, text_bytes
from tablewright.llm.tokens import default_tokenizer, encoder
from tablewright.storage import stash

Plan = list[tuple[tuple[int, ...], int]]

FILLINGS = 4
FIRSTS = 128
NODES = 6_000


def pieces(docs: DataFrame, capacity: int = 1024, tokenizer: str | None = None, end_id: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per piece of each encoded text: key, piece, start, length, ids_crc32.

    A text of more than ``capacity`` ids (the end id included) is cut into pieces of ``capacity``; what does not fill one
    comes first. NULL text counts as empty and gives the end id. Rows with equal keys stay rows of their own.
    """
    tokenizer = tokenizer or default_tokenizer()
    schema = StructType(
        [StructField(key, docs.schema[key].dataType), StructField("piece", IntegerType()), StructField("start", LongType()), StructField("length", LongType()), StructField("ids_crc32", LongType())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = encoder(tokenizer, end_id)
        for batch in small_batches(batches, text, PIECE_BYTES):
            ids, bounds = encode_texts.encode(*text_bytes(batch.column(text)))
            raw = memoryview(ids.astype("<u4", copy=False).view(np.uint8))
            size = np.diff(bounds)
            number = -(-size // capacity)
            row = np.repeat(np.arange(len(size)), number)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
            head = size - (number - 1) * capacity
            start = np.where(piece == 0, 0, head[row] + (piece - 1) * capacity)
            length = np.where(piece == 0, head[row], capacity)
            at = (bounds[row] + start) * 4
            sums = [crc32(raw[s:e]) for s, e in zip(at.tolist(), (at + length * 4).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(sums, pa.int64())],
                names=schema.names,
            )

    return docs.select(key, text).mapInArrow(cut, schema)


def best_fit_decreasing(counts: np.ndarray, capacity: int) -> Plan:
    """Plan that puts each length, longest first, where the least room is left; ``counts[n]`` pieces have length n."""
    open_: dict[int, Counter[tuple[int, ...]]] = defaultdict(Counter)
    for size in range(capacity, 0, -1):
        left = int(counts[size])
        while left:
            room = next((r for r in range(size, capacity + 1) if open_.get(r)), None)
            if room is None:
                fits = capacity // size
                if left >= fits:
                    open_[capacity - fits * size][(size,) * fits] += left // fits
                    left %= fits
                if left:
                    open_[capacity - left * size][(size,) * left] += 1
                break
            pattern, number = next(iter(open_[room].items()))
            used = min(number, left)
            open_[room][pattern] -= used
            if not open_[room][pattern]:
                del open_[room][pattern]
            open_[room - size][(*pattern, size)] += used
            left -= used
    return [(p, n) for groups in open_.values() for p, n in groups.items()]


def fillings(counts: np.ndarray, room: int, most: int = FILLINGS) -> list[tuple[int, ...]]:
    """Undominated ways to fill ``room``, the fullest first.

    One piece that fills the room dominates all else. Otherwise a pair counts only if it holds more than the largest
    single piece that fits, since that piece could take its place, and with the largest partner that fits; triples count
    where no pair fills the room. While the room is much larger than any piece, the largest ones fill it until it is not.
    """
    have = counts[: room + 1] > 0
    sizes = np.flatnonzero(have)
    if not len(sizes):
        return [()]
    largest = int(sizes[-1])
    if room > 4 * largest:
        number = min(int(counts[largest]), room // largest - 3)
        rest = counts.copy()
        rest[largest] -= number
        return [(largest,) * number + f for f in fillings(rest, room - number * largest, most)]
    if largest == room:
        return [(largest,)]
    # below[n]: the largest length up to n that is there
    below = np.maximum.accumulate(np.where(have, np.arange(room + 1), 0))
    below_two = np.maximum.accumulate(np.where(counts[: room + 1] > 1, np.arange(room + 1), 0))

    def partner(high: np.ndarray, left: np.ndarray) -> np.ndarray:
        """The largest length that fits beside ``high`` and is no longer than it."""
        return np.where(left < high, below[np.minimum(left, room)], np.maximum(below[high - 1], np.where(below_two[high] == high, high, 0)))

    high = sizes[::-1]
    low = partner(high, room - high)
    full = high + low
    good = np.flatnonzero((low > 0) & (full > largest))
    # of fillings that are as full, the one that can be taken most often comes first: it keeps scarce lengths for the rest
    often = np.where(high == low, counts[high] // 2, np.minimum(counts[high], counts[low]))
    good = good[np.lexsort((-often[good], -full[good]))][:most]
    found = [(int(high[i]), int(low[i])) for i in good]
    if not found or sum(found[0]) < room:
        first = high[:FIRSTS, None]
        second = np.broadcast_to(high[None, :], (len(first), len(high)))
        left = room - first - second
        ok = (second <= first) & (left > 0) & ((second < first) | (counts[second] > 1))
        third = np.where(ok, partner(second, np.maximum(left, 0)), 0)
        full = np.where(ok & (third > 0), first + second + third, 0)
        often = np.minimum(np.minimum(counts[first], counts[second]), counts[third])
        for i in np.lexsort((-often.ravel(), -full.ravel()))[:most].tolist():
            a, b = divmod(i, len(high))
            triple = (int(first[a, 0]), int(high[b]), int(third[a, b]))
            if full[a, b] > largest and all(counts[x] >= n for x, n in Counter(triple).items()):
                found.append(triple)
    found.append((largest,))
    def order(filling: tuple[int, ...]) -> tuple:
        return -sum(filling), -min(int(counts[x]) // n for x, n in Counter(filling).items()), len(filling), filling

    found = sorted(set(found), key=order)[:most]
    return [f + _top_up(counts, f, room, int(sizes[0])) for f in found]


def _top_up(counts: np.ndarray, filling: tuple[int, ...], room: int, smallest: int) -> tuple[int, ...]:
    """More pieces, largest first, while any still fits."""
    used, more, left = Counter(filling), [], room - sum(filling)
    size = left
    while left >= smallest and size >= smallest:
        if counts[size] > used[size]:
            number = min(left // size, int(counts[size]) - used[size])
            more += [size] * number
            used[size] += number
            left -= number * size
        size = min(size - 1, left)
    return tuple(more)


def least_sequences(counts: np.ndarray, capacity: int) -> int:
    """A number that no plan can go below: pieces over half a sequence stand apart, and what does not fit beside them needs more."""
    lengths = np.arange(capacity + 1)
    number, ids = np.cumsum(counts), np.cumsum(counts * lengths)
    k = np.arange(capacity // 2 + 1)
    half = capacity // 2
    alone = number[-1] - number[half]
    beside = np.maximum(capacity - k, half)
    room = capacity * (number[beside] - number[half]) - (ids[beside] - ids[half])
    small = ids[half] - np.where(k > 0, ids[np.maximum(k - 1, 0)], 0)
    return int((alone + np.maximum(0, -((room - small) // capacity))).max())


def plan_lengths(counts: np.ndarray, capacity: int, nodes: int = NODES) -> Plan:
    """Patterns of lengths with the number of sequences made of each, as few sequences as the search finds.

    It ends when a plan meets ``least_sequences`` (then none is better) or after ``nodes`` fillings have been chosen;
    the first way down is always finished. It depends on the counts only, so reruns agree.
    """
    counts = counts.astype(np.int64).copy()
    total = int((counts * np.arange(len(counts))).sum())
    incumbent = best_fit_decreasing(counts, capacity)
    fewest, bound = sum(n for _, n in incumbent), least_sequences(counts, capacity)
    # depth first; an entry is (counts, ids left, sequences so far, plan so far as a linked list)
    stack: list[tuple[np.ndarray, int, int, tuple | None]] = [(counts, total, 0, None)]
    chosen, descents = 0, 0
    while stack and fewest > bound and (chosen < nodes or not descents):
        now, ids, made, so_far = stack.pop()
        now = now.copy()
        # room wasted so far shows in made: the rest needs its ids over the capacity at least
        while ids and made + -(-ids // capacity) < fewest and (chosen < nodes or not descents):
            chosen += 1
            longest = int(np.flatnonzero(now)[-1])
            now[longest] -= 1
            options = fillings(now, capacity - longest)
            now[longest] += 1
            for filling in reversed(options):
                pattern = (longest, *filling)
                need = Counter(pattern)
                number = min(int(now[x]) // n for x, n in need.items())
                if filling is options[0]:
                    for x, n in need.items():
                        now[x] -= n * number
                    ids -= number * sum(pattern)
                    made += number
                    so_far = (pattern, number, so_far)
                elif len(stack) < nodes:
                    after = now.copy()
                    for x, n in need.items():
                        after[x] -= n * number
                    stack.append((after, ids - number * sum(pattern), made + number, (pattern, number, so_far)))
        descents += 1
        if not ids and made < fewest:
            fewest, incumbent, node = made, [], so_far
            while node:
                incumbent.append((node[0], node[1]))
                node = node[2]
    return sorted(incumbent, reverse=True)


def _places(plan: Plan) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length, intervals of its ranks: first rank, sequence of the first rank, offset."""
    out: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    taken: Counter[int] = Counter()
    sequence = 0
    for pattern, number in plan:
        offset = 0
        for size in pattern:
            out[size].append((taken[size], sequence, offset))
            taken[size] += number
            offset += size
        sequence += number
    return {size: tuple(np.array(x, np.int64) for x in zip(*rows, strict=True)) for size, rows in out.items()}


def pack(items: DataFrame, capacity: int = 1024, length: str = "length", order: tuple[str, ...] = ()) -> DataFrame:
    """Every row with ``sequence_id`` and ``offset``: rows of at most ``capacity`` in as few sequences as the search finds.

    ``order`` makes reruns agree: rows are ranked within their length by it. Lengths of 0 or NULL, or beyond the
    capacity, are an error. The two columns must not exist yet. An empty table stays empty.
    A length that a third of all rows share is ranked over many parts (ranges of length and order).
    """
    if clash := {"sequence_id", "offset"} & set(items.columns):
        raise ValueError(f"columns exist already: {sorted(clash)}")
    if {"_part", "_rank"} & set(items.columns):
        raise ValueError("columns _part and _rank are used inside")
    size = F.col(length)
    items = items.withColumn(
        length, F.when((size > 0) & (size <= capacity), size).otherwise(F.raise_error(F.lit(f"{length} must lie in 1 to {capacity}")).cast("long"))
    )
    ranked_schema = StructType([*items.schema.fields, StructField("_part", IntegerType()), StructField("_rank", LongType())])

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            sizes = batch.column(length).to_numpy().astype(np.int64)
            # rows ascend by length
            first = np.searchsorted(sizes, np.arange(capacity + 2))
            ranks = np.arange(len(sizes)) - first[sizes] + seen[sizes]
            seen += np.diff(first)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.repeat(pa.scalar(part, pa.int32()), len(sizes)), pa.array(ranks)], names=ranked_schema.names
            )

    ranked = items.repartitionByRange(length, *order).sortWithinPartitions(length, *order).mapInArrow(rank, ranked_schema)
    ranked = stash(ranked, "packing-ranked")
    # at most one row per part and length, and parts are ranges of length: parts + capacity rows
    counted = ranked.groupBy("_part", length).agg(F.count("*").alias("n"))
    before = Window.partitionBy(length).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).collect()
    base = {(r["_part"], r[length]): r["base"] for r in counted}
    counts = np.zeros(capacity + 1, np.int64)
    for r in counted:
        counts[r[length]] += r["n"]
    places = _places(plan_lengths(counts, capacity))
    kept = items.columns
    out_schema = StructType([*items.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(length).to_numpy().astype(np.int64)
            parts, ranks = batch.column("_part").to_numpy(), batch.column("_rank").to_numpy().astype(np.int64)
            sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            groups, group = np.unique(parts.astype(np.int64) * (capacity + 1) + sizes, return_inverse=True)
            order_, ends = np.argsort(group, kind="stable"), np.cumsum(np.bincount(group, minlength=len(groups)))
            for g, rows in zip(groups.tolist(), np.split(order_, ends[:-1]), strict=True):
                part, n = divmod(g, capacity + 1)
                rank_ = ranks[rows] + base[part, n]
                lows, sequences, offsets = places[n]
                at = np.searchsorted(lows, rank_, "right") - 1
                sequence[rows], offset[rows] = sequences[at] + rank_ - lows[at], offsets[at]
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], names=out_schema.names)

    return ranked.mapInArrow(place, out_schema)
