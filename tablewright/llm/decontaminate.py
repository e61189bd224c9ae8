"""Benchmark decontamination with one Aho-Corasick automaton (operator 11).

Test questions and answers are normalised to words between single spaces, and every run of ``width`` words of an item is a
pattern (a shorter item is one). The automaton holds all patterns; each worker builds it once from the broadcast patterns and
runs it over its normalised texts, whatever their number. A match gives the words it covers, and these give their places in the
original text.

The patterns are measured before they are sent out. More than ``MAX_BYTES`` of them are dealt by hash into automata of that
size, which scan one after the other; their finds are added up per row, so no pattern is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from uuid import uuid4

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tablewright.llm.hashing import small_batches, text_bytes
from tablewright.storage import stash

#: bytes of patterns in one automaton; a byte is a node of some 50 bytes at most in each worker
MAX_BYTES = 4 << 20

# lowered bytes of words; 0 separates them
_FOLD = np.zeros(256, np.uint8)
_FOLD[48:58] = np.arange(48, 58)
_FOLD[65:91] = _FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)

_SPAN = StructType([StructField("start", LongType()), StructField("end", LongType())])
FOUND = StructType(
    [StructField("n_words", LongType()), StructField("n_hit", LongType()), StructField("spans", ArrayType(_SPAN)), StructField("items", ArrayType(StringType()))]
)
_ARROW = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("items", pa.list_(pa.string()))])

_built: dict[str, Patterns] = {}


class Words:
    """The words of many texts: their places in the bytes, and the normalised text, in which each follows a space and each row ends with a line."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray) -> None:
        folded = _FOLD[data]
        part = folded != 0
        cut = np.zeros(len(data) + 1, bool)
        cut[bounds] = True
        edge = np.ones(len(data) + 1, bool)
        edge[1:-1] = part[1:] != part[:-1]
        edge |= cut
        self.starts = np.flatnonzero(part & edge[:-1])
        self.ends = np.flatnonzero(part & edge[1:]) + 1
        #: of each row its first word, and one more at the end
        self.first = np.searchsorted(self.starts, bounds)
        number = np.diff(self.first)
        # each word takes its bytes and the space before it; each row one more space and the line end
        rows = np.repeat(np.arange(len(number)), number)
        #: where the space after each word stands in the normalised text
        self.stops = np.cumsum(self.ends - self.starts + 1) + 2 * rows
        text = np.full(int((self.ends - self.starts + 1).sum()) + 2 * len(number), 32, np.uint8)
        inside = np.ones(len(text), bool)
        inside[self.stops - (self.ends - self.starts) - 1] = False
        line = np.append(0, np.cumsum(self.ends - self.starts + 1))[self.first[1:]] + 2 * np.arange(1, len(bounds))
        inside[line - 1] = inside[line - 2] = False
        text[inside] = folded[part]
        text[line - 1] = 10
        #: one character a byte
        self.text = text.tobytes().decode("latin-1")


def _windows(words: Words, row: int, width: int) -> Iterator[tuple[str, int]]:
    """Patterns of a row, spaces at both ends included, with their number of words."""
    first, last = int(words.first[row]), int(words.first[row + 1])
    width = min(width, last - first)
    for i in range(first, last - width + 1 if width else first):
        begin = words.stops[i] - (words.ends[i] - words.starts[i]) - 1
        yield words.text[begin : words.stops[i + width - 1] + 1], width


class Patterns:
    """The automaton, and of each pattern its number of words and the items that hold it."""

    def __init__(self, rows: list[tuple[bytes, int, list[str]]]) -> None:
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for place, (pattern, _, _) in enumerate(rows):
            self.automaton.add_word(pattern.decode("latin-1"), place)
        if rows:
            self.automaton.make_automaton()
        self.width = np.array([n for _, n, _ in rows], np.int64)
        self.names = sorted({item for _, _, items in rows for item in items})
        places = {item: i for i, item in enumerate(self.names)}
        self.bounds = np.cumsum([0, *(len(items) for _, _, items in rows)])
        self.items = np.array([places[item] for _, _, items in rows for item in items], np.int64)

    def scan(self, data: np.ndarray, bounds: np.ndarray) -> list[dict]:
        """What is found in each text, as ``FOUND`` says."""
        words = Words(data, bounds)
        number = np.diff(words.first)
        found = np.fromiter(chain.from_iterable(self.automaton.iter(words.text)) if len(self.width) else (), np.int64).reshape(-1, 2)
        if not len(found):
            return [{"n_words": n, "n_hit": 0, "spans": [], "items": []} for n in number.tolist()]
        last, pattern = np.searchsorted(words.stops, found[:, 0]), found[:, 1]
        depth = np.zeros(len(words.starts) + 1, np.int64)
        np.add.at(depth, last - self.width[pattern] + 1, 1)
        np.add.at(depth, last + 1, -1)
        hit = np.append(np.cumsum(depth[:-1]) > 0, False)
        # runs of words that are hit, within their rows
        apart = np.zeros(len(hit), bool)
        apart[words.first] = True
        before = np.append(False, hit[:-1])
        begin = np.flatnonzero(hit & (~before | apart))
        end = np.flatnonzero(before & (~hit | apart)) - 1
        characters = np.append(0, np.cumsum((data & 0xC0) != 0x80))
        row = np.searchsorted(words.first, begin, "right") - 1
        origin = characters[bounds[row]]
        spans: list[list[dict]] = [[] for _ in number]
        for r, s, e in zip(row.tolist(), (characters[words.starts[begin]] - origin).tolist(), (characters[words.ends[end]] - origin).tolist(), strict=True):
            spans[r].append({"start": s, "end": e})
        # each row and pattern once, then the pattern's items
        pairs = np.unique(np.stack([np.searchsorted(words.first, last, "right") - 1, pattern]), axis=1)
        size = self.bounds[pairs[1] + 1] - self.bounds[pairs[1]]
        at = np.repeat(self.bounds[pairs[1]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        holds = np.unique(np.stack([np.repeat(pairs[0], size), self.items[at]]), axis=1)
        items: list[list[str]] = [[] for _ in number]
        for r, i in zip(*holds.tolist(), strict=True):
            items[r].append(self.names[i])
        hits = np.append(0, np.cumsum(hit))[words.first]
        return [{"n_words": n, "n_hit": h, "spans": s, "items": i} for n, h, s, i in zip(number.tolist(), np.diff(hits).tolist(), spans, items, strict=True)]


def patterns(items: DataFrame, key: str = "item_id", text: str = "text", width: int = 10) -> DataFrame:
    """Distinct rows (pattern, n_words, item) of a benchmark. NULL keys are the item ''; NULL texts and texts without words have no pattern."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            words = Words(*text_bytes(batch.column("text")))
            for row, item in enumerate(batch.column("item").to_pylist()):
                found = [(p.encode("latin-1"), n) for p, n in _windows(words, row, width)]
                if found:
                    columns = [pa.array([p for p, _ in found], pa.binary()), pa.array([n for _, n in found], pa.int32()), pa.repeat(item, len(found))]
                    yield pa.RecordBatch.from_arrays(columns, names=["pattern", "n_words", "item"])

    rows = items.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))
    return rows.mapInArrow(cut, "pattern binary, n_words int, item string").distinct()


def _automaton(mark: str, shared: Broadcast) -> Patterns:
    """Built once in a worker, which keeps the last one."""
    if mark not in _built:
        _built.clear()
        _built[mark] = Patterns(shared.value)
    return _built[mark]


def _scan(docs: DataFrame, part: DataFrame, text: str, name: str) -> DataFrame:
    """``docs`` with what the patterns of ``part`` find."""
    rows = part.groupBy("pattern", "n_words").agg(F.sort_array(F.collect_set("item")).alias("items")).orderBy("pattern").toArrow()
    shared = docs.sparkSession.sparkContext.broadcast(list(zip(*(rows.column(c).to_pylist() for c in ("pattern", "n_words", "items")), strict=True)))
    mark = uuid4().hex
    schema = StructType([*docs.schema.fields, StructField(name, FOUND)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(mark, shared)
        for batch in small_batches(batches, text):
            found = automaton.scan(*text_bytes(batch.column(text)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, _ARROW)], names=schema.names)

    return docs.mapInArrow(run, schema)


def scan(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "item_id", item_text: str = "text", width: int = 10, name: str = "leaks", max_bytes: int = MAX_BYTES
) -> DataFrame:
    """``docs`` with ``leaks``: n_words, n_hit (words inside any occurrence of a pattern), spans (start and end of each run of such words,
    in code points of the original text), items (their keys as strings, sorted).

    Words are runs of letters and digits of ASCII, A-Z lowered, and of all wider characters. NULL and empty texts have no words. Repeated
    rows stay rows of their own, repeated items count once, items with equal patterns are all named. An empty benchmark hits nothing.
    The column must be new; all others pass through.
    """
    if name in docs.columns:
        raise ValueError(f"column {name} exists already")
    found = stash(patterns(benchmark, key, item_text, width), "leak-patterns")
    size = found.agg(F.coalesce(F.sum(F.length("pattern") + F.length("item")), F.lit(0)).alias("bytes")).first()["bytes"]
    slices = max(1, -(-size // max_bytes))
    if slices == 1:
        return _scan(docs, found, text, name)
    # each automaton sees every text; rows are marked first, as keys may be missing or repeated
    row, runs = "_leak_row", "_leak_runs"
    if {row, runs} & set(docs.columns):
        raise ValueError(f"columns {row} and {runs} are used inside")
    marked = stash(docs.withColumn(row, F.monotonically_increasing_id()), "leak-texts")
    parts = [
        _scan(marked.select(row, text), found.where(F.pmod(F.xxhash64("pattern"), F.lit(slices)) == i), text, name).where(f"{name}.n_hit > 0").select(row, name)
        for i in range(slices)
    ]
    hits = parts[0]
    for part in parts[1:]:
        hits = hits.union(part)
    hits = hits.groupBy(row).agg(F.flatten(F.collect_list(f"{name}.spans")).alias("spans"), F.flatten(F.collect_list(f"{name}.items")).alias("items"))
    whole = _scan(marked, found.limit(0), text, name).join(hits, row, "left")
    # spans of different automata overlap: the words inside them are counted again
    return _joined(whole, text, name).drop(row, "spans", "items")


def _joined(rows: DataFrame, text: str, name: str) -> DataFrame:
    """``rows`` with spans and items of several automata put into ``name``: spans that touch the same words become one run."""
    schema = rows.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text):
            out = []
            data, bounds = text_bytes(batch.column(text))
            words, characters = Words(data, bounds), np.append(0, np.cumsum((data & 0xC0) != 0x80))
            columns = (batch.column(c).to_pylist() for c in (name, "spans", "items"))
            for i, (own, spans, items) in enumerate(zip(*columns, strict=True)):
                if spans:
                    places = slice(words.first[i], words.first[i + 1])
                    begin = characters[words.starts[places]] - characters[bounds[i]]
                    end = characters[words.ends[places]] - characters[bounds[i]]
                    depth = np.zeros(len(begin) + 1, np.int64)
                    np.add.at(depth, np.searchsorted(begin, [s["start"] for s in spans]), 1)
                    np.add.at(depth, np.searchsorted(end, [s["end"] for s in spans]) + 1, -1)
                    hit = np.cumsum(depth) > 0
                    edge = np.diff(hit.astype(np.int8), prepend=0)
                    runs = zip(begin[edge[:-1] == 1].tolist(), end[np.flatnonzero(edge == -1) - 1].tolist(), strict=True)
                    own = own | {"n_hit": int(hit.sum()), "spans": [{"start": s, "end": e} for s, e in runs], "items": sorted(set(items))}
                out.append(own)
            columns = [pa.array(out, _ARROW) if c == name else batch.column(c) for c in schema.names]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)
