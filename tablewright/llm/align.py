"""Cross-tokenizer alignment by pointer jumping (operator 13).

Two tokenizers cut the same bytes, a space and the text, into tokens. Tokens of the two that overlap are linked; the offsets where tokens of
both end cut the text into groups. Every token points to the one that reaches farthest right among those it overlaps (of
equal ends the second tokenizer's). Pointers are doubled for all tokens at once until they rest: then each points to the last token
of its group.

Both tokenizers end a token before a single space between two other characters, so a text's groups are the groups of its segments in
a row. Workers keep what they found for the segments they met, and tokenise and align new ones only.

How many documents hold a pair of ids linked takes a pass of its own; the pairs are summed in Spark. If they are few enough to be sent
to all workers, a second pass adds them up per text; otherwise the texts' pairs are joined with the counts.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tablewright.llm.hashing import small_batches, span_hashes, text_bytes
from tablewright.llm.tokens import MAYBE_SPACE, default_tokenizer, segments
from tablewright.storage import stash

#: pairs of ids that are sent to all workers (17 bytes each); more are joined
MAX_PAIRS = 2_000_000
#: segments and links that a worker keeps
MAX_KEPT, MAX_LINKS = 600_000, 6_000_000
#: segments that are tokenised as one text
JOINED = 200

COUNTS = ("n_a", "n_b", "n_groups", "n_links")
ALIGNED = StructType([StructField(c, LongType()) for c in (*COUNTS, "n_best", "count_sum")] + [StructField("groups", StringType())])
_ARROW = pa.struct([(c, pa.int64()) for c in (*COUNTS, "n_best", "count_sum")] + [("groups", pa.string())])

_aligners: dict[tuple[str, str], Aligner] = {}
_kept_scores: dict[str, Scores] = {}


def piece_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _unicode_bytes() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, the others from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Bytes of all ids in a row."""

    def __init__(self, tokens: dict[int, bytes]) -> None:
        sizes = np.zeros(max(tokens) + 1, np.int64)
        for i, token in tokens.items():
            sizes[i] = len(token)
        self.sizes, self._at = sizes, np.cumsum(sizes) - sizes
        self._bytes = np.frombuffer(b"".join(tokens[i] for i in sorted(tokens)), np.uint8)
        #: the first byte of each id, 0 where it has none
        self.first = np.where(sizes > 0, self._bytes[np.minimum(self._at, len(self._bytes) - 1)], 0)
        # each id in decimal digits
        digits = [str(i).encode() for i in range(len(sizes))]
        self._said_sizes = np.fromiter(map(len, digits), np.int64, len(digits))
        self._said_at = np.cumsum(self._said_sizes) - self._said_sizes
        self._said = np.frombuffer(b"".join(digits), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        size = self.sizes[ids]
        return self._bytes[np.repeat(self._at[ids] - (np.cumsum(size) - size), size) + np.arange(size.sum())]

    def decimal(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Digits of all ids in a row, and the number of each."""
        size = self._said_sizes[ids]
        return self._said[np.repeat(self._said_at[ids] - (np.cumsum(size) - size), size) + np.arange(size.sum())], size

    def spell(self, ids: np.ndarray, number: np.ndarray, said: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether the tokens of each stretch (``number`` ids) give its bytes (``sizes`` of those said)."""
        whole = np.diff(np.append(0, np.cumsum(self.sizes[ids]))[np.append(0, np.cumsum(number))]) == sizes
        wrong = self.joined(ids[np.repeat(whole, number)]) != said[np.repeat(whole, sizes)]
        stretch = np.repeat(np.flatnonzero(whole), sizes[whole])
        whole[stretch[wrong]] = False
        return whole


def _encoded(call: Callable[[list[str]], list[list[int]]], texts: list[bytes], plain: np.ndarray, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all stretches in a row, and the number of each. Plain ones, a space and then none, are tokenised together: in their ids a space opens each one and nothing else."""
    number = np.zeros(len(texts), np.int64)
    at = np.flatnonzero(plain)
    blocks = [at[i : i + JOINED] for i in range(0, len(at), JOINED)]
    found, order, alone = [], [], [np.flatnonzero(~plain)]
    for block, ids in zip(blocks, call([b"".join([texts[i] for i in block]).decode("utf-8", "replace") for block in blocks]), strict=True):
        ids = np.array(ids, np.int64)
        heads = np.flatnonzero(opens[ids])
        if len(heads) == len(block) and heads[0] == 0:
            number[block] = np.diff(heads, append=len(ids))
            found.append(ids)
            order.append(block)
        else:
            alone.append(block)
    rest = np.concatenate(alone)
    single = call([texts[i].decode("utf-8", "replace") for i in rest])
    number[rest] = np.fromiter(map(len, single), np.int64, len(single))
    order, flat = np.concatenate([*order, rest]), np.concatenate([*found, *(np.array(ids, np.int64) for ids in single), np.zeros(0, np.int64)])
    # back into the order of the stretches
    size, start = number[order], np.zeros(len(texts), np.int64)
    start[order] = np.cumsum(size) - size
    return flat[np.repeat(start - (np.cumsum(number) - number), number) + np.arange(number.sum())], number


def jump(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of two rows of tokens over the same bytes, given by their ascending ends: the last token of each token's group, as a place in the second row."""
    a_starts, b_starts = np.append(0, a_ends[:-1]), np.append(0, b_ends[:-1])
    number = len(a_ends)
    # the last token of the other row that starts before the end
    to_b = np.searchsorted(b_starts, a_ends, "left") - 1
    to_a = np.searchsorted(a_starts, b_ends, "left") - 1
    to = np.concatenate([
        np.where(b_ends[to_b] >= a_ends, number + to_b, np.arange(number)),
        np.where(a_ends[to_a] > b_ends, to_a, number + np.arange(len(b_ends))),
    ])
    while True:
        farther = to[to]
        if (farther == to).all():
            return to[:number] - number, to[number:] - number
        to = farther


class Aligner:
    """Keeps for each segment met: token counts, groups, and its linked pairs of ids."""

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(a_path)
        self._a.encode_special_tokens = True
        self._b = SentencePieceProcessor(model_file=b_path)
        byte = _unicode_bytes()
        self._a_words = Vocabulary({i: bytes(byte.get(c, 0) for c in token) for token, i in self._a.get_vocab().items()})
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        self._b_words = Vocabulary(
            {
                i: bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else b"" if self._b.is_control(i) or self._b.is_unknown(i) else p.replace("▁", " ").encode()
                for i, p in enumerate(pieces)
            }
        )
        # ids that begin with a space
        self._a_opens, self._b_opens = self._a_words.first == 32, self._b_words.first == 32
        self.generation = 0
        self._forget()

    def _forget(self) -> None:
        self.generation += 1
        self._keys, self._at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._pairs: dict[int, int] = {}
        #: a << 32 | b of each pair of ids met
        self.pair_keys = np.zeros(0, np.int64)
        self.whole = np.zeros(0, bool)
        self.counts = np.zeros((0, len(COUNTS)), np.int32)
        self.groups: list[str] = []
        #: linked pairs of each segment, as places in ``pair_keys``
        self.links, self.bounds = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def places(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Places of the segments of all texts in a row, and the bounds of each text; none for texts without tokens."""
        if len(self.groups) > MAX_KEPT or len(self.links) > MAX_LINKS:
            self._forget()
        filled = pc.fill_null(column, "")
        data, bounds = text_bytes(pc.binary_join_element_wise(pa.scalar("", filled.type), filled, pa.scalar(" ", filled.type)))
        starts, ends = segments(data, bounds)
        keys = span_hashes(data, starts, ends, lower=False)
        distinct, sample, inverse = np.unique(keys, return_index=True, return_inverse=True)
        at = np.searchsorted(self._keys, distinct)
        known = at < len(self._keys)
        known[known] = self._keys[at[known]] == distinct[known]
        place = np.empty(len(distinct), np.int64)
        place[known] = self._at[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            place[new] = np.arange(len(self.groups), len(self.groups) + len(new))
            self._learn(data, starts[sample[new]], ends[sample[new]])
            self._keys, self._at = np.insert(self._keys, at[new], distinct[new]), np.insert(self._at, at[new], place[new])
        found = place[inverse]
        first = np.append(np.searchsorted(starts, bounds[:-1]), len(starts))
        # a text that is empty, or not what its tokens say, has none
        rows = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
        bad = np.diff(bounds) < 2
        bad[rows[~self.whole[found]]] = True
        number = np.where(bad, 0, np.diff(first))
        return found[~bad[rows]], np.append(0, np.cumsum(number))

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        raw = data.tobytes()
        texts = [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
        spaces = np.append(0, np.cumsum(MAYBE_SPACE[data]))
        plain = (spaces[ends] - spaces[starts] == 1) & (ends - starts > 1)
        a, a_number = _encoded(lambda found: [f.ids for f in self._a.encode_batch_fast(found, add_special_tokens=False)], texts, plain, self._a_opens)
        # this tokenizer adds the leading space itself
        b, b_number = _encoded(lambda found: self._b.encode([t[1:] for t in found], num_threads=1), texts, plain, self._b_opens)
        said = np.frombuffer(b"".join(texts), np.uint8)
        whole = self._a_words.spell(a, a_number, said, ends - starts) & self._b_words.spell(b, b_number, said, ends - starts)
        a, b = a[np.repeat(whole, a_number)], b[np.repeat(whole, b_number)]
        a_number, b_number = a_number * whole, b_number * whole
        a_ends, b_ends = np.cumsum(self._a_words.sizes[a]), np.cumsum(self._b_words.sizes[b])
        # of each token of the first row the tokens of the second that it overlaps
        a_starts, b_starts = a_ends - self._a_words.sizes[a], b_ends - self._b_words.sizes[b]
        low, high = np.searchsorted(b_ends, a_starts, "right"), np.searchsorted(b_starts, a_ends, "left")
        size = high - low
        second = b[np.repeat(low - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        distinct, inverse = np.unique(np.repeat(a, size) << 32 | second, return_inverse=True)
        places = [self._pairs.setdefault(k, len(self._pairs)) for k in distinct.tolist()]
        self.pair_keys = np.append(self.pair_keys, np.zeros(len(self._pairs) - len(self.pair_keys), np.int64))
        self.pair_keys[places] = distinct
        self.links = np.append(self.links, np.array(places, np.int32)[inverse])
        upto = np.append(0, np.cumsum(size))[np.append(0, np.cumsum(a_number))]
        self.bounds = np.append(self.bounds, self.bounds[-1] + upto[1:])
        groups, n_groups = self._grouped(a, b, a_ends, b_ends, b_number)
        self.groups += groups
        self.counts = np.concatenate([self.counts, np.stack([a_number, b_number, n_groups, np.diff(upto)], axis=1).astype(np.int32)])
        self.whole = np.append(self.whole, whole)

    def _grouped(self, a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray, b_number: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The groups of each stretch, written out, and their number."""
        if not len(a):
            return [""] * len(b_number), np.zeros(len(b_number), np.int64)
        a_last, b_last = jump(a_ends, b_ends)
        last = np.flatnonzero(b_last == np.arange(len(b)))
        # a group's ids of the first tokenizer stand before those of the second, the last of each side has its own sign behind it
        a_group, b_group = np.searchsorted(last, a_last), np.searchsorted(last, b_last)
        a_to, b_to = np.searchsorted(b_group, a_group, "left") + np.arange(len(a)), np.searchsorted(a_group, b_group, "right") + np.arange(len(b))
        signs, sizes = np.full(len(a) + len(b), ord(","), np.uint8), np.empty(len(a) + len(b), np.int64)
        signs[a_to[np.append(np.flatnonzero(np.diff(a_group)), len(a) - 1)]] = ord("|")
        signs[b_to[last]] = ord(";")
        (a_said, sizes[a_to]), (b_said, sizes[b_to]) = self._a_words.decimal(a), self._b_words.decimal(b)
        first = np.zeros(len(signs), bool)
        first[a_to] = True
        stops = np.cumsum(sizes + 1)
        out = np.empty(stops[-1], np.uint8)
        out[stops - 1] = signs
        digit = np.ones(len(out), bool)
        digit[stops - 1] = False
        side = np.repeat(first, sizes + 1)
        out[digit & side], out[digit & ~side] = a_said, b_said
        # groups belong to the stretch of their last token
        upto = np.cumsum(b_number)
        at = np.append(0, np.append(0, stops[b_to])[upto]).tolist()
        raw = out.tobytes().decode()
        return [raw[s : e - 1] if e > s else "" for s, e in zip(at[:-1], at[1:], strict=True)], np.bincount(np.searchsorted(upto, last, "right"), minlength=len(b_number))

    def text_pairs(self, places: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each pair that a text links, once a text: row, place of the pair, how often it is linked."""
        row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        held, often = np.unique(row << 32 | places, return_counts=True)
        place = held & 0xFFFFFFFF
        size = self.bounds[place + 1] - self.bounds[place]
        pair = self.links[np.repeat(self.bounds[place] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        found, inverse = np.unique(np.repeat(held >> 32, size) << 32 | pair, return_inverse=True)
        number = np.bincount(inverse, weights=np.repeat(often, size), minlength=len(found)).astype(np.int64)
        return found >> 32, found & 0xFFFFFFFF, number


class Scores:
    """Counts of pairs, added up for the segments that an aligner keeps."""

    def __init__(self, keys: np.ndarray, docs: np.ndarray, best: np.ndarray) -> None:
        self._keys, self._docs, self._best = keys, docs, best
        self._generation = -1

    def of(self, aligner: Aligner) -> np.ndarray:
        """Per segment: links that are the best of their first id, and the sum of the counts of its links."""
        if self._generation != aligner.generation:
            self._generation, self._found = aligner.generation, np.zeros((0, 2), np.int64)
        if len(self._found) < len(aligner.groups):
            # not all segments that a worker has met need stand in the texts counted: unknown pairs count nothing
            at = np.searchsorted(self._keys, aligner.pair_keys)
            known = at < len(self._keys)
            known[known] = self._keys[at[known]] == aligner.pair_keys[known]
            value = np.zeros((len(at), 2), np.int64)
            value[known, 0], value[known, 1] = self._best[at[known]], self._docs[at[known]]
            done = aligner.bounds[len(self._found)]
            sums = np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(value[aligner.links[done:]], axis=0)])
            self._found = np.concatenate([self._found, np.diff(sums[aligner.bounds[len(self._found) :] - done], axis=0)])
        return self._found


def _aligner(a_path: str, b_path: str) -> Aligner:
    """The worker's aligner of two tokenizer files."""
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


def _scores(mark: str, shared: Broadcast) -> Scores:
    if mark not in _kept_scores:
        _kept_scores.clear()
        _kept_scores[mark] = Scores(*shared.value)
    return _kept_scores[mark]


def _paths(a_path: str | None, b_path: str | None) -> tuple[str, str]:
    return a_path or default_tokenizer(), b_path or piece_tokenizer()


def linked_pairs(docs: DataFrame, text: str = "text", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Rows (a, b, docs, best) of every pair of ids that some text links: how many rows of ``docs`` do, and whether no pair of ``a`` has more."""
    paths = _paths(a_path, b_path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*paths)
        generation, found = aligner.generation, np.zeros(0, np.int64)
        keys = aligner.pair_keys

        def rows() -> pa.RecordBatch:
            held = np.flatnonzero(found)
            a, b = keys[held] >> 32, keys[held] & 0xFFFFFFFF
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(found[held])], names=["a", "b", "docs"])

        for batch in small_batches(batches, text):
            places, bounds = aligner.places(batch.column(text))
            if aligner.generation != generation:
                yield rows()
                generation, found = aligner.generation, np.zeros(0, np.int64)
            keys = aligner.pair_keys
            if len(keys) > len(found):
                found = np.append(found, np.zeros(len(keys) - len(found), np.int64))
            found += np.bincount(aligner.text_pairs(places, bounds)[1], minlength=len(keys))
        yield rows()

    pairs = docs.select(text).mapInArrow(count, "a int, b int, docs long").groupBy("a", "b").agg(F.sum("docs").alias("docs"))
    pairs = stash(pairs, "linked-pairs")
    most = pairs.groupBy("a").agg(F.max("docs").alias("most"))
    return pairs.join(most, "a").select("a", "b", "docs", (F.col("docs") == F.col("most")).alias("best"))


def align(
    docs: DataFrame, text: str = "text", name: str = "aligned", a_path: str | None = None, b_path: str | None = None, max_pairs: int = MAX_PAIRS
) -> DataFrame:
    """``docs`` with ``aligned``: n_a, n_b (tokens), n_groups, n_links (overlapping occurrences), n_best (links that no other pair of their
    first id exceeds in documents), count_sum (documents of each link, added up), groups (``a1,a2|b1;a3|b2,b3``: ids of both tokenizers).

    Strings of special tokens are plain text. NULL and empty texts, and texts whose tokens do not give back their bytes, have no tokens: all
    numbers are 0, groups is ''. Each row counts as a document, repeated rows too. The column must be new; all others pass through.
    """
    if name in docs.columns:
        raise ValueError(f"column {name} exists already")
    paths = _paths(a_path, b_path)
    pairs = stash(linked_pairs(docs, text, *paths), "pair-counts")
    if pairs.count() <= max_pairs:
        rows = pairs.select(F.shiftleft(F.col("a").cast("long"), 32).bitwiseOR(F.col("b").cast("long")).alias("key"), "docs", "best").toArrow().sort_by("key")
        counts = tuple(rows.column(c).combine_chunks().to_numpy(zero_copy_only=False) if rows.num_rows else np.zeros(0, np.int64) for c in rows.column_names)
        return _aligned(docs, text, name, paths, docs.sparkSession.sparkContext.broadcast(counts))
    row = "_aligned_row"
    if row in docs.columns:
        raise ValueError(f"column {row} is used inside")
    marked = stash(docs.withColumn(row, F.monotonically_increasing_id()), "aligned-texts")
    held = _text_pairs(marked.select(row, text), row, text, paths).join(pairs, ["a", "b"])
    sums = held.groupBy(row).agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("_n_best"), F.sum(F.col("n") * F.col("docs")).alias("_count_sum"))
    whole = _aligned(marked, text, name, paths, None).join(sums, row, "left")
    added = F.col(name).withField("n_best", F.coalesce("_n_best", F.lit(0))).withField("count_sum", F.coalesce("_count_sum", F.lit(0)))
    return whole.select(*docs.columns, added.alias(name))


def _text_pairs(docs: DataFrame, row: str, text: str, paths: tuple[str, str]) -> DataFrame:
    """Rows (row, a, b, n) of the pairs that each text links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*paths)
        for batch in small_batches(batches, text):
            own, pair, number = aligner.text_pairs(*aligner.places(batch.column(text)))
            keys = aligner.pair_keys[pair]
            columns = [batch.column(row).take(pa.array(own)), pa.array(keys >> 32, pa.int32()), pa.array(keys & 0xFFFFFFFF, pa.int32()), pa.array(number)]
            yield pa.RecordBatch.from_arrays(columns, names=[row, "a", "b", "n"])

    schema = StructType([StructField(row, LongType()), StructField("a", IntegerType()), StructField("b", IntegerType()), StructField("n", LongType())])
    return docs.mapInArrow(run, schema)


def _aligned(docs: DataFrame, text: str, name: str, paths: tuple[str, str], shared: Broadcast | None) -> DataFrame:
    """``docs`` with their groups, and with the sums if the counts of pairs are given."""
    schema = StructType([*docs.schema.fields, StructField(name, ALIGNED)])
    mark = uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*paths)
        for batch in small_batches(batches, text):
            places, bounds = aligner.places(batch.column(text))
            found = aligner.counts[places]
            sums = _scores(mark, shared).of(aligner)[places] if shared is not None else np.zeros((len(places), 2), np.int64)
            total = np.concatenate([np.zeros((1, 6), np.int64), np.cumsum(np.concatenate([found, sums], axis=1), axis=0)])
            numbers = np.diff(total[bounds], axis=0)
            said = [aligner.groups[p] for p in places.tolist()]
            at = bounds.tolist()
            groups = pa.array([";".join(said[s:e]) for s, e in zip(at[:-1], at[1:], strict=True)], pa.string())
            column = pa.StructArray.from_arrays([*(pa.array(np.ascontiguousarray(c)) for c in numbers.T), groups], fields=list(_ARROW))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=schema.names)

    return docs.mapInArrow(run, schema)
