"""Language model scoring with a probabilistic suffix tree over words (operator 8).

A context is up to ``DEPTH`` words. It is kept if what follows it differs enough from what follows its suffix (a
divergence test whose threshold grows with the corpus). Next-word distributions are smoothed by absolute
discounting, towards the longest kept suffix and at last the root, which is the unigram estimate with add-one counts. A word is
scored in the state of the longest kept suffix of what stands before it in its document.

Every context-word sequence that occurs ``LEAST`` times in the training texts is listed, however large the corpus and however its
rows are laid out. So the tree grows with the input, and no sequence is shuffled on its own: what is shuffled are windows, the word, called d below,
and the three before it, a b c. They meet by c, and by c and b where c is common. All windows of c count every sequence that ends in c or whose
last but one word is c, so the tests and the look-ups of all lengths are done where the windows meet; only the counts of single words come from elsewhere.
Windows are packed by the hundred: words among the ``COMMON`` most common ones as ranks, others as hashes.
The driver gets totals, and the counts of the most common words, which tasks get with their code. Sequences stay on the executors.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.hashing import mix, release_memory, small_batches, word_hashes
from tablewright.storage import stash

DEPTH = 3
#: occurrences in all training texts from which a sequence is listed, at any size; no share of the corpus is asked for
LEAST = 2
DISCOUNT = 0.75
#: words that are written as ranks, at most; it never changes a score
COMMON = 1 << 20
#: training windows that meet in one place, about; words of more than twice as many are dealt over several places by the word before
CROWD = 300_000
#: tasks in which windows meet, at most: each returns a sum for each text it met
MEETINGS = 64
#: tokens whose windows are packed together; it never changes a count
_STRETCH = 1_200_000
#: sums a task holds before it returns them
_HELD_SUMS = 4_000_000
END = np.uint64(0x5EED0FE2D0C5E11D)
# codes of words: ranks below COMMON, no word, and hashes
_NONE, _RARE = (1 << 21) - 1, (1 << 21) - 2
_SCORED, _COUNTED = 1, 2
_SUMS = "row long, n_tokens long, n_known long, base double, model double, gram long, mass double, share double"
_PACKED = "target int, kind int, blob binary"


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with an end behind each text, and the bounds of the texts."""
    words, first = word_hashes(column)
    return np.insert(words, first[1:], END), first + np.arange(len(first))


@dataclass
class Model:
    """Numbers of training tokens and distinct words, occurrences from which a sequence is listed, and the training texts (column ``text``).

    Sequences are counted and tested in the pass that scores texts with them.
    """

    tokens: int
    distinct: int
    least: int
    table: DataFrame

    @property
    def total(self) -> int:
        return self.tokens + self.distinct + 1


class _Common:
    """The most common words, ``hashes`` by rank (if they are needed) and ``counts`` by rank, and into how many shares the first are dealt.

    ``complete``: no other word can stand in a listed sequence. It goes with the code of tasks, so it packs the counts, which descend.
    """

    def __init__(self, hashes: np.ndarray | None, counts: np.ndarray, shares: np.ndarray, complete: bool, targets: int) -> None:
        self.hashes, self.counts, self.shares, self.complete, self.targets = hashes, counts, shares, complete, targets
        self.ranks = np.zeros(0, np.int64) if hashes is None else np.argsort(hashes)
        self.ordered = np.zeros(0, np.uint64) if hashes is None else hashes[self.ranks]

    def __reduce__(self) -> tuple:
        new = np.flatnonzero(np.diff(self.counts, prepend=-1))
        packed = self.counts[new], np.diff(new, append=len(self.counts))
        return _unpacked, (self.hashes, *packed, self.shares, self.complete, self.targets)

    def without_hashes(self) -> _Common:
        return _Common(None, self.counts, self.shares, self.complete, self.targets)

    def codes(self, words: np.ndarray) -> np.ndarray:
        """Codes of ascending hashes."""
        # a hash that looks like a rank
        code = np.where(words < np.uint64(_NONE + 1), words + np.uint64(1 << 40), words)
        if len(self.ordered):
            at = np.minimum(np.searchsorted(self.ordered, words), len(self.ordered) - 1)
            code = np.where(self.ordered[at] == words, self.ranks[at].astype(np.uint64), code)
        return code

    def counts_of(self, codes: np.ndarray) -> np.ndarray:
        """Counts of the words that have a rank, 0 of others."""
        return np.append(self.counts, 0)[np.minimum(codes, np.uint64(len(self.counts))).astype(np.int64)]

    def crowded(self, codes: np.ndarray) -> np.ndarray:
        return codes < np.uint64(len(self.shares))

    def targets_of(self, c: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Where windows with these words meet; without crowded words ``b`` does not matter."""
        share = np.zeros(len(c), np.uint64)
        at = np.flatnonzero(self.crowded(c))
        share[at] = mix(b[at] + np.uint64(7)) % self.shares[c[at].astype(np.int64)]
        return (mix(c * np.uint64(0xA0761D6478BD642F) + share) % np.uint64(self.targets)).astype(np.int64)

    def places_of(self, crowded: np.uint64) -> np.ndarray:
        """The places that the windows of a crowded word are dealt over."""
        shares = np.arange(self.shares[int(crowded)], dtype=np.uint64)
        return (mix(np.full(len(shares), crowded, np.uint64) * np.uint64(0xA0761D6478BD642F) + shares) % np.uint64(self.targets)).astype(np.int64)


def _unpacked(hashes: np.ndarray | None, counts: np.ndarray, runs: np.ndarray, *rest) -> _Common:
    return _Common(hashes, np.repeat(counts, runs), *rest)


def _is_rank(codes: np.ndarray) -> np.ndarray:
    return codes < np.uint64(_RARE)


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash for each pair of codes or hashes."""
    return mix(mix(left + np.uint64(1)) * np.uint64(0xA0761D6478BD642F) + right)


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key the number of its group, and for each group the place of one of its keys."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.append(True, ordered[1:] != ordered[:-1]) if len(keys) else np.zeros(0, bool)
    group = np.empty(len(keys), np.int64)
    group[order] = np.cumsum(new) - 1
    return group, order[new]


def _squeeze(*arrays: np.ndarray) -> bytes:
    """Whole numbers of 4 or 8 bytes, the bytes of each place beside each other, which compresses well."""
    codec = pa.Codec("zstd", compression_level=3)
    planes = [np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes() for a in arrays]
    head = np.array([len(arrays), *[len(a) for a in arrays], *[a.itemsize for a in arrays]], np.int32)
    return head.tobytes() + codec.compress(b"".join(planes), asbytes=True)


def _unsqueeze(blob: bytes) -> list[np.ndarray]:
    many = int(np.frombuffer(blob, np.int32, 1)[0])
    sizes, widths = np.frombuffer(blob, np.int32, 2 * many, 4).reshape(2, many).astype(np.int64)
    raw = pa.Codec("zstd").decompress(blob[4 + 8 * many :], decompressed_size=int((sizes * widths).sum()), asbytes=True)
    raw = np.frombuffer(raw, np.uint8)
    out, at = [], 0
    for size, width in zip(sizes, widths, strict=True):
        planes = raw[at : at + size * width].reshape(width, size)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(np.uint32 if width == 4 else np.uint64))
        at += size * width
    return out


def _stretches(batches: Iterator[pa.RecordBatch], text: str, stretch: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[pa.RecordBatch]]]:
    """Tokens and bounds of some texts, and the batches they stand in."""
    held: list[tuple[np.ndarray, np.ndarray, pa.RecordBatch]] = []

    def joined() -> tuple[np.ndarray, np.ndarray, list[pa.RecordBatch]]:
        tokens = np.concatenate([h[0] for h in held])
        stretch = tokens, np.append(0, np.cumsum(np.concatenate([np.diff(h[1]) for h in held]))), [h[2] for h in held]
        held.clear()
        return stretch

    size = 0
    for batch in small_batches(batches, text):
        held.append((*_tokens(batch.column(text)), batch))
        size += len(held[-1][0])
        if size > stretch:
            yield joined()
            size = 0
    if held:
        yield joined()


def _count_words(train: DataFrame, text: str) -> DataFrame:
    """Rows (token, n): words and ends, summed within stretches of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, _, _ in _stretches(batches, text, _STRETCH):
            words, n = np.unique(tokens, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], names=["token", "n"])

    return train.select(text).mapInArrow(run, "token long, n long")


def fit(train: DataFrame, text: str = "text", least: int = LEAST) -> tuple[Model, DataFrame]:
    """The model and the table (token, n) of all training words. NULL texts count as empty: just an end."""
    words = stash(_count_words(train, text).groupBy("token").agg(F.sum("n").alias("n")), "pst-words")
    size = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("distinct")).first()
    return Model(size["tokens"], size["distinct"], least, train.select(F.col(text).alias("text"))), words


def _common_words(words: DataFrame, model: Model) -> tuple[_Common, int]:
    """The words that get ranks, and the count from which they do: the smallest from ``least`` that not more than ``COMMON`` words reach."""
    most = 1 << 16
    having = {r["n"]: r["words"] for r in words.groupBy(F.least("n", F.lit(most)).alias("n")).agg(F.count("*").alias("words")).collect()}
    found, n = 0, most + 1
    while n > model.least and found + having.get(n - 1, 0) <= COMMON:
        n -= 1
        found += having.get(n, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blob = b"".join(batch.column(c).to_numpy(zero_copy_only=False).tobytes() for c in ("token", "n"))
            yield pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], names=["blob"])

    # with no more than COMMON words below the bound at the top, none is common
    kept = words.where(F.lit(n <= most) & (F.col("n") >= n)).select("token", "n")
    parts = [np.frombuffer(bytes(r["blob"]), np.int64).reshape(2, -1) for r in kept.mapInArrow(run, "blob binary").collect()]
    tokens, counts = np.concatenate(parts, axis=1) if parts else np.zeros((2, 0), np.int64)
    order = np.lexsort((tokens, -counts))
    hashes, counts = tokens[order].view(np.uint64), counts[order]
    shares = -(-counts[counts > 2 * CROWD] // CROWD)
    targets = max(1, -(-model.tokens // CROWD))
    return _Common(hashes, counts, shares.astype(np.uint64), n <= model.least, targets), n


def _rare_words(words: DataFrame, least: int) -> DataFrame:
    """Rows (gram, n) of the words without a rank, by their codes."""
    like_rank = F.col("token").between(0, _NONE)
    return words.where(F.col("n") < least).select(F.when(like_rank, F.col("token") + F.lit(1 << 40)).otherwise(F.col("token")).alias("gram"), "n")


def _kept_mass(group: np.ndarray, n: np.ndarray, own: np.ndarray, before: np.ndarray, occurs: np.ndarray, tokens: int) -> np.ndarray:
    """The back-off mass of each context whose next words diverge from its suffix's, NaN of others.

    ``group``, ``n``, ``own``, ``before``: of each listed sequence its context, count, share of what follows the context, and share of what follows the suffix.
    The divergence is the gain in log likelihood over the suffix, the words not listed taken as one; it must pay for the listed
    words (half the log of the corpus size each).
    """
    listed, seen, before_sum, gain = (np.bincount(group, w, len(occurs)) for w in (None, n, before, n * np.log(own / before)))
    left = np.maximum(occurs - seen, 0)
    some = np.maximum(occurs, 1)
    rest = np.maximum(left / some, 1e-12) / np.maximum(1 - before_sum, 1e-9)
    kept = (listed > 0) & (gain + left * np.log(rest) > 0.5 * listed * np.log(max(tokens, 2)))
    mass = np.clip((left + DISCOUNT * listed) / some, 1e-12, 1.0)
    return np.where(kept, mass, np.nan)


def _side_pairs(train: DataFrame, text: str, model: Model, words: DataFrame, rare: DataFrame, common: _Common) -> DataFrame:
    """Packed rows for the places where windows meet, of what these cannot count: pairs whose first word is dealt over several, and counts of second words without a rank."""
    least, tokens_in_all, stretch = model.least, max(model.tokens, 1), _STRETCH
    targets, few = common.targets, common.without_hashes()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, bounds, _ in _stretches(batches, text, stretch):
            hashes, word = np.unique(tokens, return_inverse=True)
            code = common.codes(hashes)
            follows = np.ones(len(word), bool)
            follows[bounds[:-1]] = False
            at = np.flatnonzero(follows)
            crowded, ranked = common.crowded(code)[word[at - 1]], _is_rank(code)[word[at]]
            at = at[(crowded & ranked) if common.complete else (crowded | ~ranked)]
            pair, n = np.unique((word[at - 1] << 32) | word[at], return_counts=True)
            c, d = code[pair >> 32], code[pair & 0xFFFFFFFF]
            # a crowded word is a group of its own
            home = np.where(common.crowded(c), np.int64(targets) + np.minimum(c, np.uint64(_NONE)).astype(np.int64), common.targets_of(c, c))
            order = np.lexsort((d, c, home))
            home, c, d, n = home[order], c[order], d[order], n[order]
            new = np.flatnonzero(np.append(True, home[1:] != home[:-1])) if len(home) else np.zeros(0, np.int64)
            blobs = [_squeeze(c[i:j], d[i:j], n[i:j].view(np.uint64)) for i, j in zip(new, np.append(new, len(home))[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(home[new]), pa.array(blobs, pa.binary())], names=["home", "blob"])

    def add_up(key: tuple, table: pa.Table) -> pa.Table:
        c, d, n = (np.concatenate(x) for x in zip(*[_unsqueeze(blob.as_py()) for blob in table.column("blob")], strict=True))
        group, first = _groups(_pair(c, d))
        n = np.bincount(group, n, len(first)).astype(np.int64)
        first, n = first[n >= least], n[n >= least]
        columns = {"home": np.full(len(n), key[0].as_py()), "c": c[first].view(np.int64), "d": d[first].view(np.int64), "n": n}
        return pa.table({name: pa.array(x, pa.int64()) for name, x in columns.items()})

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        c, d, n, of_d = (table.column(x).to_numpy() for x in ("c", "d", "n", "of_d"))
        c, d = (np.ascontiguousarray(x).view(np.uint64) for x in (c, d))
        of_d = np.where(_is_rank(d), few.counts_of(d), np.nan_to_num(of_d.astype(np.float64)))
        home = key[0].as_py()
        goes, mass = [home], np.zeros(0)
        if home >= targets:
            occurs = few.counts_of(c[:1]).astype(np.float64)
            mass = _kept_mass(np.zeros(len(c), np.int64), n, n / occurs[0], of_d / tokens_in_all, occurs, tokens_in_all)
            goes = np.unique(few.places_of(c[0]))
        blob = _squeeze(c, d, np.ascontiguousarray(n).view(np.uint64), of_d.view(np.uint64), mass.view(np.uint64))
        return pa.table({"target": pa.array(goes, pa.int32()), "kind": pa.array([0] * len(goes), pa.int32()), "blob": pa.array([blob] * len(goes), pa.binary())})

    pairs = train.select(text).mapInArrow(count, "home long, blob binary")
    pairs = pairs.groupBy("home").applyInArrow(add_up, "home long, c long, d long, n long")
    if common.complete:
        pairs = pairs.withColumn("of_d", F.lit(None).cast("double"))
    else:
        pairs = pairs.join(rare.select(F.col("gram").alias("d"), F.col("n").cast("double").alias("of_d")), "d", "left")
    return pairs.select("home", "c", "d", "n", "of_d").groupBy("home").applyInArrow(pack, _PACKED)


def _windows(texts: DataFrame, key: str, common: _Common, total: int) -> DataFrame:
    """Windows of texts (key, text, use), packed by where they meet; and rows of what is known of a text, or of a word that meets nothing, at once."""
    kind = texts.schema[key].dataType.simpleString()
    names = ["target", "kind", "blob", key, "row", "n_tokens", "n_known", "base", "model", "gram", "mass", "share"]
    stretch = _STRETCH

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for tokens, bounds, held in _stretches(batches, "text", stretch):
            size = len(bounds) - 1
            keys = pa.concat_arrays([b.column(key) for b in held])
            use = np.concatenate([b.column("use").to_numpy(zero_copy_only=False) for b in held]).astype(np.uint32)
            own = np.repeat(np.arange(size, dtype=np.int32), np.diff(bounds))
            place = np.arange(len(tokens), dtype=np.int32) - bounds[own].astype(np.int32)
            hashes, word = np.unique(tokens, return_inverse=True)
            # a table of the words here, and behind them no word
            code, none, d = np.append(common.codes(hashes), np.uint64(_NONE)), np.int32(len(hashes)), word.astype(np.int32)
            del tokens, word
            is_rank = _is_rank(code)
            ranked, scored = is_rank[d], (use[own] & _SCORED) > 0
            before = [np.where(place >= k, np.roll(d, k), none) for k in (1, 2, 3)]
            if common.complete:
                # a word without a rank is in no listed sequence, nor is what goes on through it
                before[1] = np.where(is_rank[before[1]], before[1], none)
                before[2] = np.where(is_rank[before[1]] & is_rank[before[2]], before[2], none)
            meets = (place > 0) & (is_rank[before[0]] | (not common.complete))
            root = np.log10((common.counts_of(code) + 1) / total)[d]

            def sums(weights: np.ndarray) -> np.ndarray:
                return np.bincount(own, weights, size)

            def rows(**columns: pa.Array) -> pa.RecordBatch:
                many = len(next(iter(columns.values())))
                types = {"target": pa.int32(), "kind": pa.int32(), "blob": pa.binary(), key: keys.type, "row": pa.int64(), "gram": pa.int64()}
                types |= dict.fromkeys(("n_tokens", "n_known"), pa.int64()) | dict.fromkeys(("base", "model", "mass", "share"), pa.float64())
                return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(many, types[c]) for c in names], names=names)

            at = np.flatnonzero(use & _SCORED)
            spread = pa.array((mix((at + row).astype(np.uint64)) % np.uint64(common.targets)).astype(np.int32))
            known = {"n_tokens": np.diff(bounds), "n_known": sums(ranked).astype(np.int64), "base": sums(root * ranked), "model": sums(root * (ranked & ~meets))}
            two = pa.array(np.full(len(at), 2, np.int32))
            yield rows(target=spread, kind=two, row=pa.array(at + row), **{key: keys.take(pa.array(at))}, **{c: pa.array(x[at]) for c, x in known.items()})
            at = np.flatnonzero(scored & ~ranked & ~meets)
            if len(at):
                gram = code[d[at]]
                plain = {"target": (mix(gram) % np.uint64(common.targets)).astype(np.int32), "kind": np.full(len(at), 2, np.int32), "row": own[at].astype(np.int64) + row}
                plain |= {"gram": gram.view(np.int64), "mass": np.ones(len(at)), "share": np.zeros(len(at))}
                yield rows(**{c: pa.array(x) for c, x in plain.items()})
            at = np.flatnonzero(meets)
            if len(at):
                columns = [x[at] for x in (*before, d)]
                whose = (own[at].astype(np.uint32) << np.uint32(2)) | use[own[at]]
                del before, place, meets, root, own, scored, ranked
                target = common.targets_of(code, code)[columns[0]]
                crowded = np.flatnonzero(common.crowded(code)[columns[0]])
                target[crowded] = common.targets_of(code[columns[0][crowded]], code[columns[1][crowded]])
                short = np.where(is_rank | (code == np.uint64(_NONE)), code, np.uint64(_RARE))
                order = np.argsort((target.astype(np.uint64) << np.uint64(42)) | (short[columns[0]] << np.uint64(21)) | short[columns[1]])
                target, whose, columns = target[order], whose[order], [x[order] for x in columns]
                new = np.flatnonzero(np.append(True, target[1:] != target[:-1]))
                short = short.astype(np.uint32)
                blobs = []
                for begin, end in zip(new, np.append(new[1:], len(order)), strict=True):
                    parts = [x[begin:end] for x in columns]
                    ranks = [short[x] for x in parts]
                    hashed = [code[x[rank == _RARE]] for x, rank in zip(parts, ranks, strict=True)]
                    blobs.append(_squeeze(*ranks, whose[begin:end], np.concatenate(hashed)))
                one = pa.array(np.ones(len(new), np.int32))
                yield rows(target=pa.array(target[new].astype(np.int32)), kind=one, blob=pa.array(blobs, pa.binary()), row=pa.array(np.full(len(new), row)))
            row += size

    return texts.mapInArrow(run, f"{_PACKED}, `{key}` {kind}, {_SUMS}")


def _unpack(blobs: Sequence[tuple[bytes, int]]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Codes c, b, a, d of windows, the rows they stand in, and what they are for."""
    codes: list[list[np.ndarray]] = [[], [], [], []]
    rows, uses = [], []
    for blob, first in blobs:
        *ranks, whose, hashes = _unsqueeze(blob)
        used = 0
        for column, rank in zip(codes, ranks, strict=True):
            code = rank.astype(np.uint64)
            hashed = np.flatnonzero(rank == _RARE)
            code[hashed] = hashes[used : used + len(hashed)]
            used += len(hashed)
            column.append(code)
        rows.append((whose >> np.uint32(2)).astype(np.int64) + first)
        uses.append((whose & np.uint32(3)).astype(np.uint8))
    return [np.concatenate(c) for c in codes], np.concatenate(rows), np.concatenate(uses)


def _weigh(codes: Sequence[np.ndarray], counted: np.ndarray, side: Sequence[Sequence[np.ndarray]], common: _Common, least: int, tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """For all windows of some c: the factor and the summand that make the chance of d from its chance at the root."""
    c, b, a, d = codes
    # what was counted elsewhere, by pair
    pairs = [np.concatenate(x) for x in zip(*[s[:4] for s in side], strict=True)] if side else [np.zeros(0, np.uint64)] * 4
    keys = _pair(pairs[0], pairs[1])
    order = np.argsort(keys)
    keys, side_n, side_d = keys[order], pairs[2][order].view(np.int64), pairs[3][order].view(np.float64)
    masses = {int(s[0][0]): s[4].view(np.float64)[0] for s in side if len(s[4])}

    def counts(group: np.ndarray, many: int) -> np.ndarray:
        return np.bincount(group, counted_here, many)

    counted_here = counted
    cd_keys = _pair(c, d)
    c_group, c_first = _groups(c)
    cd_group, cd_first = _groups(cd_keys)
    n_c, n_cd = counts(c_group, len(c_first)), counts(cd_group, len(cd_first))
    of_d = common.counts_of(d[cd_first]).astype(np.float64)
    if len(keys):
        at = np.minimum(np.searchsorted(keys, cd_keys[cd_first]), len(keys) - 1)
        there = keys[at] == cd_keys[cd_first]
        of_d = np.where(there & ~_is_rank(d[cd_first]), side_d[at], of_d)
        n_cd = np.where(common.crowded(c[cd_first]), np.where(there, side_n[at], 0), n_cd)
    else:
        n_cd = np.where(common.crowded(c[cd_first]), 0, n_cd)
    crowded = common.crowded(c[c_first])
    n_c = np.where(crowded, common.counts_of(c[c_first]), n_c)
    of_c = c_group[cd_first]
    own = n_cd / np.maximum(n_c[of_c], 1)
    listed = np.flatnonzero(n_cd >= least)
    mass = _kept_mass(of_c[listed], n_cd[listed], own[listed], of_d[listed] / tokens, n_c, tokens)
    for at in np.flatnonzero(crowded):
        mass[at] = masses.get(int(c[c_first[at]]), np.nan)
    kept = ~np.isnan(mass)
    share = np.where(n_cd >= least, (n_cd - DISCOUNT) / np.maximum(n_c[of_c], 1), 0.0)
    factor, summand = np.where(kept, mass, 1.0)[c_group], np.where(kept[of_c], share, 0.0)[cd_group]

    # longer contexts, of windows whose context occurs often enough to be followed by a listed word
    at = np.arange(len(c))
    context, before, words = c, own[cd_group], cd_keys
    for longer in (b, a):
        context = _pair(longer[at], context)
        keep = longer[at] != np.uint64(_NONE)
        at, context, before, words = at[keep], context[keep], before[keep], words[keep]
        counted_here = counted[at]
        group, first = _groups(context)
        occurs = counts(group, len(first))
        keep = (occurs >= least)[group]
        at, context, before, words = at[keep], context[keep], before[keep], words[keep]
        counted_here = counted[at]
        group, first = _groups(context)
        occurs = counts(group, len(first))
        words = _pair(longer[at], words)
        word_group, word_first = _groups(words)
        n = counts(word_group, len(word_first))
        of = group[word_first]
        own = n / np.maximum(occurs[of], 1)
        listed = np.flatnonzero(n >= least)
        mass = _kept_mass(of[listed], n[listed], own[listed], before[word_first[listed]], occurs, tokens)
        kept = ~np.isnan(mass)
        mass, share = np.where(kept, mass, 1.0), np.where((n >= least) & kept[of], (n - DISCOUNT) / np.maximum(occurs[of], 1), 0.0)
        factor[at] *= mass[group]
        summand[at] = summand[at] * mass[group] + share[word_group]
        before = own[word_group]
    return factor, summand


def _meet(packed: DataFrame, key: str, common: _Common, least: int, tokens: int, total: int) -> DataFrame:
    """Sums per text over its windows, the words without a rank with factor and summand of their own, and the rows that were known at once."""
    kind = packed.schema[key].dataType.simpleString()
    names = [key, "row", "n_tokens", "n_known", "base", "model", "gram", "mass", "share"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, windows, side = None, [], []
        sums: list[tuple[np.ndarray, np.ndarray]] = []
        key_type = None

        def rows(**columns: np.ndarray) -> pa.RecordBatch:
            many = len(columns["row"])
            types = {key: key_type} | dict.fromkeys(("row", "n_tokens", "n_known", "gram"), pa.int64()) | dict.fromkeys(("base", "model", "mass", "share"), pa.float64())
            return pa.RecordBatch.from_arrays([pa.array(columns[c], types[c]) if c in columns else pa.nulls(many, types[c]) for c in names], names=names)

        def summed() -> tuple[np.ndarray, np.ndarray]:
            ids, place = np.unique(np.concatenate([s[0] for s in sums]), return_inverse=True)
            return ids, np.bincount(place, np.concatenate([s[1] for s in sums]), len(ids))

        def finish() -> Iterator[pa.RecordBatch]:
            if not windows:
                return
            codes, whose, use = _unpack(windows)
            factor, summand = _weigh(codes, (use & _COUNTED) > 0, side, common, least, tokens)
            scored = (use & _SCORED) > 0
            d = codes[3]
            at = np.flatnonzero(scored & _is_rank(d))
            if len(at):
                chance = (common.counts_of(d[at]) + 1) / total * factor[at] + summand[at]
                ids, place = np.unique(whose[at], return_inverse=True)
                sums.append((ids, np.bincount(place, np.log10(chance), len(ids))))
            at = np.flatnonzero(scored & ~_is_rank(d))
            if len(at):
                yield rows(row=whose[at], gram=d[at].view(np.int64), mass=factor[at], share=summand[at])

        for batch in batches:
            key_type = batch.schema.field(key).type
            at = {c: batch.column(c) for c in ("target", "kind", "blob", "row")}
            kinds, targets = at["kind"].to_numpy(), at["target"].to_numpy()
            ready = np.flatnonzero(kinds == 2)
            if len(ready):
                yield batch.select(names).take(pa.array(ready))
            for i in np.flatnonzero(kinds != 2):
                if targets[i] != target:
                    yield from finish()
                    target, windows, side = targets[i], [], []
                    if sum(len(s[0]) for s in sums) > _HELD_SUMS:
                        ids, model = summed()
                        sums.clear()
                        yield rows(row=ids, model=model)
                blob = at["blob"][i].as_py()
                if kinds[i] == 0:
                    side.append(_unsqueeze(blob))
                else:
                    windows.append((blob, at["row"][i].as_py()))
        yield from finish()
        if sums:
            ids, model = summed()
            yield rows(row=ids, model=model)
        release_memory()

    parts = min(MEETINGS, max(8, common.targets // 16))
    packed = packed.repartition(parts, "target").sortWithinPartitions("target")
    return packed.mapInArrow(run, f"`{key}` {kind}, {_SUMS}")


def score(docs: DataFrame, model: Model, words: DataFrame, key: str = "doc_id", text: str = "text", trained: Column | None = None) -> DataFrame:
    """Per row of ``docs``: key, n_tokens, n_known, train_tokens, base_score and score (log10 of the text's probability).

    The end of a text counts as a token. NULL text is empty. Rows with equal or NULL keys are scored each for itself.
    ``trained`` may say which rows of ``docs`` are the training texts, all of them, so that they are sent once for both.
    """
    common, least = _common_words(words, model)
    rare = _rare_words(words, least)
    total = model.total
    scored = docs.select(F.col(key).alias("pst_key"), F.col(text).alias("text"), F.lit(_SCORED).alias("use"))
    if trained is None:
        texts = scored.union(model.table.select(F.lit(None).cast(docs.schema[key].dataType), "text", F.lit(_COUNTED)))
    else:
        use = F.when(trained, F.lit(_SCORED | _COUNTED)).otherwise(F.lit(_SCORED))
        texts = docs.select(F.col(key).alias("pst_key"), F.col(text).alias("text"), use.alias("use"))
    packed = _windows(texts, "pst_key", common, total)
    if len(common.shares) or not common.complete:
        side = _side_pairs(model.table, "text", model, words, rare, common)
        packed = packed.unionByName(side, allowMissingColumns=True)
    met = stash(_meet(packed, "pst_key", common.without_hashes(), model.least, max(model.tokens, 1), total), "pst-sums")

    alone = met.where("gram IS NOT NULL").join(rare, "gram", "left")
    root = (F.coalesce("n", F.lit(0)) + 1) / F.lit(float(total))
    chance = root * F.col("mass") + F.col("share")
    alone = alone.select("pst_key", "row", "n_tokens", F.col("n").isNotNull().cast("long").alias("n_known"), F.log10(root).alias("base"), F.log10(chance).alias("model"))
    every = met.where("gram IS NULL").select("pst_key", "row", "n_tokens", "n_known", "base", "model").union(alone)
    rows = every.groupBy("row").agg(
        F.first("pst_key", ignorenulls=True).alias(key),
        F.max("n_tokens").alias("n_tokens"),
        F.coalesce(F.sum("n_known"), F.lit(0)).alias("n_known"),
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("base", "model")],
    )
    return rows.select(
        key,
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        F.col("model").alias("score"),
    )
