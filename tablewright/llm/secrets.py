"""Secret scans with a random forest against false positives (operator 3).

A pattern finds candidates: unbroken runs that are long and hold a digit or mixed case, or stand where a credential is assigned.
A random forest, trained from labelled findings, then decides by the candidate's length, its transitions between kinds of characters,
how much of it common words cover, its path and its neighbouring words. What it accepts is cut out of the text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tablewright.llm.hashing import mix, small_batches, span_hashes, text_bytes, word_spans
from tablewright.storage import stash

#: labelled findings that training may take, and terms of the dictionary of common words
FINDINGS = 20_000
DICTIONARY = 50_000
#: words that a task counts before it passes their counts on; it never changes a count
_STRETCH = 3_000_000
_NO_LETTER = np.ones(256, np.int32)
_NO_LETTER[[*range(65, 91), *range(97, 123)]] = 0
CANDIDATE = re.compile(r"[A-Za-z0-9+/_\-.]{8,}={0,2}")
_LETTERS = re.compile(r"[a-z]{3,}")
_KEYWORDS = ("token", "secret", "passw", "pwd", "apikey", "api_key", "key", "auth", "credential", "bearer")
_DECOYS = ("uuid", "sha", "md5", "commit", "checksum", "digest", "hash", "id", "version", "http")
_PATHS = ("test", "example", "mock", "sample", "doc", ".env", "config", "conf", ".md", "lock")
# forms that issuers publish; they label findings, and the forest does not see them
_FORMS = re.compile(
    r"(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_(?:live|test)_[A-Za-z0-9]{16,}"
    r"|AIza[A-Za-z0-9_\-]{35}|eyJ[A-Za-z0-9_\-]{10,}\.[A-Za-z0-9_\-]{10,}\.[A-Za-z0-9_\-]*"
)
_ASSIGNED = re.compile(r"(?i)(?:token|secret|passw(?:or)?d|pwd|api_?key|access_?key|auth|credential)s?[\"']?\s*(?:=|:|=>)\s*[\"']?$")
_KINDS = 5
FEATURES = 4 + _KINDS * _KINDS + 3 + 6 + 2 * 2 + len(_PATHS) + 4


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans of all candidates in a text."""
    out = []
    for match in CANDIDATE.finditer(text):
        run, start, end = match.group(), *match.span()
        while run and run[-1] in ".-":
            run, end = run[:-1], end - 1
        digits = any(c.isdigit() for c in run)
        mixed = run[1:].lower() != run[1:] and run.upper() != run
        if (len(run) >= 16 and (digits or mixed)) or (len(run) >= 8 and _ASSIGNED.search(text, max(0, start - 40), start)):
            out.append((start, end))
    return out


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c in "abcdefABCDEF" else 2 if c.islower() else 3 if c.isupper() else 4


def features(text: str, start: int, end: int, path: str, words: frozenset[int]) -> list[float]:
    """What the forest sees of a candidate."""
    run = text[start:end]
    n = len(run)
    count = Counter(run)
    entropy = -sum(c / n * math.log2(c / n) for c in count.values())
    kinds = [_kind(c) for c in run]
    moves = Counter(zip(kinds, kinds[1:], strict=False))
    shares = Counter(kinds)
    letters = _LETTERS.findall(run.lower())
    covered = sum(len(w) for w in letters if _word_hash(w) in words)
    before, after = text[max(0, start - 48) : start].lower(), text[end : end + 24].lower()
    near = before.rstrip(" \t\"'`")
    last = re.findall(r"[\w.]+", before)[-2:]
    path = path.lower()
    return [
        n, math.log(n), entropy, entropy / max(1.0, math.log2(n)),
        *[moves[a, b] / max(1, n - 1) for a in range(_KINDS) for b in range(_KINDS)],
        covered / n, sum(map(len, letters)) / n, max(map(len, letters), default=0),
        *[shares[k] / n for k in range(_KINDS)], run.count("/") + run.count("."),
        sum(k in w for w in last for k in _KEYWORDS), sum(k in w for w in last for k in _DECOYS),
        sum(k in after for k in _KEYWORDS), sum(k in after for k in _DECOYS),
        *[float(p in path) for p in _PATHS],
        float(near.endswith("=")), float(near.endswith(":")), float(before[-1:] in "\"'`" and before != ""), float(after[:1] in "\"'`" and after != ""),
    ]


@lru_cache(1 << 16)
def _word_hash(word: str) -> int:
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(span_hashes(raw, np.zeros(1, np.int64), np.full(1, len(raw)), lower=True)[0])


def label(text: str, start: int, end: int) -> int | None:
    """Label of a finding by published forms and assignments: 1, 0, or None where they do not say."""
    run = text[start:end]
    if _FORMS.fullmatch(run):
        return 1
    assigned = _ASSIGNED.search(text, max(0, start - 40), start)
    if assigned and len(run) >= 16 and any(c.isdigit() for c in run) and not run.isdigit():
        return 1
    return None if assigned else 0


@dataclass(frozen=True)
class Forest:
    """Trees as arrays: feature (-1: a leaf), threshold, children, share of secrets in the leaf."""

    trees: tuple[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], ...]
    prior: float
    words: frozenset[int]

    def score(self, rows: np.ndarray) -> np.ndarray:
        if not self.trees:
            return np.full(len(rows), self.prior)
        total = np.zeros(len(rows))
        for feature, threshold, left, right, value in self.trees:
            at = np.zeros(len(rows), np.int64)
            while True:
                inner = feature[at] >= 0
                if not inner.any():
                    break
                go = rows[np.arange(len(rows)), np.maximum(feature[at], 0)] <= threshold[at]
                at = np.where(inner, np.where(go, left[at], right[at]), at)
            total += value[at]
        return total / len(self.trees)


def grow(rows: np.ndarray, labels: np.ndarray, trees: int = 32, depth: int = 8, seed: int = 3) -> tuple:
    """Trees on bootstrap samples; a split is the best of a random subset of features, by Gini impurity; classes weigh alike."""
    rng = np.random.default_rng(seed)
    weight_of = np.array([1 / max(1, (labels == 0).sum()), 1 / max(1, (labels == 1).sum())]) * len(labels) / 2
    out = []
    for _ in range(trees):
        chosen = rng.integers(0, len(rows), len(rows))
        nodes: list[list[float]] = [[-1, 0.0, 0, 0, 0.0]]
        open_ = [(0, chosen, 0)]
        while open_:
            node, at, level = open_.pop()
            y, w = labels[at], weight_of[labels[at]]
            total, ones = w.sum(), (w * y).sum()
            nodes[node][4] = ones / total
            if level == depth or len(at) < 4 or y.min() == y.max():
                continue
            best = (1e-9, -1, 0.0)
            for f in rng.choice(rows.shape[1], max(1, round(rows.shape[1] ** 0.5)), replace=False):
                values = rows[at, f]
                order = np.argsort(values, kind="stable")
                v, cw, c1 = values[order], np.cumsum(w[order]), np.cumsum((w * y)[order])
                cut = np.flatnonzero(v[1:] > v[:-1])
                if not len(cut):
                    continue
                lw, l1 = cw[cut], c1[cut]
                rw, r1 = total - lw, ones - l1
                gain = l1**2 / lw + r1**2 / rw - ones**2 / total
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], f, (v[cut[k]] + v[cut[k] + 1]) / 2)
            if best[1] < 0:
                continue
            goes = rows[at, best[1]] <= best[2]
            nodes[node][:4] = [best[1], best[2], len(nodes), len(nodes) + 1]
            open_ += [(len(nodes), at[goes], level + 1), (len(nodes) + 1, at[~goes], level + 1)]
            nodes += [[-1, 0.0, 0, 0, 0.0], [-1, 0.0, 0, 0, 0.0]]
        feature, threshold, left, right, value = zip(*nodes, strict=True)
        out.append((np.array(feature, np.int64), np.array(threshold), np.array(left, np.int64), np.array(right, np.int64), np.array(value)))
    return tuple(out)


def common_words(docs: DataFrame, text: str = "text", least_share: float = 2e-5) -> frozenset[int]:
    """Hashes of the words of three or more letters a-z and nothing else that make up at least ``least_share`` of all words.

    Counts are added up over all rows before any threshold, so the layout of ``docs`` does not matter. No more than 1 / ``least_share``
    words reach it; of those the ``DICTIONARY`` most frequent are taken. NULL texts have no words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = seen = 0

        def flush() -> pa.RecordBatch:
            word, n = np.unique(np.concatenate(held), return_counts=True)
            words = pa.array(np.append(word, np.uint64(0)).view(np.int64))
            return pa.RecordBatch.from_arrays([words, pa.array(np.append(n, seen))], names=["word", "n"])

        for batch in small_batches(batches, text):
            data, bounds = text_bytes(batch.column(text))
            starts, ends, _ = word_spans(data, bounds)
            others = np.zeros(len(data) + 1, np.int32)
            np.cumsum(_NO_LETTER[data], out=others[1:])
            plain = (others[ends] == others[starts]) & (ends - starts >= 3)
            held.append(span_hashes(data, starts[plain], ends[plain], lower=True))
            size, seen = size + len(held[-1]), seen + len(starts)
            if size > _STRETCH:
                yield flush()
                held, size, seen = [], 0, 0
        if held:
            yield flush()

    counted = stash(docs.select(text).mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "secret-words")
    total = counted.where("word = 0").first()
    frequent = counted.where((F.col("word") != 0) & (F.col("n") >= max(2.0, least_share * (total["n"] if total else 0))))
    top = frequent.orderBy(F.desc("n"), "word").limit(DICTIONARY).select("word").toArrow()
    return frozenset(w & 2**64 - 1 for w in top.column("word").to_pylist())


def findings(docs: DataFrame, words: frozenset[int], key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Labelled findings of all documents: rows (mark, label, features). ``mark`` is a hash of the finding and its surroundings."""
    shared = docs.sparkSession.sparkContext.broadcast(words)
    schema = "mark long, label int, features array<float>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            out = []
            for text_, path_ in zip(batch.column("text").to_pylist(), batch.column("path").to_pylist(), strict=True):
                for start, end in candidates(text_):
                    known = label(text_, start, end)
                    if known is not None:
                        raw = np.frombuffer(text_[max(0, start - 48) : end + 24].encode(), np.uint8)
                        mark = mix(span_hashes(raw, np.zeros(1, np.int64), np.full(1, len(raw)), lower=False)).view(np.int64)[0]
                        out.append((int(mark), known, features(text_, start, end, path_, shared.value)))
            if out:
                kinds = (pa.int64(), pa.int32(), pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["mark", "label", "features"])

    return _text_and_path(docs, text, path).mapInArrow(run, schema)


def _text_and_path(docs: DataFrame, text: str, path: str | None) -> DataFrame:
    where = F.coalesce(F.col(path).cast("string"), F.lit("")) if path else F.lit("")
    return docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"), where.alias("path"))


def fit(docs: DataFrame, labelled: DataFrame | None = None, text: str = "text", path: str | None = None) -> Forest:
    """Forest from labelled findings (rows as ``findings`` gives them); by default those of ``docs`` that known forms label.

    Of each label it takes at most ``FINDINGS`` / 2, those with the smallest marks, each distinct finding once. With one label only
    there is nothing to learn and all candidates get it; without any, none is a secret.
    """
    words = common_words(docs, text)
    given = labelled if labelled is not None else findings(docs, words, text=text, path=path)
    rows = stash(given.groupBy("label", "mark").agg(F.min("features").alias("features")), "secret-findings")
    number = {r["label"]: r["count"] for r in rows.where("label IN (0, 1)").groupBy("label").count().collect()}

    def smallest(of: int) -> DataFrame:
        # marks are even hashes: below the threshold lie few more than are wanted, so tasks do not all send their smallest
        share = min(1.0, (0.6 * FINDINGS + 1000) / max(1, number.get(of, 0)))
        return rows.where((F.col("label") == of) & (F.col("mark") / 2.0**64 + 0.5 <= share)).orderBy("mark").limit(FINDINGS // 2)

    table = smallest(0).union(smallest(1)).toArrow()
    labels = table.column("label").to_numpy().astype(np.int64)
    if not len(labels) or labels.min() == labels.max():
        return Forest((), float(labels[0]) if len(labels) else 0.0, words)
    matrix = np.array(table.column("features").combine_chunks().flatten().to_numpy(), np.float64).reshape(len(labels), -1)
    order = np.lexsort((table.column("mark").to_numpy(), labels))
    return Forest(grow(matrix[order], labels[order]), float(labels.mean()), words)


def scan(docs: DataFrame, forest: Forest, text: str = "text", path: str | None = None, least: float = 0.5, name: str = "secrets", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with ``secrets``: n_candidates, found (start, end of each secret in code points), redacted (the text with ``mark`` in their place).

    NULL text has no candidates and stays NULL. The column must be new; all others pass through. Whole texts are scanned.
    """
    if name in docs.columns:
        raise ValueError(f"column {name} exists already")
    shared = docs.sparkSession.sparkContext.broadcast(forest)
    span = StructType([StructField("start", LongType()), StructField("end", LongType())])
    kind = StructType([StructField("n_candidates", LongType()), StructField("found", ArrayType(span)), StructField("redacted", StringType())])
    schema = StructType([*docs.schema.fields, StructField(name, kind)])
    arrow = pa.struct([("n_candidates", pa.int64()), ("found", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("redacted", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in small_batches(batches, text):
            texts = batch.column(text).to_pylist()
            paths = batch.column(path).to_pylist() if path else [""] * len(texts)
            spans = [candidates(t) if t else [] for t in texts]
            rows = [features(t, s, e, str(p or ""), model.words) for t, p, found in zip(texts, paths, spans, strict=True) for s, e in found]
            good = iter((model.score(np.array(rows, np.float64)) >= least).tolist() if rows else [])
            out = []
            for t, found in zip(texts, spans, strict=True):
                secrets = [s for s in found if next(good)]
                redacted = t
                for start, end in reversed(secrets):
                    redacted = redacted[:start] + mark + redacted[end:]
                out.append({"n_candidates": len(found), "found": [{"start": s, "end": e} for s, e in secrets], "redacted": redacted})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, arrow)], names=schema.names)

    return docs.mapInArrow(run, schema)
