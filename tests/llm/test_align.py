"""Alignment of two tokenizers against union-find over the tokens of whole texts."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tablewright.llm import align
from tablewright.llm.queries import QUERIES, table
from tablewright.llm.tokens import default_tokenizer

ODD = [
    "", None, " ", "  ", "a", " a", "a ", "the cat sat", "x  y", " lead", "trail ", "tab\tx \n new", "don't 12345 é à 日本語 😀😀", "<|endoftext|> z <s> </s> <0x0A>",
    "▁ literal", "a▁b", "\x00 zero \x7f", "antidisestablishmentarianism", "　wide　space", "\r\n\r\n", "a" * 300, "e\u0301 combined", "x" + " " * 40 + "y", "the cat sat",
]


class Plain:
    """Tokens of whole texts, one text at a time."""

    def __init__(self) -> None:
        self.a = Tokenizer.from_file(default_tokenizer())
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=align.piece_tokenizer())
        shown = {b: chr(b) for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
        hidden = [b for b in range(256) if b not in shown]
        self.byte = {c: b for b, c in (shown | {b: chr(256 + i) for i, b in enumerate(hidden)}).items()}

    def tokens(self, text: str | None) -> tuple[list, list]:
        if not text:
            return [], []
        a = [(i, bytes(self.byte[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        said = (" " + text).encode()
        return (a, b) if b"".join(t for _, t in a) == said == b"".join(t for _, t in b) else ([], [])


def spans(tokens: list) -> list[tuple]:
    ends = np.cumsum([len(t) for _, t in tokens]).tolist()
    return [(i, e - len(t), e) for (i, t), e in zip(tokens, ends, strict=True)]


def brute_force(texts: list) -> list[tuple]:
    plain = Plain()
    links, groups, sizes = [], [], []
    for text in texts:
        a, b = map(spans, plain.tokens(text))
        sizes.append((len(a), len(b)))
        # a link for every two tokens that share a byte
        owner = [[k for k, (_, s, e) in enumerate(side) for _ in range(s, e)] for side in (a, b)]
        links.append([(a[i][0], b[j][0]) for i, j in sorted(set(zip(*owner, strict=True)))])
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        own = [([], []) for _ in cuts]
        for side, tokens in enumerate((a, b)):
            for i, _, e in tokens:
                own[bisect_left(cuts, e)][side].append(str(i))
        groups.append(["|".join(map(",".join, sides)) for sides in own])
    docs = Counter(pair for own in links for pair in set(own))
    best: dict[int, int] = {}
    for (x, _), n in docs.items():
        best[x] = max(best.get(x, 0), n)
    return [
        (*size, len(g), len(own), sum(docs[p] == best[p[0]] for p in own), sum(docs[p] for p in own), ";".join(g))
        for size, g, own in zip(sizes, groups, links, strict=True)
    ]


def found(rows) -> list[tuple]:
    return sorted(((r.text or "", *r.aligned) for r in rows), key=repr)


def test_jumping_ends_at_the_last_token_of_each_group():
    random = np.random.default_rng(1)
    for _ in range(50):
        a, b = (np.sort(random.choice(np.arange(1, 200), random.integers(1, 120), replace=False)) for _ in range(2))
        a, b = np.append(a, 200), np.append(b, 200)
        cuts = np.intersect1d(a, b)
        a_last, b_last = align.jump(a, b)
        assert (b[a_last] == cuts[np.searchsorted(cuts, a)]).all()
        assert (b[b_last] == cuts[np.searchsorted(cuts, b)]).all()
    # a chain as long as the text
    a, b = np.append(np.arange(1, 100_000, 2), 100_000), np.append(np.arange(2, 100_000, 2), 100_000)
    assert {*align.jump(a, b)[0].tolist()} == {len(b) - 1}


@pytest.mark.parametrize("max_pairs", [align.MAX_PAIRS, 0])
def test_odd_texts(spark, max_pairs):
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(ODD)], "doc_id long, text string, a string, n long").repartition(4)
    got = align.align(frame, max_pairs=max_pairs)
    assert got.columns == [*frame.columns, "aligned"]
    wanted = sorted(((t or "", *r) for t, r in zip(ODD, brute_force(ODD), strict=True)), key=repr)
    assert found(got.collect()) == wanted


def test_rows_of_one_key_and_long_texts(spark, docs):
    texts = [r.text for r in docs.collect()]
    got = align.align(docs).collect()
    assert found(got) == sorted(((t or "", *r) for t, r in zip(texts, brute_force(texts), strict=True)), key=repr)


def test_forgetting_changes_nothing(monkeypatch):
    texts = pa.array([t for t in ODD if t], pa.string())
    aligner = align.Aligner(default_tokenizer(), align.piece_tokenizer())
    wanted = [[aligner.groups[p] for p in aligner.places(texts.slice(i, 1))[0]] for i in range(len(texts))]
    monkeypatch.setattr(align, "MAX_KEPT", 3)
    assert [[aligner.groups[p] for p in aligner.places(texts.slice(i, 1))[0]] for i in range(len(texts))] == wanted
    assert aligner.generation > 5


def test_empty_tables_and_clashing_names(docs, empty):
    assert align.align(empty).count() == 0
    with pytest.raises(ValueError, match="exists"):
        align.align(docs, name="source")


def test_query_equals_brute_force(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    wanted = {
        r.doc_id: (*numbers, sha256(groups.encode()).hexdigest() if groups else "")
        for r, (*numbers, groups) in zip(rows, brute_force([r.text for r in rows]), strict=True)
    }
    got = QUERIES["op13_pointer_jumping_align"](spark, sf_dir)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == wanted
