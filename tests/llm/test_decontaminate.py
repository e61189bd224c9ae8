"""Leak scans against regular expressions over whole texts."""

from __future__ import annotations

import re

import pytest
from oracle import connect, rows_of

from tablewright.llm import decontaminate
from tablewright.llm.queries import ORACLES, QUERIES

WORD = re.compile("[^\\x00-\\x2f\\x3a-\\x60\\x7b-\\x7f]+")
ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away"),
    (2, "jumps over the LAZY dog and runs away from the old grey wolf"),
    (3, "two words"),
    (3, "two words"),
    (4, None),
    (5, " ... "),
    (6, "日本 é"),
    (None, "the old grey"),
    (7, "word word word word word word word word word word word word"),
    (8, "a b a b a b a b a b a"),
]
EXTRA = [
    (20, "so: THE--quick_brown fox; jumps (over) the lazy dog, and runs? Then two\nwords. é日本 é日本, 日本 é!", "s"),
    (21, "b a b a b a b a b a b a b", "s"),
    (22, "two", "s"),
    (23, "words two words two words", None),
]


def lowered(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_force(text: str, items: list[tuple], width: int) -> tuple:
    spans = [m.span() for m in WORD.finditer(lowered(text))]
    words = [lowered(text)[s:e] for s, e in spans]
    hit, held = set(), set()
    for item, said in items:
        own = WORD.findall(lowered(said))
        n = min(width, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                held.add("" if item is None else str(item))
    runs = []
    for i in sorted(hit):
        if runs and i - 1 in hit:
            runs[-1][1] = spans[i][1]
        else:
            runs.append(list(spans[i]))
    return len(words), len(hit), [tuple(r) for r in runs], sorted(held)


def found(rows) -> dict:
    return sorted(
        ((r.doc_id, r.text, r.leaks.n_words, r.leaks.n_hit, [tuple(s) for s in r.leaks.spans], list(r.leaks["items"])) for r in rows),
        key=repr,
    )


@pytest.fixture(scope="module")
def texts(spark, docs):
    extra = spark.createDataFrame([(*row, "x", "y", 0) for row in EXTRA], docs.schema)
    return docs.union(extra)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(*row, "z") for row in ITEMS], "item_id long, text string, item string")


@pytest.mark.parametrize(("width", "max_bytes"), [(10, decontaminate.MAX_BYTES), (3, decontaminate.MAX_BYTES), (10, 1000), (3, 500)])
def test_scan_finds_what_windows_of_words_find(texts, items, width, max_bytes):
    got = decontaminate.scan(texts, items, width=width, max_bytes=max_bytes)
    assert got.columns == [*texts.columns, "leaks"]
    wanted = sorted(((r.doc_id, r.text, *brute_force(r.text, ITEMS, width)) for r in texts.collect()), key=repr)
    assert found(got.collect()) == wanted


def test_spans_are_places_in_the_original_text(texts, items):
    row = next(r for r in decontaminate.scan(texts, items).collect() if r.doc_id == 20)
    assert [row.text[s.start : s.end] for s in row.leaks.spans] == ["THE--quick_brown fox; jumps (over) the lazy dog, and runs", "two\nwords", "日本 é"]


def test_long_text_with_hits_everywhere(spark, items):
    said = "two words " * 200_000
    row = decontaminate.scan(spark.createDataFrame([(1, said)], "doc_id long, text string"), items).first()
    assert (row.leaks.n_words, row.leaks.n_hit, list(row.leaks["items"])) == (400_000, 400_000, ["3"])
    assert [tuple(s) for s in row.leaks.spans] == [(0, len(said) - 1)]


def test_empty_tables_and_clashing_names(texts, items, empty):
    assert decontaminate.scan(empty, items).count() == 0
    assert {r.leaks.n_hit for r in decontaminate.scan(texts, items.limit(0)).collect()} == {0}
    with pytest.raises(ValueError, match="exists"):
        decontaminate.scan(texts, items, name="source")


def test_query_equals_its_sql(spark, sf_dir):
    got = QUERIES["op11_aho_corasick_leaks"](spark, sf_dir)
    result = connect(sf_dir).execute(ORACLES["op11_aho_corasick_leaks"])
    columns = [d[0] for d in result.description]
    wanted = rows_of(columns, result.fetchall())
    assert rows_of(got.columns, got.collect()) == wanted
    assert any("bool:True" in row for row in wanted)
