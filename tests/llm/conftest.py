from __future__ import annotations

import os

import pytest

SF_DIR = "/root/testdata/sf0.001"
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from the old grey wolf in the wood"),
    (2, "the quick brown fox jumps over the lazy dog and runs away from the old grey wolf in the WOOD"),
    (3, "The quick brown fox jumps over the lazy dog and runs away from the old grey wolf in the wood today"),
    (4, ""),
    (5, None),
    (6, " \n\t "),
    (7, "two words"),
    (8, "two words"),
    (9, "x  y   \nz <|endoftext|> é　日本"),
    (10, "word " * 3000),
    (None, "a text without an id"),
    (11, "same row twice"),
    (11, "same row twice"),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Texts with ties, NULLs, blanks, repeated rows, a long one, and columns whose names the operators use inside."""
    rows = [(i, t, None if i == 7 else f"s{(i or 0) % 3}", "x", "y", 0) for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, id string, part string, n long").repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("test tables not present")
    return SF_DIR


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def shingle_set(text: str | None, width: int = 5) -> set:
    found = words(text)
    return {tuple(found[i : i + width]) for i in range(len(found) - width + 1)} or ({tuple(found)} if found else set())


def smallest_reachable(ids: list, links: list[tuple]) -> dict:
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {i: root(i) for i in ids}
