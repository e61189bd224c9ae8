"""Pivot codes against plain integer k-means over all pairs of parts and entries."""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pytest
from oracle import connect, rows_of

from tablewright.llm import pivot_codes
from tablewright.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int, id string"


def brute_force(rows: list[tuple], parts: int = 4, entries: int = 256, rounds: int = 4) -> list[tuple]:
    """Rows (vec_id, code, error, digest) in plain Python integers."""
    groups: dict[int, list] = {}
    for key, vector in rows:
        if vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        whole = [int(np.floor(1024 * x)) for x in vector]
        whole += [0] * (-len(whole) % parts)
        groups.setdefault(len(whole), []).append((key, whole))
    out = []
    for length, own in groups.items():
        width = length // parts
        first: dict = {}
        for key, whole in own:
            first[key] = min(first.get(key, whole), whole)
        chosen = [first[k] for k in sorted(first, key=lambda k: (k is None, k or 0))[:entries]]
        books = [[v[p * width : (p + 1) * width] for v in chosen] for p in range(parts)]

        def nearest(part, book):
            return min((sum((a - b) ** 2 for a, b in zip(part, entry, strict=True)), i) for i, entry in enumerate(book))

        def assigned(p):
            return [nearest(v[p * width : (p + 1) * width], books[p]) for _, v in own]

        for _ in range(rounds):
            moved = []
            for p in range(parts):
                members: dict[int, list] = {}
                for (_, entry), (_, v) in zip(assigned(p), own, strict=True):
                    members.setdefault(entry, []).append(v[p * width : (p + 1) * width])
                moved.append([[sum(c) // len(members[i]) for c in zip(*members[i], strict=True)] if i in members else e for i, e in enumerate(books[p])])
            books = moved
        found = [assigned(p) for p in range(parts)]
        digest = sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
        for i, (key, _) in enumerate(own):
            out.append((key, "".join(f"{found[p][i][1]:02x}" for p in range(parts)), sum(found[p][i][0] for p in range(parts)), digest))
    return sorted(out, key=repr)


def rows_with_oddities() -> list[tuple]:
    random = np.random.default_rng(3)
    rows = [(i, random.normal(size=8).round(2).tolist()) for i in range(60)]
    rows += [(i, rows[i % 7][1]) for i in range(60, 90)]  # ties: equal vectors
    rows += [(5, rows[5][1]), (5, [0.0] * 8), (None, [9.0] * 8), (None, [-9.0] * 8)]  # repeated and missing keys
    rows += [(100, None), (101, [None] + [0.0] * 7), (102, [float("nan")] + [0.0] * 7), (103, [float("-inf")] + [0.0] * 7)]
    rows += [(200 + i, random.normal(size=6).tolist()) for i in range(9)] + [(300, [0.5] * 4), (301, []), (302, [])]
    return rows


@pytest.mark.parametrize("entries", [5, 256])
def test_codes_are_those_of_plain_integer_means(spark, entries):
    rows = rows_with_oddities()
    frame = spark.createDataFrame([(k, v, k and k % 3, "x") for k, v in rows], SCHEMA).repartition(5)
    got = pivot_codes.compress(frame, entries=entries)
    assert got.columns == ["vec_id", "label", "id", "code", "error", "codebooks_sha256"]
    found = [(r.vec_id, r.code, r.error, r.codebooks_sha256) for r in got.collect()]
    assert sorted(found, key=repr) == brute_force(rows, entries=entries)


def test_bounds_lose_no_nearest_entry_and_prune():
    random = np.random.default_rng(5)
    centres = random.integers(-3000, 3000, (40, 16))
    vectors = centres[random.integers(0, 40, 6000)] + random.integers(-60, 60, (6000, 16))
    books = pivot_codes.Books.start(vectors[:256], 4, 8)
    code, best, evaluated = books.assign(vectors, books.distances(vectors))
    for i, (part, entries) in enumerate(zip(books.cut(vectors), books.entries, strict=True)):
        every = pivot_codes.squares(part, entries)
        assert (every.argmin(1) == code[:, i]).all()
        assert (every.min(1) == best[:, i]).all()
    assert evaluated < 0.25 * vectors.shape[0] * 4 * 256


def test_large_components(spark):
    far = float(2**17)
    rows = [(1, [far] * 4), (2, [-far] * 4), (3, [-far + 0.001] * 4)]
    frame = spark.createDataFrame([(k, v, 0, "x") for k, v in rows], SCHEMA)
    found = [(r.vec_id, r.code, r.error, r.codebooks_sha256) for r in pivot_codes.compress(frame, entries=1).collect()]
    assert sorted(found, key=repr) == brute_force(rows, entries=1)
    with pytest.raises(Exception, match="64-bit"):
        pivot_codes.compress(spark.createDataFrame([(1, [1e30] * 4, 0, "x")], SCHEMA)).collect()


def test_empty_tables_and_clashing_names(spark):
    nothing = spark.createDataFrame([(1, None, 0, "x")], SCHEMA)
    assert pivot_codes.compress(nothing).count() == 0
    assert pivot_codes.compress(nothing.limit(0)).columns == ["vec_id", "label", "id", "code", "error", "codebooks_sha256"]
    with pytest.raises(ValueError, match="exist"):
        pivot_codes.compress(nothing.withColumnRenamed("id", "code"))
    with pytest.raises(ValueError, match="inside"):
        pivot_codes.compress(nothing.withColumnRenamed("id", "_far"))


def test_query_equals_its_sql(spark, sf_dir):
    got = QUERIES["op12_pivot_codes"](spark, sf_dir)
    result = connect(sf_dir).execute(ORACLES["op12_pivot_codes"])
    columns = [d[0] for d in result.description]
    assert rows_of(got.columns, got.collect()) == rows_of(columns, result.fetchall())
