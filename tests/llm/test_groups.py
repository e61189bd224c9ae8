"""Near duplicates of texts and vectors, and components."""

from __future__ import annotations

import itertools
import random
import tracemalloc

import numpy as np
import pytest
from conftest import rows as sorted_rows
from pyspark.sql import functions as F

from llm.conftest import shingle_set, smallest_reachable
from tablewright.llm import ngram_join, pq_neardup
from tablewright.llm.components import components
from tablewright.llm.queries import QUERIES, table


def test_components_of_chains_stars_and_repeats(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (101, 100), (None, 3)]
    found = components(spark.createDataFrame(links, "a long, b long"))
    wanted = {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 160)}
    assert dict(map(tuple, found.collect())) == wanted
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_texts(docs):
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    sets = {i: shingle_set(t) for i, t in texts.items()}
    links = [
        (a, b)
        for a, b in itertools.combinations(sets, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    return sets, smallest_reachable(list(sets), links)


def agree(found, docs):
    sets, wanted = brute_texts(docs)
    for r in found.collect():
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), wanted[r.doc_id]), r
    assert found.count() == docs.count()


def test_texts_with_odd_rows(docs, empty):
    agree(ngram_join.near_duplicates(docs), docs)
    assert ngram_join.near_duplicates(empty).count() == 0


def test_groups_of_edited_copies_lose_no_link(spark):
    """Copies with one to nine edits, so that some pairs link, some only through others, and some not at all."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    line = " ".join(f"c{i}" for i in range(12))
    rows = []
    for i in range(150):
        own = list(base) if i % 3 else [f"v{rng.randrange(900)}" for _ in range(60)]
        for _ in range(rng.randrange(9)):
            own[rng.randrange(len(own))] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(own) + (f" {line}" if i % 2 else "")))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    agree(ngram_join.near_duplicates(docs), docs)


def test_copies_with_different_edits_are_told_apart_before_they_are_probed(spark, monkeypatch):
    """Two edits in each copy leave 70 % of the shingles shared, so many short lists meet though few pairs are alike."""
    rng = random.Random(11)
    rows = []
    for i in range(80):
        own = [f"w{k}" for k in range(120)]
        for k in rng.sample(range(4, 116), 2):
            own[k] = f"e{i}_{k}"
        rows.append((i, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    probed = []
    probe = ngram_join._probe
    monkeypatch.setattr(ngram_join, "_probe", lambda pairs, *rest: probed.append(pairs.count()) or probe(pairs, *rest))
    agree(ngram_join.near_duplicates(docs), docs)
    sets = [shingle_set(text) for _, text in rows]
    alike = sum(100 * len(a & b) >= 74 * len(a | b) for a, b in itertools.combinations(sets, 2))
    assert probed[1] <= alike


def test_bitmaps_differ_in_no_more_bits_than_sets(spark):
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 2**64, n, dtype=np.uint64)) for n in (0, 1, 40, 3000)]
    sets += [np.unique(np.concatenate([sets[2], sets[3][::430]])), sets[3][5:]]
    marks = np.stack(ngram_join._parities(sets), 1)
    assert marks.shape == (len(sets), ngram_join.BITS // 64)
    for (a, x), (b, y) in itertools.combinations(zip(sets, marks, strict=True), 2):
        apart = sum(int(v).bit_count() for v in (x ^ y).view(np.uint64))
        assert apart <= len(np.setxor1d(a, b))
    assert sum(int(v).bit_count() for v in (marks[2] ^ marks[4]).view(np.uint64)) >= 5


def test_a_text_and_its_extension_link_beside_a_shorter_copy(spark):
    """80 of 100 shingles shared, while a copy of 70 heads their lists and links with the shorter one only."""
    rows = []
    for group in range(60):
        own = [f"g{group}w{i}" for i in range(104)]
        rows += [(3 * group + k, " ".join(own[:size])) for k, size in enumerate((104, 84, 74))]
    random.Random(2).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    agree(ngram_join.near_duplicates(docs), docs)


def test_query_over_the_documents(spark, sf_dir):
    agree(QUERIES["op7_divide_skip_join"](spark, sf_dir), table(spark, sf_dir, "documents"))


def brute_vectors(vectors, least=0.9):
    good = {}
    for i, v in vectors:
        v = np.array([np.nan if x is None else x for x in v], float) if v is not None else np.zeros(0)
        if len(v) and np.isfinite(v).all() and v.any():
            v = v / np.abs(v).max()
            good[i] = v / np.linalg.norm(v)
    links = [(a, b) for a, b in itertools.combinations(good, 2) if len(good[a]) == len(good[b]) and good[a] @ good[b] >= least]
    ids = [i for i, _ in vectors]
    count = {i: 0 for i in ids}
    for a, b in links:
        count[a] += 1
        count[b] += 1
    reach = smallest_reachable(ids, links)
    return {i: (count[i], reach[i], reach[i] == i) for i in ids}


def test_vectors_with_odd_rows_and_hot_copies(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(16).tolist()) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 450)]
    rows += [(i, (np.array(rows[9][1]) + 0.15 * rng.standard_normal(16)).tolist()) for i in range(450, 520)]
    rows += [(600, None), (601, []), (602, [0.0] * 16), (603, [float("nan")] * 16), (604, [None] + [1.0] * 15), (605, [float("inf")] + [1.0] * 15)]
    rows += [(606, [1e-200] * 16), (607, [1e200] * 16)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit("x")).repartition(4)
    found = pq_neardup.near_duplicates(vectors)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found.collect()} == brute_vectors(rows)
    assert pq_neardup.near_duplicates(vectors.limit(0)).count() == 0


def test_repeated_vector_rows(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (None, [0.0, 1.0])]
    found = pq_neardup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert sorted_rows(found) == sorted_rows(
        spark_rows(spark, [(1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True), (None, 0, None, True)])
    )


def spark_rows(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, n_links long, component_id long, kept boolean")


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.1"])
def test_recall_of_the_index(spark, folder, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", folder)
    vectors = [(r.vec_id, r.embedding) for r in table(spark, sf_dir, "embeddings").collect()]
    ids = np.array([i for i, _ in vectors])
    unit = np.array([v for _, v in vectors], float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    wanted = (unit @ unit.T >= 0.9).sum(1) - 1
    found = {r.vec_id: r.n_links for r in QUERIES["op2_pq_near_duplicates"](spark, sf_dir).collect()}
    got = np.array([found[i] for i in ids])
    assert (got <= wanted).all()
    assert got.sum() >= 0.9 * wanted.sum()


@pytest.mark.parametrize("index_from", [1, 32])
def test_each_length_of_vectors_has_its_links(spark, index_from):
    """A common length, one with an index of its own, and two rare ones."""
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(3).tolist()) for i in range(120)]
    rows += [(i, rng.standard_normal(6).tolist()) for i in range(200, 240)]
    rows += [(i, (np.array(rows[i - 180][1]) * 3).tolist()) for i in range(300, 340)]
    rows += [(400, [1.0, 1.0]), (401, [1.0, 1.0]), (402, [1.0, 1.01]), (403, [1.0, -1.0]), (404, [2.0]), (405, [1.0, 0.0, 0.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    # every list is searched, so nothing can be missed
    found = pq_neardup.near_duplicates(vectors, probes=64, index_from=index_from)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found.collect()} == brute_vectors(rows)


@pytest.mark.parametrize("lists", [1000, 4096])
def test_planted_pairs_are_found_in_bounded_memory(lists):
    """Vectors without structure, the worst case for lists: pairs at the threshold itself and closer ones."""
    rng = np.random.default_rng(lists)

    def unit(rows):
        return rows / np.linalg.norm(rows, axis=1, keepdims=True)

    sample, one = unit(rng.standard_normal((32_768, 64))), unit(rng.standard_normal((3000, 64)))
    tracemalloc.start()
    index = pq_neardup.fit_index(sample, lists)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300e6
    aside = rng.standard_normal(one.shape)
    aside = unit(aside - (aside * one).sum(1, keepdims=True) * one)
    for cosine in (0.9, 0.95):
        other = cosine * one + np.sqrt(1 - cosine**2) * aside
        near, far = (index.nearest(v, pq_neardup.probes_for(lists)) for v in (one, other))
        found = (near == far[:, :1]).any(1) | (far == near[:, :1]).any(1)
        assert found.mean() >= 0.95
