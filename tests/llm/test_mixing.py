"""The source mix and its splitting tree."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.conftest import words
from tablewright.llm import mixing
from tablewright.llm.queries import QUERIES, table


def wanted_targets(sizes: dict, share: float = 1.5, most: float = 2.0, weights=(5, 2, 1)) -> dict:
    """Share out by weight; what stands above a cap goes to the others, until none does."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        per = left / sum(weight[s] for s in open_)
        above = [s for s in open_ if per * weight[s] >= most * sizes[s]]
        if not above:
            return out | {s: per * weight[s] for s in open_}
        for s in above:
            out[s] = most * sizes[s]
            left -= out[s]
            open_.remove(s)
    return out


def check_mix(rows, texts, longest_slack=0.5):
    sizes: dict = {}
    for _, source, text in texts:
        sizes[source] = sizes.get(source, 0) + len(words(text))
    targets = wanted_targets(sizes)
    taken: dict = {}
    longest: dict = {}
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(targets[r.source])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] = taken.get(r.source, 0) + r.taken
        longest[r.source] = max(longest.get(r.source, 0), r.size)
    for source, target in targets.items():
        assert abs(taken[source] - target) <= longest[source] * longest_slack + 1e-6


def test_targets_stop_and_are_shared_again(spark):
    sizes = {"a": 10, "b": 1000, None: 50, "": 0, "ä": 300, "Z": 5}
    found = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"), (5, 2, 1), 1.5, 2)
    rows = {r.source: r.target for r in found.collect()}
    assert rows == pytest.approx(wanted_targets(sizes))
    assert sum(rows.values()) == pytest.approx(1.5 * sum(sizes.values()))


@pytest.mark.parametrize(("n", "k", "d"), [(50, 20, 10), (1000, 990, 500), (7, 3, 7), (9, 0, 4), (5000, 2500, 1)])
def test_hypergeometric_draws(spark, n, k, d):
    """Over an even grid of uniform numbers values come in their exact proportions."""
    steps = 2000
    found = spark.range(steps).selectExpr(mixing.hypergeometric(f"{n}L", f"{k}L", f"{d}L", f"(id + 0.5D) / {steps}") + " AS x")
    got = np.bincount([r.x for r in found.collect()], minlength=d + 1) / steps
    from math import comb

    exact = np.array([comb(k, x) * comb(n - k, d - x) / comb(n, d) if 0 <= d - x <= n - k else 0.0 for x in range(d + 1)])
    assert np.abs(got[: d + 1] - exact).max() < 2 / steps


def test_tree_gives_every_block_to_one_shard(spark):
    quotas = spark.createDataFrame([(1, 700), (2, 35), (3, 0), (4, 1)], "part int, blocks long")
    rows = mixing.split_quotas(quotas, 13, 5).collect()
    assert rows == mixing.split_quotas(quotas, 13, 5).collect()
    for part, blocks in ((1, 700), (2, 35), (3, 0), (4, 1)):
        assert sum(r.blocks for r in rows if r.part == part) == blocks
    per_shard = [sum(r.blocks for r in rows if r.shard == s) for s in range(13)]
    assert max(per_shard) - min(per_shard) <= 4
    assert len({r.blocks for r in rows if r.part == 2}) > 1


def test_mix_with_odd_rows(docs, empty):
    rows = mixing.mix(docs, shards=3, block_words=20).collect()
    check_mix(rows, [(r.doc_id, r.source, r.text) for r in docs.collect()], longest_slack=1.0)
    assert len(rows) == docs.count()
    assert mixing.mix(empty).count() == 0


def test_hot_source_and_shards(spark):
    docs = spark.range(900).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"),
        F.expr("repeat('w ', 1 + cast(id % 40 AS int))").alias("text"),
    )
    plan = mixing.mix(docs, shards=8, block_words=100)
    rows = plan.collect()
    check_mix(rows, [(r.doc_id, r.source, r.text) for r in docs.collect()])
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs.repartition(5), shards=8, block_words=100).collect()))
    out = mixing.mixed(docs, plan).collect()
    assert len(out) == sum(len(r.draws) for r in rows)
    words_in = np.bincount([r.shard for r in out], [len(words(r.text)) for r in out])
    assert len(words_in) == 8 and words_in.max() < 1.5 * words_in.min()


def test_query_runs_no_python(spark, sf_dir):
    found = QUERIES["op9_splitting_tree_mix"](spark, sf_dir)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text
    docs = {r.doc_id: (r.doc_id, r.source, r.text) for r in table(spark, sf_dir, "documents").collect()}
    source = spark.createDataFrame([(k, v[1]) for k, v in docs.items()], "doc_id long, source string")
    check_mix(found.join(source, "doc_id").collect(), docs.values())


def test_rows_repeated_in_place_are_those_of_the_plan(spark, docs, empty):
    plan = mixing.mix(docs, shards=3, block_words=20).collect()
    times: dict = {}
    for r in plan:
        times[r.source, r.doc_id] = max(times.get((r.source, r.doc_id), 0), len(r.draws))
    wanted = sorted(repr(r) for r in docs.collect() for _ in range(times[r.source, r.doc_id]))
    found = mixing.repeat_in_place(docs, block_words=20)
    assert found.columns == docs.columns
    assert sorted(map(repr, found.collect())) == wanted
    assert mixing.repeat_in_place(empty).count() == 0
    with pytest.raises(ValueError, match="inside"):
        mixing.repeat_in_place(docs.withColumn("_block", F.lit(1)))


def test_texts_stay_where_they_lie(spark, sf_dir):
    docs = table(spark, sf_dir.replace("sf0.001", "sf0.01"), "documents")
    found = mixing.repeat_in_place(docs)
    plan = mixing.mix(docs).collect()
    assert sorted(r.doc_id for r in found.select("doc_id").collect()) == sorted(r.doc_id for r in plan for _ in r.draws)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in text and "SortMergeJoin" not in text and "Python" not in text and "Arrow" not in text


def test_blank_rows_and_missing_keys_of_a_hot_source(spark):
    """Many rows without words, and many without a key, beside some of each."""
    docs = spark.range(600).select(
        F.expr("if(id % 3 = 0, NULL, id)").alias("doc_id"),
        F.expr("if(id % 2 = 0, 'blank', 'some')").alias("source"),
        F.expr("CASE WHEN id % 2 = 0 AND id > 8 THEN ' ' WHEN id % 5 = 0 THEN NULL ELSE repeat('w ', 7) END").alias("text"),
    )
    rows = mixing.mix(docs, shards=4, block_words=50).collect()
    check_mix(rows, [(r.doc_id, r.source, r.text) for r in docs.collect()], longest_slack=1.0)
    assert len(rows) == 600 and all(r.taken == r.size * len(r.draws) for r in rows)


def test_rows_lie_in_the_shards_of_the_tree(spark, sf_dir, docs, empty):
    """The rows of the plan, in its shards and their order; with odd rows as often as the plan takes them."""
    many = table(spark, sf_dir.replace("sf0.001", "sf0.01"), "documents")
    found = mixing.mix_rows(many, block_words=512)
    assert found.columns == many.columns
    wanted = mixing.mixed(many, mixing.mix(many, block_words=512))
    assert [r.doc_id for r in found.select("doc_id").collect()] == [r.doc_id for r in wanted.select("doc_id").collect()]

    plan = mixing.mix(docs, shards=3, block_words=20).collect()
    times: dict = {}
    for r in plan:
        times[r.source, r.doc_id] = max(times.get((r.source, r.doc_id), 0), len(r.draws))
    rows = sorted(repr(r) for r in docs.collect() for _ in range(times[r.source, r.doc_id]))
    assert sorted(map(repr, mixing.mix_rows(docs, shards=3, block_words=20).collect())) == rows
    assert mixing.mix_rows(empty).count() == 0
    with pytest.raises(ValueError, match="inside"):
        mixing.mix_rows(docs.withColumn("_block", F.lit(1)))


def test_pipeline_mixes_by_the_tree(spark, sf_dir, monkeypatch):
    import corpus_pipeline

    trees = []
    split = mixing.split_quotas
    monkeypatch.setattr(mixing, "split_quotas", lambda *a: trees.append(a) or split(*a))
    docs = table(spark, sf_dir, "documents")
    assert corpus_pipeline.mix_sources(spark, docs, sf_dir).count() == sum(len(r.draws) for r in mixing.mix(docs).collect())
    # once for the stage, once for the plan above
    assert len(trees) == 2
