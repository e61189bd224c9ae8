"""Every stage of the corpus pipeline on its own input."""

from __future__ import annotations

import corpus_pipeline
import pytest
from conftest import rows as sorted_rows
from llm.test_groups import brute_texts
from llm.test_mixing import check_mix
from llm.test_tokens import check_packing, whole
from pyspark.sql import functions as F

from tablewright.llm.queries import table
from tablewright.storage import stash


def test_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    labels = {r.doc_id: r.quality for r in table(spark, sf_dir, "labels").collect()}
    names = [name for name, _ in corpus_pipeline.STAGES]
    stages = [f for _, f in corpus_pipeline.STAGES]
    assert len(names) == 5

    good = stash(stages[0](spark, docs, sf_dir), "test")
    assert good.columns == columns
    kept = {r.doc_id for r in good.collect()}
    clean = [i for i, y in labels.items() if y == 1]
    assert sum(i in kept for i in clean) >= 0.98 * len(clean)

    single = stash(stages[1](spark, good, sf_dir), "test")
    _, reach = brute_texts(good)
    assert single.columns == columns
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for i, root in reach.items() if i == root)

    cut = stash(stages[2](spark, single, sf_dir), "test")
    assert cut.columns == columns
    before = {r.doc_id: r for r in single.collect()}
    for r in cut.collect():
        old = before.pop(r.doc_id)
        assert (r.lang, r.source) == (old.lang, old.source)
        assert r.text == old.text or ("[SECRET]" in r.text and r.n_chars == len(r.text))
    assert not before

    mix = stash(stages[3](spark, cut, sf_dir), "test")
    assert mix.columns == columns
    again = stages[3](spark, cut, sf_dir)
    assert sorted_rows(mix.select("doc_id")) == sorted_rows(again.select("doc_id"))
    from tablewright.llm import mixing

    plan = mixing.mix(cut).collect()
    check_mix(plan, [(r.doc_id, r.source, r.text) for r in cut.collect()])
    assert mix.count() == sum(len(r.draws) for r in plan)

    packed = stages[4](spark, mix, sf_dir).collect()
    assert sum(p.length for p in packed) == sum(map(len, whole([r.text for r in mix.collect()])))
    check_packing(packed, 1024)


def test_empty_documents_pass_through(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stash(stage(spark, docs, sf_dir), "test")
        assert docs.count() == 0


def test_one_row_of_each_document_and_no_unlike_text_goes(spark):
    same = "one two three four five six seven eight nine ten eleven twelve"
    rows = [
        (3, same, "en", "b", 1), (11, same, "en", "a", 1), (11, "quite another text that nobody else has ever written down here", "en", "a", 1),
        (11, same + " ", "de", "a", 1), (20, "alone", "en", "a", 1), (20, "alone", "en", "b", 1), (20, "alone", "en", "b", 1),
        (None, same, "en", "a", 1), (None, "a text without an id that stands here twice", "en", "a", 1), (None, "a text without an id that stands here twice", "en", "a", 1),
        (30, "", "en", "a", 1), (31, "", "en", "a", 1), (32, None, "en", "a", 1), (32, None, "en", "a", 1), (33, " ", "en", "a", 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    kept = corpus_pipeline.keep_one_copy(spark, docs, "")
    assert kept.columns == docs.columns
    wanted = [rows[i] for i in (0, 2, 4, 8, 10, 11, 12, 14)]
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(wanted, key=repr)
    mix = corpus_pipeline.mix_sources(spark, docs, "")
    assert mix.columns == docs.columns
    assert {r.text for r in mix.collect()} <= {r[1] for r in rows}
    packed = corpus_pipeline.pack_sequences(spark, docs, "").collect()
    assert sum(p.length for p in packed) == sum(map(len, whole([r[1] for r in rows])))
    for stage, name in ((corpus_pipeline.keep_one_copy, "_row"), (corpus_pipeline.mix_sources, "_time")):
        with pytest.raises(ValueError, match="inside"):
            stage(spark, docs.withColumn(name, F.lit(1)), "")


def test_stages_with_odd_rows_and_clashing_columns(spark, sf_dir):
    """NULL ids, texts and sources, repeated rows; columns with names that a stage uses inside are an error."""
    rows = [(None, None, "en", None, None), (None, "", "en", "a", 0), (-1, 'x token = "bc0d31ba76f17e56642e8751295a3fd50cd8e61f" y', None, "a", 54)]
    rows += 2 * [(-2, "the same row stands here twice", "en", "a", 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    good = corpus_pipeline.keep_good(spark, docs, sf_dir)
    # no label belongs to these documents, so nothing tells them apart
    assert good.columns == docs.columns and good.count() in (0, 5)
    cut = corpus_pipeline.cut_secrets(spark, docs, sf_dir)
    assert cut.columns == docs.columns and cut.count() == 5
    assert cut.where("text IS NULL").count() == 1 and cut.where("n_chars IS NULL").count() == 1
    assert corpus_pipeline.mix_sources(spark, docs, sf_dir).columns == docs.columns
    for stage, name in ((corpus_pipeline.keep_good, "_score"), (corpus_pipeline.cut_secrets, "_found")):
        with pytest.raises(ValueError, match="exists"):
            stage(spark, docs.withColumn(name, F.lit(1)), sf_dir)
