"""A training-data pipeline over the table ``documents``: five operators of ``tablewright.llm`` in a row.

Each stage takes (spark, documents, folder of the test tables) and returns a frame; ``run`` writes it and hands the
written table to the next. All stages but the last return the columns of documents. An empty table passes through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import knn_quality, mixing, ngram_join, packing, secrets
from tablewright.storage import stash

#: kept keys that a broadcast may hold; beyond it the join shuffles
BROADCAST_IDS = 1_000_000

# Not expressible in SQL: trained models, tokenizers and packing. tests/llm compares the stages with brute force.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score by labelled neighbours is 0.3 or more; NULL and empty texts get the share of good labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    space = knn_quality.fit(docs, labels.where(~held_out), "quality")
    return knn_quality.score(docs, space, name="_score").where("_score >= 0.3").drop("_score")


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id, of equal ids the one with the smallest hash.

    A document is an id and a text: rows of one id with unlike texts are documents of their own. Ids that are NULL come after all others.
    Of rows equal in both the one with the smallest other columns stays. Texts without words are no copies of each other.
    """
    if used := {"_row", "_rows"} & set(docs.columns):
        raise ValueError(f"columns {sorted(used)} are used inside")
    marked = docs.withColumn("_row", F.xxhash64("doc_id", "text"))
    groups = ngram_join.near_duplicates(marked.select("_row", "text"), key="_row").select("_row", "component_id").distinct()
    rows = marked.groupBy("_row").agg(F.min("doc_id").alias("id"), F.count("*").alias("n"))
    groups = stash(groups.join(rows, "_row"), "pipeline-groups")
    first = F.min_by("_row", F.struct(F.col("id").isNull(), "id", "_row"))
    stays = groups.groupBy("component_id").agg(first.alias("_first"))
    copies = groups.join(stays, "component_id").where("_row <> _first").select("_row")
    kept = marked.join(_small(stash(copies, "pipeline-copies")), "_row", "left_anti")
    again = stash(groups.where("n > 1").select("_row"), "pipeline-again")
    if again.isEmpty():
        return kept.select(*docs.columns)
    single = kept.join(_small(again), "_row", "left_semi").groupBy("_row").agg(F.min(F.struct(*docs.columns)).alias("_rows"))
    return kept.join(_small(again), "_row", "left_anti").select(*docs.columns).unionAll(single.select("_rows.*"))


def _small(ids: DataFrame) -> DataFrame:
    """Written ids, to be broadcast if they are few enough."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def cut_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with secrets replaced by a mark, and ``n_chars`` brought up to date where a text changed."""
    found = secrets.scan(docs, secrets.fit(docs, path="source"), path="source", name="_found")
    text, changed = F.col("_found.redacted"), F.size("_found.found") > 0
    new = {"text": text, "n_chars": F.when(changed, F.length(text).cast("long")).otherwise(F.col("n_chars"))}
    return found.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix draws it, in the shards of the splitting tree; rows of one id and source, NULL included, are taken alike. NULL is a source, NULL texts hold no words."""
    return mixing.mix_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 1024 tokens; NULL texts are an end id, rows of one id are packed each."""
    cut = stash(packing.pieces(docs), "pipeline-pieces")
    return packing.pack(cut, order=("doc_id", "piece", "ids_crc32"))


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_copy),
    ("secret scans", cut_secrets),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
