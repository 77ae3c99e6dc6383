"""A training-data pipeline: quality rules, language identification, near
duplicates, mixing to target weights, packing.

Each stage takes all that its predecessor kept (as Parquet, read again) and
returns the columns of ``documents``; the last one returns packed pieces.

* quality: base rules and perplexity bands; documents they reject go.
* language: documents without letters, or in which no language has more than
  ``LEAST_SCORE`` of the words' probability, go. The model is trained on the
  rows given (those that aren't held out); clean texts that mix two languages
  stay.
* near_duplicates: of each group of linked documents the one with the smallest
  doc_id stays (one row of it). Rows are the same document if both doc_id and
  text are equal, so unlike texts that share an id stay; rows without a doc_id
  or words stay.
* mix: one row for each copy that the mix trains, in order of position.
* pack: pieces with their sequence and offset.

``ORACLE_SQL`` is None: language models, the trained labeller and tokenizers
have no SQL; tests compare the stages with brute force.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import crf_language, curriculum_mix, group_packing, kn_quality, partition_join
from tessera.session import ensure_checkpoint_dir

LEAST_SCORE = 0.34


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return kn_quality.judge(docs).where("kept").select(docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = crf_language.fit(docs.where(~crf_language.held_out()))
    found = crf_language.identify(docs, model)
    return found.where((F.col("lang_pred") != crf_language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # a document is an id and a text: unlike texts may share an id
    named = docs.where("doc_id is not null").withColumn("_row", F.xxhash64("doc_id", "text"))
    links = partition_join.link_documents(named.select(F.col("_row").alias("doc_id"), "text"))
    links = links.select(F.col("doc_id").alias("_row"), "component_id").distinct()
    ids = named.select("_row", "doc_id").distinct()
    first = links.join(ids, "_row").groupBy("component_id").agg(F.min(F.struct("doc_id", "_row")).alias("_first")).select("_first._row")
    one = F.row_number().over(Window.partitionBy("_row").orderBy(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]))
    kept = named.join(first, "_row", "left_semi").withColumn("_one", one).where("_one = 1")
    return kept.select(docs.columns).unionByName(docs.where("doc_id is null"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return curriculum_mix.mixed_copies(docs).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return group_packing.pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("mix", mix),
    ("pack", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again in the
    shared folder."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
