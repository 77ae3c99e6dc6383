"""Retrieval down to a prompt table (M10 with J1, J4, J5, F5-F7, F24, M9, M14).

Questions not in the answer cache are weighed over the terms of a stored
inverted index of the blocks (``inverted_index``), routed to the nearest topic
centroid, searched within that topic only (k nearest blocks, exact), and the
blocks' text is joined back and concatenated in rank order into the context of
a prompt. Generation is left to the caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as TX
from tessera.operators import text as text_ops
from tessera.plans import inverted_index
from tessera.sources.tables import scratch_path


def block_key(doc_id: str, block_id: str):
    """Key of a block: its text and its number there."""
    return F.struct(F.col(doc_id).alias("text_id"), F.col(block_id).alias("block_id"))


def retrieve(questions: DataFrame, blocks: DataFrame, k: int = 3, cache: DataFrame | None = None,
             index_path: str | None = None) -> DataFrame:
    """``questions(qid, text)``; ``blocks(bid, topic, text)``. Returns one row
    per question: qid, key, topic, context, prompt, messages, status. ``qid``
    and ``bid`` are of any type that has an order. The index is built at
    ``index_path`` (a scratch folder by default)."""
    spark = blocks.sparkSession
    q = text_ops.question_keys(questions, "text", "key")
    if cache is not None:
        q = text_ops.unanswered(q, cache, "key")
    index = inverted_index.build(blocks, index_path or scratch_path(spark, "blocks-index"))
    return answer_from(index, q, blocks.select("bid", "text"), k)


def answer_from(index: inverted_index.InvertedIndex, q: DataFrame, blocks: DataFrame, k: int = 3) -> DataFrame:
    """The prompt table of ``q(qid, key, text)`` from an index that is there.
    Questions of the same words have the same context: they are searched once.
    The rows of one ``qid`` are one question, whose context has each block once
    for each of them."""
    words = F.coalesce(F.split(F.lower("text"), inverted_index.TERM_BREAK), F.array().cast("array<string>"))
    known = q.groupBy("qid").agg(F.trim(F.array_join(F.array_sort(F.flatten(F.collect_list(words))), " ")).alias("text"), F.count(F.lit(1)).alias("_rows"))
    asked = known.select("text", "_rows").distinct().withColumn("_asked", F.monotonically_increasing_id()).checkpoint(eager=True)
    weights = index.weigh(asked, "_asked").checkpoint(eager=True)
    asked = asked.withColumnRenamed("_asked", "qid")
    topics = asked.select("qid").join(index.route(weights), "qid", "left").crossJoin(F.broadcast(index.last_topic().withColumnRenamed("topic", "_last")))
    topics = topics.select("qid", F.coalesce("topic", "_last").alias("topic")).where("topic is not null").checkpoint(eager=True)
    nn = index.nearest(weights, topics, k)
    texts = blocks.select("bid", F.col("text").alias("_bt"))
    nn = nn.join(asked.select("qid", F.explode(F.sequence(F.lit(1).cast("long"), "_rows"))).select("qid"), "qid")
    ctx = nn.join(texts, "bid").groupBy("qid", "topic").agg(
        TX.join_ranked(F.col("rank"), TX.strip_ws(F.col("_bt"))).alias("context"))
    ctx = asked.join(ctx, "qid").select("text", "_rows", "topic", "context")
    out = q.join(known.join(ctx, ["text", "_rows"]).select("qid", "topic", "context"), "qid", "left")
    prompt = TX.render_prompt(F.coalesce(F.col("context"), F.lit("")), F.col("text"))
    short = F.length(TX.strip_ws(F.coalesce(F.col("context"), F.lit("")))) < TX.MIN_CONTEXT_CHARS
    return out.select(
        "qid", "key", "topic", "context",
        F.when(short, F.lit(None).cast("string")).otherwise(prompt).alias("prompt"),
        F.when(short, F.lit(None)).otherwise(TX.messages(TX.SYSTEM_MESSAGE, prompt)).alias("messages"),
        F.when(short, F.lit(TX.NOT_ENOUGH_CONTEXT)).otherwise(F.lit("ready")).alias("status"),
    )
