"""Text operators: blocks, question keys, answer cache, prompt table
(S4, S5, W1, F1-F7, J5, M10).

Every document is split inside its own row (no shuffle); numbering after
dropping empty pieces happens in the array, so ``posexplode`` gives the block
id directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as TX


def text_blocks(df: DataFrame, id_col: str, text: str, pattern: str = TX.BLOCK_SEPARATOR,
                out: str = "text", keep: tuple = ()) -> DataFrame:
    """S4 + W1: split every text on ``pattern``, strip, drop empties, number
    blocks from 1 per text. ``keep`` columns travel along (no join back)."""
    return df.select(id_col, *keep, F.posexplode(TX.split_blocks(F.col(text), pattern)).alias("_p", out)).select(
        id_col, *keep, (F.col("_p") + 1).alias("block_id"), out)


def read_text_blocks(spark, paths, pattern: str = TX.BLOCK_SEPARATOR) -> DataFrame:
    """Whole files -> (topic, block_id, text); topic = file name without
    extension."""
    raw = spark.read.text(paths, wholetext=True).withColumn("_path", F.input_file_name())
    raw = raw.withColumn("topic", F.regexp_extract("_path", r"([^/]+?)(\.[^./]*)?$", 1))
    return text_blocks(raw, "topic", "value", pattern)


def write_text_blocks(df: DataFrame, path: str, topic: str = "topic") -> None:
    """Blocks back to text, renumbered from 1, one folder per topic."""
    from pyspark.sql import Window

    w = Window.partitionBy(topic).orderBy("block_id")
    out = df.withColumn("_i", F.row_number().over(w)).select(
        topic, "_i", F.concat(TX.block_header(F.col("_i")), F.lit("\n"), F.col("text"), F.lit("\n\n")).alias("value"))
    (out.repartition(topic).sortWithinPartitions(topic, "_i").select(topic, "value")
     .write.mode("overwrite").partitionBy(topic).text(path))


def question_keys(df: DataFrame, text: str = "text", out: str = "key") -> DataFrame:
    """Normalised question key."""
    return df.withColumn(out, TX.question_key(F.col(text)))


def unanswered(questions: DataFrame, cache: DataFrame, key: str = "key") -> DataFrame:
    """Questions whose key is not cached (left anti join)."""
    return questions.join(cache.select(key).distinct(), key, "left_anti")


def answer_cache(turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text") -> DataFrame:
    """Answer cache built from conversations: a user question is answered when
    the next turn is an assistant reply of at least 20 characters (short or
    failed answers are not cached). Returns (key, answer)."""
    q = turns.where(F.col(role) == "user").select(
        conv, turn, TX.question_key(F.col(text)).alias("key"))
    a = turns.where((F.col(role) == "assistant") &
                    (F.length(TX.strip_ws(F.col(text))) >= TX.MIN_CONTEXT_CHARS)).select(
        conv, (F.col(turn) - 1).alias(turn), F.col(text).alias("answer"))
    return q.join(a, [conv, turn]).select("key", "answer")
