"""Streams over tables that are folders of files, as large tables are."""

import __spark_entry__ as entry
from pyspark.sql import functions as F

from tessera.sources.tables import scratch_path
from tessera.streaming import streams


def test_streams_read_every_file_of_a_table(spark):
    sf = scratch_path(spark, "tables")
    conv = [(i, t, "user" if t % 2 == 0 else "assistant", f"Question {i % 7}?" if t % 2 == 0 else f"The long answer to it, {i % 3}") for i in range(20) for t in range(2 + 2 * (i % 2))]
    spark.createDataFrame(conv, "conv_id long, turn int, role string, text string").repartition(3).write.parquet(f"{sf}/conversations.parquet")
    spark.range(60).selectExpr("id as event_id", "id % 4 as user_id", "timestamp'2024-01-01' + make_dt_interval(0, cast(id as int)) as ts", "'click' as event_type") \
        .repartition(3).write.parquet(f"{sf}/events.parquet")
    queries = entry.queries()
    asked = queries["stream_answers"](spark, sf)
    assert asked.columns == ["key", "conv_id", "turn", "answer", "source"]
    assert asked.count() == sum(r[2] == "user" for r in conv) and asked.where("answer is null").count() == 0
    assert queries["stream_dedupe"](spark, sf).count() == 7
    assert queries["stream_capture"](spark, sf).count() == 60
    assert queries["stream_throttle"](spark, sf).count() == queries["throttle"](spark, sf).count() > 0
    assert queries["stream_every_nth"](spark, sf).count() == queries["every_nth"](spark, sf).count() > 0


def test_answers_of_an_empty_stream(spark):
    folder = scratch_path(spark, "no-questions")
    spark.createDataFrame([], "qid long, key string, asked_at timestamp").write.parquet(folder)
    asked = streams.read_stream(spark, folder, "qid long, key string, asked_at timestamp").where("false")
    out = streams.answer_stream(asked, scratch_path(spark, "answers"), lambda new: new.withColumn("answer", F.lit("x")), scratch_path(spark, "asked"))
    assert out.columns == ["key", "qid", "asked_at", "answer", "source"] and out.count() == 0
