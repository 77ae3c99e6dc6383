"""Stream = batch: keyed-state operators over several micro-batches give the
same rows as their batch twins."""

from pyspark.sql import functions as F

from tessera.operators import prep, sequences
from tessera.sources.tables import scratch_path
from tessera.streaming import streams
from paths import SF_MID


def _daily_files(spark):
    ev = spark.read.parquet(f"{SF_MID}/events.parquet").select("event_id", "user_id", "ts", "event_type")
    path = scratch_path(spark, "events-by-day")
    days = [r[0] for r in ev.select(F.to_date("ts").alias("d")).distinct().orderBy("d").collect()]
    # one file per day, written in time order: micro-batches arrive in order
    for i, d in enumerate(days):
        ev.where(F.to_date("ts") == F.lit(d)).coalesce(1).write.parquet(f"{path}/day={i:03d}")
    return ev, path


def test_stream_matches_batch(spark):
    ev, path = _daily_files(spark)
    s = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).option(
        "recursiveFileLookup", True).parquet(path)
    got = streams.run_available(streams.throttle_stream(s, "user_id", "ts", "event_id", 24 * 3600), "t")
    want = sequences.throttle(ev, ["user_id"], "ts", "event_id", 24 * 3600)
    assert got.count() == want.count()
    assert got.select("event_id").subtract(want.select("event_id")).count() == 0

    s2 = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).option(
        "recursiveFileLookup", True).parquet(path)
    got2 = streams.run_available(streams.every_nth_stream(s2, "user_id", "ts", "event_id", 5), "n")
    want2 = prep.every_nth(ev, ["user_id"], ["ts", "event_id"], 5)
    assert got2.select("event_id", "rn").subtract(want2.select("event_id", "rn")).count() == 0
    assert got2.count() == want2.count()


def test_capture_and_retrain(spark):
    ev = spark.read.parquet(f"{SF_MID}/events.parquet")
    s = streams.read_stream(spark, SF_MID, ev.schema, glob="events.parquet")
    table = scratch_path(spark, "captured")
    seen = []
    streams.retrain_job(streams.capture(s, F.col("event_type") != "error"), table,
                        on_batch=lambda b, e: seen.append(e))
    assert spark.read.parquet(table).count() == ev.where("event_type <> 'error'").count()
    assert seen


def test_dedupe_repeated_questions(spark):
    # made-up repeats (the test conversations hold no duplicate questions)
    import datetime as dt

    from tessera.operators import text

    rows = [("¿Qué es la AUTONOMÍA?", dt.datetime(2024, 1, 1, 0, 0)),
            (" qué es la autonomía ", dt.datetime(2024, 1, 1, 0, 5)),
            ("QUE es la autonomia", dt.datetime(2024, 1, 1, 0, 6)),
            ("¿Y la eutanasia?", dt.datetime(2024, 1, 1, 0, 7)),
            ("¡¿QUÉ es la autonomía?!", dt.datetime(2024, 1, 1, 0, 10))]  # repeat of the first
    path = scratch_path(spark, "questions")
    spark.createDataFrame(rows, "text string, asked_at timestamp").coalesce(1).write.parquet(path)
    s = spark.readStream.schema("text string, asked_at timestamp").parquet(path)
    q = text.question_keys(s).select("key", "asked_at")
    out = streams.run_available(streams.dedupe_questions(q, "key", "asked_at", "1 hour"), "dedupe")
    keys = sorted(r.key for r in out.collect())
    assert len(keys) == 4  # the repeat is dropped
    # trim runs before punctuation becomes spaces, so "¿...?" keeps one space
    # at each end and the padded plain text does not; accents are kept
    assert keys == sorted({" qué es la autonomía ", "qué es la autonomía", "que es la autonomia",
                           " y la eutanasia "})
