"""Structured Streaming operators (K1-K6).

Sources are file streams (``readStream`` with a schema); sinks are parquet
folders with a checkpoint location, both under the shared checkpoint folder
unless the caller gives paths. ``run_available`` drives a query with
``trigger(availableNow=True)`` so a job processes what has arrived and stops.

Work in ``foreachBatch`` (retraining, scoring by a registry, answers) writes a
folder for each epoch, which a replay replaces, and commits versions by epoch.

Keyed state (cool-down, every-n-th) uses ``applyInPandasWithState``: the
state per key is O(1) (last accepted time, a counter), and a group holds only
that key's rows *of one micro-batch*, never its history. Rows of one key are
handled in event order inside a batch and in arrival order across batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tessera.sources.tables import scratch_path


def read_stream(spark: SparkSession, folder: str, schema, glob: str | None = None,
                max_files: int | None = None) -> DataFrame:
    """File stream over a folder (optionally only files matching ``glob``; the
    names of folders aren't matched with it: see ``read_table_stream``)."""
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(folder)


def read_table_stream(spark: SparkSession, sf: str, name: str, schema) -> DataFrame:
    """File stream over the table ``name`` of a folder: one file, or a folder of
    files. A stream's own path must be a folder unless it is a pattern, so the
    last letter is written as one."""
    return read_stream(spark, f"{sf}/{name}.parque[t]", schema)


def run_available(df: DataFrame, name: str, out: str | None = None,
                  foreach_batch: Callable | None = None) -> DataFrame:
    """Run a streaming DataFrame over everything available, append to a
    parquet sink and return the sink read back as a batch DataFrame."""
    spark = df.sparkSession
    out = out or scratch_path(spark, f"{name}-out")
    ckpt = f"{out}/_checkpoint"
    w = df.writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True)
    if foreach_batch is not None:
        q = w.foreachBatch(foreach_batch).start()
    else:
        q = w.format("parquet").outputMode("append").option("path", f"{out}/data").start()
    q.awaitTermination()
    if foreach_batch is not None:
        return None
    return spark.read.schema(df.schema).parquet(f"{out}/data")


def capture(stream: DataFrame, manual: F.Column) -> DataFrame:
    """K1: keep rows logged while in manual mode."""
    return stream.where(manual)


def score_stream(stream: DataFrame, score: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """K2: apply a scoring function (e.g. ``PipelineModel.transform`` or a
    compiled network) to every live row: a projection, no state."""
    return score(stream)


def _throttle_fn(ts: str, id_col: str, gap_us: int):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState):
        last = state.get[0] if state.exists else None
        if frames := list(pdfs):  # a key's rows of one micro-batch come in several frames
            pdf = pd.concat(frames).sort_values([ts, id_col], kind="stable")
            t_us = pdf[ts].astype("datetime64[us]").astype("int64").to_numpy()
            keep = []
            for t in t_us:
                ok = last is None or t - last >= gap_us
                keep.append(ok)
                if ok:
                    last = int(t)
            out = pdf[keep]
            if len(out):
                yield out
        if last is not None:
            state.update((last,))
    return fn


def throttle_stream(stream: DataFrame, key: str, ts: str, id_col: str, gap_seconds: int) -> DataFrame:
    """K3: per key, accept a row only when at least ``gap`` has passed since
    the last accepted one (state: last accepted time in microseconds)."""
    schema = stream.schema
    return stream.groupBy(key).applyInPandasWithState(
        _throttle_fn(ts, id_col, int(gap_seconds) * 1_000_000), schema, "last long",
        "append", GroupStateTimeout.NoTimeout)


def _every_nth_fn(ts: str, id_col: str, n: int):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState):
        seen = state.get[0] if state.exists else 0
        if frames := list(pdfs):
            pdf = pd.concat(frames).sort_values([ts, id_col], kind="stable")
            pos = seen + pd.RangeIndex(len(pdf)).to_numpy()
            seen += len(pdf)
            out = pdf[(pos % n) == 0].assign(rn=(pos[(pos % n) == 0] + 1).astype("int64"))
            if len(out):
                yield out
        state.update((int(seen),))
    return fn


def every_nth_stream(stream: DataFrame, key: str, ts: str, id_col: str, n: int) -> DataFrame:
    """K5: keep positions 0, n, 2n, ... of every key (state: rows seen)."""
    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType(stream.schema.fields + [StructField("rn", LongType())])
    return stream.groupBy(key).applyInPandasWithState(
        _every_nth_fn(ts, id_col, n), schema, "seen long", "append", GroupStateTimeout.NoTimeout)


def dedupe_questions(stream: DataFrame, key: str, event_time: str, within: str = "1 hour") -> DataFrame:
    """K4: answer each normalised question once: duplicates inside the
    watermark delay are dropped, state older than it is evicted."""
    return stream.withWatermark(event_time, within).dropDuplicatesWithinWatermark([key])


def epoch_folder(path: str, stream: str, epoch: int) -> str:
    return f"{path.rstrip('/')}/stream={stream}/epoch={epoch}"


def write_epoch(batch: DataFrame, path: str, stream: str, epoch: int) -> None:
    """A micro-batch as the folder of its epoch: a replayed epoch replaces
    itself, so that it adds nothing."""
    batch.write.mode("overwrite").parquet(epoch_folder(path, stream, epoch))


def read_epochs(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All epochs of all streams in a folder, with ``stream`` and ``epoch``; no
    rows if there are none yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = f"{schema}, stream string, epoch long"
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(path)


def retrain_job(stream: DataFrame, table_path: str, on_batch: Callable[[DataFrame, int], None] | None = None,
                registry=None, spec: list[dict] | None = None, id_col: str | None = None,
                every_rows: int = 1, every_seconds: float | None = None, name: str = "retrain", out: str | None = None):
    """K6: flush captured rows to the training table, an epoch at a time, and
    retrain when ``every_rows`` rows came since the last version, or
    ``every_seconds`` have passed since it.

    Each epoch is a folder of the table (a replay replaces it); a version of the
    registry names the epoch that caused it and an epoch is published once. So a
    run that died anywhere between the two is repeated without doubled rows or
    versions. ``spec`` and ``id_col`` go to ``models.train_all``, which trains on
    the whole table; a version's notes have the rows seen and left out, and the
    items that the training guard refused. ``on_batch`` is called after the flush."""
    import time

    from tessera.plans import models

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema.fields)

    def flush(batch: DataFrame, epoch: int):
        spark = batch.sparkSession
        write_epoch(batch, table_path, name, epoch)
        if on_batch is not None:
            on_batch(batch, epoch)
        if registry is None:
            return
        last = registry.latest()
        if last.epoch is not None and epoch <= last.epoch:
            return
        table = read_epochs(spark, table_path, schema)
        fresh = table.where((F.col("stream") == name) & (F.col("epoch") > F.lit(-1 if last.epoch is None else last.epoch))).count()
        late = every_seconds is not None and fresh and time.time() - last.published >= every_seconds
        if fresh < every_rows and not late:
            return
        rows = table.drop("stream", "epoch")
        trained = models.train_all(rows, spec, id_col, as_models=True)
        dropped = {r["name"]: [r.n_rows, r.n_dropped] for r in models.dropped_rows(rows, spec).collect()}
        refused = {k: v for k, (m, v) in trained.items() if m is None}
        registry.publish({k: m for k, (m, _) in trained.items() if m is not None}, epoch, {"rows_and_dropped": dropped, "refused": refused})

    return run_available(stream, name, out=out, foreach_batch=flush)


def score_with_registry(stream: DataFrame, registry, out: str, keep: list[str], name: str = "score",
                        names: tuple[str, ...] = ()) -> DataFrame:
    """K2: score live rows with all models of a registry version (or those in
    ``names``), loaded once and exchanged only between micro-batches, when the
    registry has a newer version. Returns the sink: ``keep``, a ``pred_<label>``
    for each model and ``model_version``. Until there is a version, predictions
    are null. A replayed epoch replaces its own rows."""
    loaded: dict = {"version": None}

    def score(batch: DataFrame, epoch: int):
        last = registry.latest()
        if loaded["version"] != last.number:
            loaded.update(version=last.number, models=last.load(*names))
        rows = batch
        for model in loaded["models"].values():
            rows = model.transform(rows).drop("features")
        preds = [c for c in rows.columns if c.startswith("pred_")]
        rows = rows.select(*keep, *[F.col(c).cast("double").alias(c) for c in preds], F.lit(last.number).cast("long").alias("model_version"))
        write_epoch(rows, f"{out}/scored", name, epoch)

    run_available(stream, name, out=out, foreach_batch=score)
    return stream.sparkSession.read.option("mergeSchema", True).parquet(f"{out}/scored").drop("stream", "epoch")


def answer_stream(questions: DataFrame, cache_path: str, answer: Callable[[DataFrame], DataFrame], out: str,
                  key: str = "key", order: tuple[str, ...] = ("asked_at", "qid"), name: str = "answers") -> DataFrame:
    """K4: answer each question key once, across micro-batches, restarts and
    streams that share a cache.

    Of each micro-batch the first question of each key (by ``order``) that no
    other epoch has answered (anti join with the cache) goes to ``answer``, a
    function ``(key, ...) -> (key, answer)`` of a DataFrame; its answers are the
    epoch's part of the cache. A null answer isn't cached. Every question is
    written to the sink with its answer and ``source`` ("cache" or "new"). A
    replayed epoch replaces its own part of both."""

    def respond(batch: DataFrame, epoch: int):
        spark = batch.sparkSession
        batch = batch.persist()
        cache = read_epochs(spark, cache_path, f"`{key}` string, answer string")
        cache = cache.where(~((F.col("stream") == name) & (F.col("epoch") == epoch))).groupBy(key).agg(F.min("answer").alias("answer"))
        asked = batch.groupBy(key).agg(F.min(F.struct(*order, *[c for c in batch.columns if c not in {key, *order}])).alias("_first"))
        new = asked.select(key, "_first.*").where(F.col(key).isNotNull()).join(cache, key, "left_anti")
        write_epoch(answer(new).select(key, "answer").where("answer is not null"), cache_path, name, epoch)
        fresh = spark.read.schema(f"`{key}` string, answer string").parquet(epoch_folder(cache_path, name, epoch))
        known = cache.withColumn("source", F.lit("cache")).unionByName(fresh.withColumn("source", F.lit("new")))
        write_epoch(batch.join(known, key, "left"), f"{out}/asked", name, epoch)
        batch.unpersist()

    run_available(questions, name, out=out, foreach_batch=respond)
    fields = [*[f for f in questions.schema.fields if f.name == key], *[f for f in questions.schema.fields if f.name != key]]
    asked = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return read_epochs(questions.sparkSession, f"{out}/asked", f"{asked}, answer string, source string").drop("stream", "epoch")
