"""Sources and sinks.

Scratch output goes under the session's shared checkpoint folder
(``spark.checkpoint.dir``), never a machine-local temporary folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import ensure_checkpoint_dir

# The six-column training table written by the capture loop.
TRAINING_SCHEMA = T.StructType([
    T.StructField("velocidad_balax", T.IntegerType()),
    T.StructField("bala_h_x", T.IntegerType()),
    T.StructField("velocidad_balay", T.IntegerType()),
    T.StructField("bala_v_y", T.IntegerType()),
    T.StructField("accion_horizontal", T.IntegerType()),
    T.StructField("salto", T.IntegerType()),
])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def read_table_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header; an explicit schema when known, else inferred."""
    r = spark.read.option("header", True)
    if schema is not None:
        return r.schema(schema).csv(path)
    return r.option("inferSchema", True).csv(path)


def write_table_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, overwrite, no index column."""
    df.write.mode("overwrite").option("header", True).csv(path)


def reset_table(spark: SparkSession, schema: T.StructType, path: str) -> None:
    """S3: replace a table by its header only (one empty part file)."""
    spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Append rows to a CSV table (no header repeat per part)."""
    df.write.mode("append").option("header", True).csv(path)


def from_rows(spark: SparkSession, rows, schema) -> DataFrame:
    """A DataFrame from in-memory rows with named columns."""
    return spark.createDataFrame(rows, schema)


def write_vectors(df: DataFrame, path: str, topic: str = "topic") -> None:
    """S6/S7 (exact index): vectors as parquet, one folder per topic so a
    routed search reads one topic only (partition pruning)."""
    df.write.mode("overwrite").partitionBy(topic).parquet(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_labelled_files(spark: SparkSession, root: str) -> DataFrame:
    """Every file under ``root/<class>/...``; label = ordinal of the class
    folder among the sorted folder names. The folder list is one row per
    class (a bounded broadcast)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
             .withColumn("folder", F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1)))
    from pyspark.sql import Window

    folders = files.select("folder").distinct()
    folders = folders.withColumn("label", F.row_number().over(Window.orderBy("folder")) - 1)
    return files.join(F.broadcast(folders), "folder")


def load_labelled(df: DataFrame, features: list[str], label: str, out: str = "features") -> DataFrame:
    """Feature columns -> one vector column next to the label."""
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=features, outputCol=out).transform(df).select(out, label)
