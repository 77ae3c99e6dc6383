"""Session helpers: a local session for tests and a shared checkpoint folder.

On a cluster the session comes from the caller; we only read its settings.
``spark.checkpoint.dir`` is honoured when it is set and only filled in by us
when it is unset (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session configured like the tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tessera")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set a scratch one only when unset."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not conf_dir:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        # local runs and tests only: a fresh scratch folder under /tmp
        conf_dir = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return conf_dir


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str) -> None:
    """Expose every test table as a temp view of the same name."""
    for t in TABLES:
        read_table(spark, sf_dir, t).createOrReplaceTempView(t)

