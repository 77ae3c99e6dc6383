"""A stored, versioned vector index with a cell for each topic.

An index is a folder of segments (Parquet, a folder for each cell) and
manifests that say which segments a version has. Adding vectors writes a
segment of only them; compaction writes all vectors of a version as one segment.
A later job opens the last version, or an earlier one, and searches: only the
folders of the cells that its queries ask for are listed and read.

Vectors of a segment replace those of earlier segments with the same id.
Vectors without an id, a topic or components take no part.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import vectors
from tessera.sources.manifest import Conflict, Manifest

#: different topics of a set of queries up to which reading is restricted to
#: them in the plan; beyond, they are kept by a semi-join
MOST_CELLS = 1000
_COLUMNS = ("vec_id", "topic", "vec")


class VectorIndex:
    def __init__(self, spark: SparkSession, path: str, version: int | None = None):
        """Open a version (the last by default) of the index at ``path``."""
        self.spark, self.path = spark, path.rstrip("/")
        self.manifest = Manifest(spark, path)
        self.version, content = self.manifest.read(version)
        if not content:
            raise FileNotFoundError(f"no index at {path}")
        self.segments: list[str] = content["segments"]
        self.topic_type: str = content["topic_type"]

    @staticmethod
    def create(df: DataFrame, path: str) -> VectorIndex:
        """A new index of ``df(vec_id, topic, vec)``; fails if there is one."""
        spark = df.sparkSession
        segment = _write_segment(df, path)
        Manifest(spark, path).commit(1, {"segments": [segment], "topic_type": df.schema["topic"].dataType.simpleString()})
        return VectorIndex(spark, path)

    def _commit(self, make, tries: int = 20) -> VectorIndex:
        """The next version, made from the last one's segments; again from the
        newer ones if another job was faster."""
        for _ in range(tries):
            version, content = self.manifest.read()
            try:
                self.manifest.commit(version + 1, {**content, "segments": make(content["segments"])})
                return VectorIndex(self.spark, self.path, version + 1)
            except Conflict:
                continue
        raise Conflict(f"{self.path}: {tries} other versions came first")

    def append(self, df: DataFrame) -> VectorIndex:
        """A version with the vectors of ``df`` too; nothing else is written."""
        segment = _write_segment(df, self.path)
        return self._commit(lambda segments: [*segments, segment])

    def compact(self) -> VectorIndex:
        """A version with this version's vectors in one segment; segments that
        others have added meanwhile stay behind it."""
        old = list(self.segments)
        segment = _write_segment(self.read(), self.path)

        def make(segments):
            if segments[: len(old)] != old:
                raise ValueError("this version's segments were compacted by another job")
            return [segment, *segments[len(old) :]]

        return self._commit(make)

    def read(self, cells: Sequence | None = None) -> DataFrame:
        """(vec_id, topic, vec) of all vectors, or those of some cells."""
        out = None
        for i, segment in enumerate(self.segments):
            own = self._segment(segment, cells)
            if newer := self.segments[i + 1 :]:
                ids = None
                for s in newer:  # a vector may have moved to another cell
                    part = self._segment(s, None).select("vec_id")
                    ids = part if ids is None else ids.unionByName(part)
                own = own.join(ids, "vec_id", "left_anti")
            out = own if out is None else out.unionByName(own)
        return out

    def _segment(self, segment: str, cells: Sequence | None) -> DataFrame:
        schema = f"vec_id long, vec array<double>, topic {self.topic_type}"
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/{segment}")
        if cells is not None:
            rows = rows.where(F.col("topic").isin(list(cells)))
        return rows.select(*_COLUMNS)

    def search(self, queries: DataFrame, k: int = 1, exclude_self: bool = False) -> DataFrame:
        """The k nearest vectors (squared L2, exact) of each of ``queries(qid,
        topic, vec)`` in its topic's cell: (qid, topic, rank, bid, dist)."""
        topics = queries.where("topic is not null").select("topic").distinct().limit(MOST_CELLS + 1).collect()
        if len(topics) <= MOST_CELLS:
            base = self.read([r.topic for r in topics])
        else:
            base = self.read().join(queries.select("topic"), "topic", "left_semi")
        base = base.withColumnRenamed("vec_id", "bid")
        return vectors.nearest_k(queries, base, k, exclude_self=exclude_self, on="topic")


def _write_segment(df: DataFrame, path: str) -> str:
    segment = f"segment-{uuid.uuid4().hex}"
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vec").cast("array<double>").alias("vec"), "topic")
    rows = rows.where("vec_id is not null and topic is not null and vec is not null")
    rows.write.partitionBy("topic").parquet(f"{path.rstrip('/')}/{segment}")
    return segment
