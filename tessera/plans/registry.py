"""M5/K6: a registry of model versions.

A version is a set of named models (pipelines, exact trees, k-NN models) that
were trained together. Models are saved first, into a folder of their own; one
manifest, committed by an atomic rename, then makes them a version. A version
may carry the epoch of the stream that caused it: the same epoch is published
once, whatever is replayed.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

from tessera.plans import models as M
from tessera.sources.manifest import Manifest


@dataclass
class Version:
    number: int  # 0: none yet
    epoch: int | None
    published: float  # seconds since 1970
    entries: dict  # name -> {"kind", "path"}
    notes: dict

    def load(self, *names: str) -> dict:
        """The models of this version by name (all by default)."""
        return {n: M.load_model(e["path"], e["kind"]) for n, e in self.entries.items() if not names or n in names}


class ModelRegistry:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.manifest = Manifest(spark, path)

    def latest(self) -> Version:
        return self.version(None)

    def version(self, number: int | None) -> Version:
        number, c = self.manifest.read(number)
        return Version(number, c.get("epoch"), c.get("published", 0.0), c.get("models", {}), c.get("notes", {}))

    def publish(self, models: dict, epoch: int | None = None, notes: dict | None = None) -> Version:
        """Save ``models`` and make them the next version; with an ``epoch`` that
        the last version has reached already, nothing happens. Raises
        ``Conflict`` if another job published meanwhile."""
        last = self.latest()
        if epoch is not None and last.epoch is not None and epoch <= last.epoch:
            return last
        folder, entries = f"{self.path}/models-{uuid.uuid4().hex}", {}
        for name, model in models.items():
            M.save_model(model, f"{folder}/{name}")
            kind = "tree" if isinstance(model, M.TreeModel) else "knn" if isinstance(model, M.KnnModel) else "pipeline"
            entries[name] = {"kind": kind, "path": f"{folder}/{name}"}
        content = {"models": entries, "epoch": last.epoch if epoch is None else epoch, "published": time.time(), "notes": notes or {}}
        self.manifest.commit(last.number + 1, content)
        return self.latest()
