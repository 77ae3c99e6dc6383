"""Versioned manifests: small JSON files in a shared folder, one for each
version, committed by one atomic rename that fails if the version is there.

Data of a version is written first, into folders of its own; only then does its
manifest name them. A job that dies in between leaves folders that no manifest
names, and readers see whole versions only.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Conflict(Exception):
    """Another writer has committed this version."""


class Manifest:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._fs = jvm.org.apache.hadoop.fs
        self._folder = self._fs.Path(f"{self.path}/_manifest")
        self._conf = spark._jsc.hadoopConfiguration()

    def _context(self):
        system = self._folder.getFileSystem(self._conf)
        return self._fs.FileContext.getFileContext(system.getUri(), self._conf)

    def versions(self) -> list[int]:
        """Committed versions, ascending."""
        system = self._folder.getFileSystem(self._conf)
        if not system.exists(self._folder):
            return []
        names = [s.getPath().getName() for s in system.listStatus(self._folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self, version: int | None = None) -> tuple[int, dict]:
        """(version, content) of a version (the last by default; (0, {}) if none)."""
        if version is None:
            known = self.versions()
            if not known:
                return 0, {}
            version = known[-1]
        stream = self._folder.getFileSystem(self._conf).open(self._fs.Path(self._folder, f"{version}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return version, json.loads(text)

    def commit(self, version: int, content: dict) -> None:
        """Make ``content`` the manifest of ``version``; ``Conflict`` if there is one."""
        system = self._folder.getFileSystem(self._conf)
        system.mkdirs(self._folder)
        draft = self._fs.Path(self._folder, f".{uuid.uuid4().hex}.draft")
        out = system.create(draft, True)
        try:
            out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        finally:
            out.close()
        no_overwrite = self.spark.sparkContext._gateway.new_array(self._fs.Options.Rename, 1)
        no_overwrite[0] = self._fs.Options.Rename.NONE
        try:
            self._context().rename(draft, self._fs.Path(self._folder, f"{version}.json"), no_overwrite)
        except Exception as e:
            system.delete(draft, False)
            if "FileAlreadyExists" in str(e):
                raise Conflict(f"{self.path}: version {version} is committed already") from e
            raise
