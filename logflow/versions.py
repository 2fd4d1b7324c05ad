"""Small states of a store, one file per version: what readers and writers agree on."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class VersionConflict(RuntimeError):
    """Another writer published the next version first."""


class Versions:
    """JSON states under ``path``; a version is written once and a newer one replaces it for readers.

    Publishing is a compare-and-set: a file is written aside and renamed to the next version's name, which fails if
    that name is taken.  So of two writers that saw the same version one wins, the other gets VersionConflict, and a
    writer that dies in between leaves the old version in force.  The file system must rename atomically.
    """

    def __init__(self, spark: SparkSession, path: str, keep: int = 100) -> None:
        sc = spark.sparkContext
        self._jvm, self._keep = sc._jvm, keep
        self._path = sc._jvm.org.apache.hadoop.fs.Path(path)
        conf = sc._jsc.hadoopConfiguration()
        self._fs = self._path.getFileSystem(conf)
        self._files = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)
        self._no_options = sc._gateway.new_array(sc._jvm.org.apache.hadoop.fs.Options.Rename, 0)

    def _file(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._path, name)

    @staticmethod
    def _name(version: int) -> str:
        return f"v{version:020d}"

    def _numbers(self) -> list[int]:
        if not self._fs.exists(self._path):
            return []
        names = [status.getPath().getName() for status in self._fs.listStatus(self._path)]
        return sorted(int(name[1:]) for name in names if name.startswith("v"))

    def latest(self) -> tuple[int, dict]:
        """The newest version and its state; 0 and an empty one before the first."""
        numbers = self._numbers()
        if not numbers:
            return 0, {}
        stream = self._fs.open(self._file(self._name(numbers[-1])))
        try:
            return numbers[-1], json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def publish(self, after: int, state: dict) -> int:
        """Make ``state`` the version after ``after``, the one that it was derived from."""
        aside = self._file(f"_{uuid.uuid4().hex}")
        stream = self._fs.create(aside, True)
        try:
            stream.write(json.dumps(state).encode())
        finally:
            stream.close()
        try:
            self._files.rename(aside, self._file(self._name(after + 1)), self._no_options)
        except Exception as error:
            self._fs.delete(aside, False)
            if "FileAlreadyExists" in str(error):
                raise VersionConflict(f"{self._path} has a version after {after}") from error
            raise
        for old in [n for n in self._numbers() if n <= after + 1 - self._keep]:
            self._fs.delete(self._file(self._name(old)), False)
        return after + 1
