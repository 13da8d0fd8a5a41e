"""Atomic versions: a folder of small numbered records, the last of which is current.

A record names the files of a version and is published after they are written, by one
rename that fails if the number is taken.  A run that dies before leaves the version
before it as it was; of two that end at once, one is told.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class VersionTaken(RuntimeError):
    """Another job published the version first."""


class VersionLog:
    def __init__(self, spark: SparkSession, folder: str):
        self.jvm = spark._jvm
        self.folder = self.jvm.org.apache.hadoop.fs.Path(folder)
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self.folder.getFileSystem(self.conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.folder, name)

    def number(self) -> int:
        """The current version, 0 if there is none."""
        if not self.fs.exists(self.folder):
            return 0
        names = [s.getPath().getName() for s in self.fs.listStatus(self.folder)]
        return max((int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit()), default=0)

    def read(self, number: int | None = None) -> dict:
        """The record of a version, by default the current one; {} if there is none."""
        number = self.number() if number is None else number
        if not number:
            return {}
        stream = self.fs.open(self._path(f"{number:09d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def publish(self, number: int, record: dict) -> int:
        """Make ``record`` version ``number``; VersionTaken if there is one already."""
        draft, final = self._path(f"_{uuid.uuid4().hex}"), self._path(f"{number:09d}.json")
        stream = self.fs.create(draft, False)
        stream.write(json.dumps(record).encode())
        stream.close()
        files = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self.conf)
        none = self.jvm.java.lang.reflect.Array.newInstance(
            self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0
        )
        try:
            files.rename(self.fs.makeQualified(draft), self.fs.makeQualified(final), none)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" not in str(e.java_exception):
                raise
            self.fs.delete(draft, False)
            raise VersionTaken(f"version {number} of {self.folder} is taken") from e
        return number
