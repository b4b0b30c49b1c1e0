"""Small JSON files beside the lake: manifests, records and leases, in any store that Spark reads.

They hold what a run has to know of an earlier one whatever session or catalog it has. Files
are reached through Hadoop's file systems, as tables are.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import SparkSession


class Store:
    """The JSON files directly below a folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._jvm = spark._jvm
        folder = self._path("")
        self._fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str = "") -> list[str]:
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(path))

    def read(self, name: str) -> dict | None:
        """The content of a file; None if there is none, or if it is only begun."""
        path = self._path(name)
        if not self._fs.exists(path):
            return None
        stream = self._fs.open(path)
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            return None

    def modified(self, name: str) -> float:
        """When a file was last written, in seconds."""
        return self._fs.getFileStatus(self._path(name)).getModificationTime() / 1000

    def _fill(self, stream, value: dict) -> None:
        try:
            stream.write(bytearray(json.dumps(value).encode()))
        finally:
            stream.close()

    def create(self, name: str, value: dict) -> bool:
        """Make a file that does not exist yet; False if it does.

        Exclusive where the store's ``create`` is (HDFS, local files, S3A with conditional writes).
        """
        try:
            stream = self._fs.create(self._path(name), False)
        except Exception:  # noqa: BLE001 - the store's own class of error
            if self._fs.exists(self._path(name)):
                return False
            raise
        self._fill(stream, value)
        return True

    def replace(self, name: str, value: dict) -> None:
        """Write over a file that only its owner writes."""
        self._fill(self._fs.create(self._path(name), True), value)

    def put(self, kind: str, value: dict) -> None:
        """Store the newest value of a kind, whole or not at all; then remove older ones."""
        name = f"{kind}-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}.json"
        begun = self._path(f"_{name}")
        self._fill(self._fs.create(begun, True), value)
        if not self._fs.rename(begun, self._path(name)):
            raise OSError(f"{self.root}/{name} could not be written")
        for old in self._of(kind):
            if old < name:
                self.remove(old)

    def latest(self, kind: str) -> dict | None:
        for name in reversed(self._of(kind)):
            value = self.read(name)
            if value is not None:
                return value
        return None

    def _of(self, kind: str) -> list[str]:
        return [n for n in self.names() if n.startswith(f"{kind}-") and n.endswith(".json")]

    def remove(self, name: str) -> None:
        """Remove a file, or a folder with all it holds."""
        self._fs.delete(self._path(name), True)
