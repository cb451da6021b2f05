"""The Hadoop file system behind a path: the same calls on HDFS, object stores and local disks."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    """Existence, listing and removal below one path."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        jvm = spark._jvm
        self._path_class = jvm.org.apache.hadoop.fs.Path
        self.path = str(path)
        root = self._path_class(self.path)
        self._fs = root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path_class(f"{self.path}/{name}") if name else self._path_class(self.path)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def names(self) -> list[str]:
        if not self.exists():
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at("")))

    def files(self) -> dict[str, str]:
        """The data files right below the path: name -> length and time of the last change."""
        if not self.exists():
            return {}
        found = [s for s in self._fs.listStatus(self._at("")) if s.isFile()]
        named = [(s.getPath().getName(), f"{s.getLen()}-{s.getModificationTime()}") for s in found]
        return {name: stamp for name, stamp in named if name[0] not in "._"}

    def remove(self, name: str) -> bool:
        return self._fs.delete(self._at(name), True)
