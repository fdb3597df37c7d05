"""Files and folders on storage that the whole cluster shares, by Hadoop's file system API."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Storage:
    """File operations of one session; paths are qualified URIs or paths of the default file system."""

    def __init__(self, spark: SparkSession) -> None:
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._hadoop.Path(path)
        return p, p.getFileSystem(self._conf)

    def qualified(self, path: str) -> str:
        p, fs = self._at(path)
        return fs.makeQualified(p).toString()

    def exists(self, path: str) -> bool:
        p, fs = self._at(path)
        return fs.exists(p)

    def children(self, path: str) -> list[str]:
        """Names in a folder, sorted; none if it does not exist."""
        p, fs = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def delete(self, path: str) -> None:
        p, fs = self._at(path)
        fs.delete(p, True)

    def make_folder(self, path: str) -> None:
        p, fs = self._at(path)
        fs.mkdirs(p)

    def touch(self, path: str) -> None:
        p, fs = self._at(path)
        fs.create(p, True).close()

    def move(self, source: str, target: str) -> None:
        """Give a file or folder a new name, which nothing may have yet."""
        (p, fs), (q, _) = self._at(source), self._at(target)
        if not fs.rename(p, q):
            raise OSError(f"{source} could not be moved to {target}")
