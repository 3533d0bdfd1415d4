"""Small file-system calls through Hadoop's FileSystem API: listings, markers, existence."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


def literal(path: str) -> str:
    """``path`` with glob characters escaped, so that a reader takes it as one file's name."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


class Files:
    def __init__(self, spark: SparkSession, path: str):
        self._Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return bool(self._fs.exists(self._Path(path)))

    def listing(self, path: str) -> list[tuple[str, bool]]:
        """(name, is a folder) of what lies in ``path``; empty if it is not there."""
        if not self.exists(path):
            return []
        return [(st.getPath().getName(), bool(st.isDirectory())) for st in self._fs.listStatus(self._Path(path))]

    def create(self, path: str) -> None:
        """An empty marker file; raises if it is there already, so of two writers one wins."""
        self._fs.create(self._Path(path), False).close()

    def delete(self, path: str) -> None:
        """Remove a folder of this job's own making, with what is in it."""
        self._fs.delete(self._Path(path), True)

    def sizes(self, paths: list[str]) -> list[int]:
        """Bytes of each file; asked for in parallel, as a drop folder may hold many."""
        with ThreadPoolExecutor(max_workers=min(32, len(paths))) as pool:
            return list(pool.map(lambda p: int(self._fs.getFileStatus(self._Path(p)).getLen()), paths))
