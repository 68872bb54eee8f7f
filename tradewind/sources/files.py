"""Files beside the data, on whatever file system a path names. Only the driver calls this."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession


class Folder:
    """A folder that the driver lists, moves and removes; rows never pass through it."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._fs = self._at().getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def has(self, name: str = "") -> bool:
        return bool(self._fs.exists(self._at(name)))

    def names(self) -> list[str]:
        """What lies in the folder, sorted; nothing if it does not exist."""
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at())) if self.has() else []

    def take(self, source: Folder, name: str) -> None:
        """Move ``name`` here from ``source``, in place of what has this name."""
        self._fs.mkdirs(self._at())
        if self.has(name):
            self._fs.delete(self._at(name), True)
        if not self._fs.rename(source._at(name), self._at(name)):
            raise OSError(f"cannot move {source.path}/{name} to {self.path}")

    def remove(self, name: str = "") -> None:
        self._fs.delete(self._at(name), True)

    def write(self, name: str, text: str) -> None:
        """A small text, written in full before it gets its name."""
        self._fs.mkdirs(self._at())
        out = self._fs.create(self._at(f".{name}.new"), True)
        out.write(bytearray(text.encode()))
        out.close()
        if self.has(name):
            self._fs.delete(self._at(name), False)
        self._fs.rename(self._at(f".{name}.new"), self._at(name))

    def read(self, name: str) -> str | None:
        if not self.has(name):
            return None
        stream = self._fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def run_token(spark: SparkSession, checkpoint: str) -> str:
    """A text that stays with a checkpoint and sorts after those of checkpoints begun earlier."""
    folder = Folder(spark, checkpoint)
    token = folder.read("run_token")
    if token is None:
        token = f"r{time.time_ns() // 1000:020d}"
        folder.write("run_token", token)
    return token
