"""All-or-nothing replacement of a written warehouse.

Every rebuild writes a folder of its own below ``<out>/versions``. One small file,
``<out>/CURRENT``, names the folder that readers follow; it is replaced by a rename, so a
reader sees the old set or the new one, and a rebuild that fails changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

POINTER = "CURRENT"


class Versions:
    """The versions below one output folder."""

    def __init__(self, spark: SparkSession, out: str):
        self.out = out.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._jvm = spark._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()
        self._files = self._path(self.out).getFileSystem(self._conf)

    def _path(self, where: str):
        return self._hadoop.Path(where)

    def current(self) -> str:
        """The folder that readers follow."""
        pointer = self._path(f"{self.out}/{POINTER}")
        if not self._files.exists(pointer):
            raise FileNotFoundError(f"no finished warehouse in {self.out}")
        stream = self._files.open(pointer)
        try:
            name = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return f"{self.out}/versions/{name}"

    @contextmanager
    def new(self) -> Iterator[str]:
        """A fresh folder, which becomes the current one if the body ends well and is
        deleted if it does not."""
        name = uuid.uuid4().hex
        folder = f"{self.out}/versions/{name}"
        try:
            yield folder
            self._switch(name)
        except BaseException:
            self._files.delete(self._path(folder), True)
            raise

    def _switch(self, name: str) -> None:
        waiting = self._path(f"{self.out}/{POINTER}.{name}")
        stream = self._files.create(waiting, True)
        stream.write(bytearray(name.encode()))
        stream.close()
        overwrite = self._gateway.new_array(
            getattr(self._jvm, "org.apache.hadoop.fs.Options$Rename"), 1
        )
        overwrite[0] = getattr(self._jvm, "org.apache.hadoop.fs.Options$Rename").OVERWRITE
        where = self._files.makeQualified(waiting).toUri()
        context = self._hadoop.FileContext.getFileContext(where, self._conf)
        context.rename(waiting, self._path(f"{self.out}/{POINTER}"), overwrite)

    def names(self) -> list[str]:
        """Versions on disk, the oldest first."""
        folder = self._path(f"{self.out}/versions")
        if not self._files.exists(folder):
            return []
        found = sorted((f.getModificationTime(), f.getPath().getName()) for f in self._files.listStatus(folder))
        return [name for _, name in found]

    def prune(self, keep: int = 2) -> None:
        """Delete all but the ``keep`` latest versions; the current one always stays, and
        one before it gives its readers time to finish."""
        current = self.current().rpartition("/")[2]
        older = [n for n in self.names() if n != current]
        for name in older[: max(0, len(older) - (keep - 1))]:
            self._files.delete(self._path(f"{self.out}/versions/{name}"), True)
