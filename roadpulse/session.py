"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Set the SQL options the plans rely on."""
    # telemetry is UTC
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    # A master too large to broadcast is joined by shuffles. Split a hot id there
    # even where the result could have served the next step unshuffled.
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


@cache
def _local_folder() -> tempfile.TemporaryDirectory:
    """Stand-in for the shared folder in local mode; removed at exit."""
    return tempfile.TemporaryDirectory(prefix="roadpulse-")


class Workspace:
    """Writes intermediate tables below ``spark.checkpoint.dir``.

    A written table cuts the lineage (a lost executor does not recompute the
    stages before it) and pins results of partition-dependent steps such as a
    range shuffle, whose sampled bounds could differ in a second evaluation.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._root: str | None = None

    @property
    def root(self) -> str:
        if self._root is None:
            shared = self.spark.conf.get("spark.checkpoint.dir", None)
            if not shared:
                if not self.spark.sparkContext.master.startswith("local"):
                    raise RuntimeError(
                        "set spark.checkpoint.dir to a folder that all executors share"
                    )
                shared = _local_folder().name
            self._root = f"{shared.rstrip('/')}/roadpulse-{uuid.uuid4().hex}"
            folder, files = self._folder()
            files.deleteOnExit(folder)
        return self._root

    def _folder(self):
        """The root as a Hadoop path and its file system."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._root)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as a table of its own and return the scan of it. What is not
        cleared before goes when the application ends."""
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        """Delete the tables written so far; frames that read them end here."""
        if self._root is not None:
            folder, files = self._folder()
            files.delete(folder, True)
            self._root = None
