"""Intermediate tables in the shared folder, removed when an operator is done with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


class Scratch:
    """Cuts lineage with written Parquet tables and files.

    ``write`` stores a frame and reads it back, ``path`` hands out a folder for
    other files. ``close`` removes everything but the frames to be kept, so an
    operator leaves behind no more than its result. A lost executor re-reads
    these tables; nothing is held in executor memory only.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: dict[str, DataFrame | None] = {}

    def path(self, label: str) -> str:
        path = scratch_path(self.spark, label)
        self._paths[path] = None
        return path

    def write(self, df: DataFrame, label: str = "step") -> DataFrame:
        path = self.path(label)
        df.write.parquet(path)
        self._paths[path] = stored = self.spark.read.schema(df.schema).parquet(path)
        return stored

    def drop(self, *frames: DataFrame) -> None:
        for path in [p for p, df in self._paths.items() if any(df is f for f in frames)]:
            self._delete(path)

    def close(self, *keep: DataFrame) -> None:
        for path in [p for p, df in self._paths.items() if not any(df is f for f in keep)]:
            self._delete(path)

    def _delete(self, path: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
        del self._paths[path]


def finish(scratch: Scratch, df: DataFrame, label: str = "result") -> DataFrame:
    """Store an operator's result and remove its intermediate tables."""
    out = scratch.write(df, label)
    scratch.close(out)
    return out
