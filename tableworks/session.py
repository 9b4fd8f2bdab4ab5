"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job here relies on: all can be set on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split hot join partitions even where that costs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # merge sessions on the map side before the shuffle by key
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_fallback: str | None = None


@contextmanager
def stream_width(spark: SparkSession, partitions: int | None = None):
    """Shuffle width for a stream that starts inside this block.

    A stateful stream keeps the width of its first run, and it cannot be adapted
    at run time, so it is sized to the cores of the cluster unless given.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(partitions or spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def build_session(app: str = "tableworks", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` keys use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in RUNTIME_CONF.items():
        builder = builder.config(name, value)
    for name, value in conf.items():
        builder = builder.config(name.replace("_", "."), value)
    return builder.getOrCreate()


def prepare_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach.

    Taken from ``spark.checkpoint.dir``. Only where that is unset in a local
    session (tests on one machine) a temporary folder is made; on a cluster
    each executor would write to a disk of its own, so that is an error.
    """
    global _fallback
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if _fallback is None:
        _fallback = tempfile.mkdtemp(prefix="tableworks-")
    return _fallback


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; never reused between runs."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str = "step") -> DataFrame:
    """Cut lineage by writing Parquet to the shared folder and reading it back.

    Used where two passes must see the very same rows (a numbering pass after a
    counting pass): a lost executor then re-reads files instead of recomputing
    a plan that might partition differently.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
