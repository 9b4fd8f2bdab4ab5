"""The query catalogue: every operator as a named query over the test tables.

Each query reads its tables whole. Where a query needs changes, repeats, nulls,
late rows or a second load that the tables do not have, it derives them from
the keys (``o_orderkey % 17 = 0`` is a delete, say); no row is left out to make
a check cheaper.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import prepare_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class Tables:
    """Lazy access to the Parquet tables of one folder: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, dates: tuple[str, ...] = ()):
    """Register ``fn(t: Tables) -> DataFrame`` under a name, with its SQL twin.

    Columns in ``dates`` are shown as timestamps on both sides, because the two
    engines hand dates to pandas differently.
    """

    def keep(fn: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            df = fn(Tables(prepare_session(spark), folder))
            return df.withColumns({c: df[c].cast("timestamp_ntz") for c in dates}) if dates else df

        run.__name__ = name
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        if sql is not None:
            shown = ", ".join(f"CAST({c} AS TIMESTAMP) AS {c}" for c in dates)
            _ORACLES[name] = f"SELECT * REPLACE ({shown}) FROM ({sql})" if dates else sql
        return fn

    return keep
