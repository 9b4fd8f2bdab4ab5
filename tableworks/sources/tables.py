"""Parquet tables: plain writes, logs of row versions that micro-batches append to, and copies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import latest_per_key


def write_table(df: DataFrame, path: str, mode: str = "append", partition_by: Sequence[str] = (),
                merge_schema: bool = False, replace_partitions: bool = False) -> None:
    """append, overwrite or (``replace_partitions``) overwrite of only the partitions in ``df``.

    ``merge_schema`` lets the new rows add columns; readers use ``read_table``.
    """
    spark = df.sparkSession
    if not merge_schema and mode == "append" and exists(spark, path):
        known = spark.read.parquet(path).columns
        extra = [c for c in df.columns if c not in known]
        if extra:
            raise ValueError(f"columns not in the table: {extra}")
    writer = df.write.mode("overwrite" if replace_partitions else mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if replace_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def read_table(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


# A log table holds every version of its rows; ``write_no`` says which write a row came with.
# The current table is an aggregate over it, so nothing is rewritten when a key changes.

BATCH = "write_no"


def append_batch(df: DataFrame, batch_id: int, path: str) -> None:
    """Add rows to a log table under the number of their write.

    The number is a partition column and only that partition is overwritten: a
    micro-batch that is run again replaces itself. Columns may be added later.
    """
    if BATCH in df.columns:
        raise ValueError(f"{BATCH} is the column of the write's number")
    df.withColumn(BATCH, F.lit(batch_id).cast("long")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path)


def latest_rows(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The current rows of a log table: per key the row with the largest ``order``, of equals the one written last.

    One aggregate with map-side combine over the log, so a key with most of the
    versions costs each task one row.
    """
    return latest_per_key(read_log(spark, path), keys, [*order, BATCH]).drop(BATCH)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    log = read_table(spark, path, merge_schema=True)
    return log.withColumn(BATCH, F.col(BATCH).cast("long"))


def copy_tables(spark: SparkSession, source: str, target: str, incremental_by: dict[str, str] | None = None) -> list[str]:
    """Copy all tables of one database to another, then create its views there.

    With ``incremental_by`` (table -> column) only rows that are not there yet
    are appended, of those that reach the target's largest value or have none.
    Returns the names in the order they were made.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {target}")
    entries = [r for r in spark.sql(f"SHOW TABLES IN {source}").collect() if not r.isTemporary]
    views = {r.viewName for r in spark.sql(f"SHOW VIEWS IN {source}").collect() if not r.isTemporary}
    done = []
    for entry in entries:
        name = entry.tableName
        if name in views:
            continue
        df = spark.table(f"{source}.{name}")
        column = (incremental_by or {}).get(name)
        if column and spark.catalog.tableExists(f"{target}.{name}"):
            top = spark.table(f"{target}.{name}").agg(F.max(column)).first()[0]
            late = F.lit(True) if top is None else F.col(column).isNull() | (F.col(column) >= F.lit(top))
            fresh = df.filter(late).exceptAll(spark.table(f"{target}.{name}").filter(late).select(*df.columns))
            fresh.write.mode("append").saveAsTable(f"{target}.{name}")
        else:
            df.write.mode("overwrite").format("parquet").saveAsTable(f"{target}.{name}")
        done.append(name)
    pending = sorted(views)
    while pending:
        # a view on a view that is not there yet waits for the next turn
        waiting, reason = [], None
        for name in pending:
            text = spark.sql(f"SHOW CREATE TABLE {source}.{name}").first()[0]
            body = text[text.upper().index("\nAS ") + 4:] if "\nAS " in text.upper() else text[text.upper().index(" AS ") + 4:]
            try:
                spark.sql(f"CREATE OR REPLACE VIEW {target}.{name} AS {body.replace(source + '.', target + '.')}")
                done.append(name)
            except AnalysisException as e:
                waiting.append(name)
                reason = e
        if len(waiting) == len(pending):
            raise reason
        pending = waiting
    return done
