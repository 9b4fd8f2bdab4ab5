"""Change data: apply, merge, compare, history, and table layout.

Parquet has no merge, so these functions return the new state of a table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise
from .blocks import adjacent_rows, epoch_micros

SEQ, DELETED = "_seq", "_deleted"
START, END = "__START_AT", "__END_AT"


def apply_changes_scd1(
    state: DataFrame | None, changes: DataFrame, keys: Sequence[str], sequence_by: str,
    delete_when: str | None = None, except_columns: Sequence[str] = (), tie: str | None = None,
    ignore_null_updates: bool = False,
) -> DataFrame:
    """Newest change per key wins, also against the stored sequence.

    The returned state keeps ``_seq`` and, for deleted keys, a tombstone
    (``_deleted``), so a late older update cannot revive a row. ``live_rows``
    gives the table itself. State and changes are stacked and reduced by one
    aggregate with map-side combine: a key with most of the changes costs each
    task one row.
    """
    deleted = F.coalesce(F.expr(delete_when), F.lit(False)) if delete_when else F.lit(False)
    hidden = {*keys, sequence_by, *except_columns}
    values = [c for c in changes.columns if c not in hidden]
    stacked = changes.select(
        *keys, *values, F.col(sequence_by).alias(SEQ), deleted.alias(DELETED),
        (F.col(tie).cast("long") if tie else F.lit(0).cast("long")).alias("_tie"),
    )
    if state is not None:
        # a stored row loses against a change with the same sequence: replays agree
        stacked = state.withColumn("_tie", F.lit(-1).cast("long")).unionByName(stacked, allowMissingColumns=True)
        values += [c for c in state.columns if c not in values and c not in (*keys, SEQ, DELETED)]
    rank = F.struct(SEQ, "_tie")
    if not ignore_null_updates:
        newest = F.max_by(F.struct(*values, SEQ, DELETED), rank).alias("_row")
        return stacked.groupBy(*keys).agg(newest).select(*keys, "_row.*")
    # newest non-null value per column, but nothing from before the last delete
    gone = stacked.filter(DELETED).groupBy(*keys).agg(F.max(rank).alias("_gone"))
    fresh = stacked.join(gone, list(keys), "left").filter(F.col("_gone").isNull() | (rank >= F.col("_gone")))
    aggs = [
        F.max_by(c, F.when(F.col(c).isNotNull() & ~F.col(DELETED), rank)).alias(c) for c in values
    ]
    return fresh.groupBy(*keys).agg(*aggs, F.max(SEQ).alias(SEQ), F.max_by(DELETED, rank).alias(DELETED))


def live_rows(state: DataFrame) -> DataFrame:
    return state.filter(~F.col(DELETED)).drop(SEQ, DELETED)


def apply_changes_scd2(
    changes: DataFrame, keys: Sequence[str], sequence_by: str, along: Column,
    delete_when: str | None = None, except_columns: Sequence[str] = (), tie: str | None = None,
) -> DataFrame:
    """History rows with ``__START_AT`` / ``__END_AT`` from a change log.

    A row closes when the next different row starts or the key is deleted;
    repeats of the same values are merged. Of several changes with one
    sequence the largest ``tie`` counts. ``along`` is ``sequence_by`` as a
    number (``blocks.epoch_micros`` for times), by which hot keys are cut.
    """
    deleted = F.coalesce(F.expr(delete_when), F.lit(False)) if delete_when else F.lit(False)
    hidden = {*keys, sequence_by, *except_columns}
    values = [c for c in changes.columns if c not in hidden]
    rows = changes.select(
        *keys, sequence_by, F.struct(*values).alias("_row"), deleted.alias("_gone"),
        (F.col(tie) if tie else F.lit(0)).alias("_tie"),
    )
    rows = rows.groupBy(*keys, sequence_by).agg(
        F.max_by("_row", "_tie").alias("_row"), F.max_by("_gone", "_tie").alias("_gone")
    )
    # each scan reads its input twice (summary and rows), so cut the lineage before it
    rows = adjacent_rows(materialise(rows, "changes"), keys, [sequence_by], along, {
        "_prev": F.struct(F.col("_row").alias("r"), F.col("_gone").alias("g"))})
    first = F.col("_prev").isNull()
    same = ~first & (
        (F.col("_gone") & F.col("_prev.g"))
        | (~F.col("_gone") & ~F.col("_prev.g") & F.col("_row").eqNullSafe(F.col("_prev.r")))
    )
    kept = materialise(rows.filter(~same).drop("_prev"), "changes")
    kept = adjacent_rows(kept, keys, [sequence_by], along, following={END: F.col(sequence_by)})
    return kept.filter(~F.col("_gone")).select(*keys, "_row.*", F.col(sequence_by).alias(START), END)


def update_scd2(
    history: DataFrame, log: DataFrame, new_changes: DataFrame, keys: Sequence[str], sequence_by: str,
    along: Column, **options,
) -> DataFrame:
    """History after new (also late) changes: only the touched keys are recomputed.

    They are rebuilt from the change log, which already holds the new rows: a
    late row may split a span that was merged before, and only the log knows.
    """
    touched = new_changes.select(*keys).distinct()
    again = apply_changes_scd2(log.join(touched, list(keys), "left_semi"), keys, sequence_by, along, **options)
    return history.join(touched, list(keys), "left_anti").unionByName(again)


def as_of(history: DataFrame, when: Column | str) -> DataFrame:
    """State of a history table at a past time."""
    at = F.lit(when).cast(history.schema[START].dataType) if isinstance(when, str) else when
    open_end = F.col(END).isNull() | (at < F.col(END))
    return history.filter((F.col(START) <= at) & open_end).drop(START, END)


def merge_upsert(
    target: DataFrame, source: DataFrame, on: Sequence[str], matched: Mapping[str, str] | str | None = "all",
    not_matched: Mapping[str, str] | str | None = "all", delete_when: str | None = None,
) -> DataFrame:
    """Update, insert and delete by key; returns the new table.

    ``matched`` / ``not_matched``: "all", None, or column -> SQL expression over
    ``t.`` (target struct) and ``s.`` (source struct). Source columns the
    target lacks are added. Fails when the source repeats a key.
    """
    rest_s = [c for c in source.columns if c not in on]
    rest_t = [c for c in target.columns if c not in on]
    columns = rest_t + [c for c in rest_s if c not in rest_t]
    types = {f.name: f.dataType for f in source.schema} | {f.name: f.dataType for f in target.schema}
    once = source.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*source.columns)).alias("s"))
    once = once.withColumn(
        "s", F.when(F.col("_n") > 1, F.raise_error(F.lit("merge source repeats a key"))).otherwise(F.col("s"))
    ).drop("_n")
    left = target.select(*on, F.struct(*target.columns).alias("t"))
    both = left.join(once, list(on), "outer")
    hit = F.col("t").isNotNull() & F.col("s").isNotNull()
    new = F.col("t").isNull()
    if delete_when:
        # a delete of a key the target never had is not an insert either
        both = both.filter(F.col("s").isNull() | ~F.coalesce(F.expr(delete_when), F.lit(False)))
    if not_matched is None:
        both = both.filter(~new)

    def old(c: str) -> Column:
        return F.col("t").getField(c) if c in rest_t else F.lit(None).cast(types[c])

    def value(c: str, rule) -> Column:
        if rule == "all":
            return F.col("s").getField(c) if c in rest_s else old(c)
        if rule and c in rule:
            return F.expr(rule[c]).cast(types[c])
        return old(c)

    out = [F.when(hit, value(c, matched)).when(new, value(c, not_matched)).otherwise(old(c)).alias(c) for c in columns]
    return both.select(*on, *out)


def update_where(df: DataFrame, where: str, values: Mapping[str, str]) -> DataFrame:
    """``UPDATE ... SET ... WHERE``: rows where the predicate is null stay."""
    hit = F.coalesce(F.expr(where), F.lit(False))
    fresh = {c: F.when(hit, F.expr(e).cast(df.schema[c].dataType)).otherwise(F.col(c)) for c, e in values.items()}
    return df.select(*[fresh[c].alias(c) if c in fresh else F.col(c) for c in df.columns])


def delete_where(df: DataFrame, where: str) -> DataFrame:
    """``DELETE ... WHERE``: rows where the predicate is null stay."""
    return df.filter(~F.coalesce(F.expr(where), F.lit(False)))


def change_feed(before: DataFrame, after: DataFrame, keys: Sequence[str], version: int | None = None) -> DataFrame:
    """Rows with ``_change_type`` insert, update_preimage, update_postimage or delete.

    Keys must be unique on both sides; rows compare null-safe.
    """
    columns = after.columns
    a = before.select(*keys, F.struct(*columns).alias("_old"))
    b = after.select(*keys, F.struct(*columns).alias("_new"))
    both = a.join(b, list(keys), "outer").filter(~F.col("_old").eqNullSafe(F.col("_new")))

    def change(kind: str, row: str) -> Column:
        return F.struct(F.col(row).alias("r"), F.lit(kind).alias("kind"))

    events = (
        F.when(F.col("_old").isNull(), F.array(change("insert", "_new")))
        .when(F.col("_new").isNull(), F.array(change("delete", "_old")))
        .otherwise(F.array(change("update_preimage", "_old"), change("update_postimage", "_new")))
    )
    out = both.select(F.explode(events).alias("_c")).select("_c.r.*", F.col("_c.kind").alias("_change_type"))
    return out if version is None else out.withColumn("_commit_version", F.lit(version).cast("long"))


def consume_feed(
    feed: DataFrame, target: DataFrame, keys: Sequence[str], clean: Mapping[str, tuple[str, str]] | None = None,
    order: str = "_commit_version",
) -> DataFrame:
    """Merge the newest non-preimage change per key into a table downstream.

    ``clean``: column -> (pattern, replacement) applied on the way.
    """
    news = feed.filter("_change_type <> 'update_preimage'")
    rest = [c for c in news.columns if c not in keys]
    last = news.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row")).select(*keys, "_row.*")
    for column, (pattern, replacement) in (clean or {}).items():
        last = last.withColumn(column, F.regexp_replace(column, pattern, replacement))
    names = [c for c in last.columns if c not in ("_change_type", order)]
    source = last.select(*names, "_change_type")
    values = {c: f"s.{c}" for c in names if c not in keys}
    return merge_upsert(target, source, keys, values, values, "s._change_type = 'delete'").drop("_change_type")


def compact(spark, path: str, out: str, target_mb: int = 256) -> int:
    """Rewrite many small files as few of about ``target_mb``; returns the count asked for.

    Sizes come from file metadata (the content column is never read).
    """
    size = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet").load(path).agg(F.sum("length").alias("b")).first().b or 0
    )
    files = max(1, -(-size // (target_mb * 1024 * 1024)))
    spark.read.parquet(path).repartition(files).write.parquet(out)
    return files


def cluster_table(df: DataFrame, columns: Sequence[str], partitions: int, bits: int = 8) -> DataFrame:
    """Rows ordered so that files cover small ranges of every column.

    One column: a range sort. Several: each value becomes one of ``2**bits``
    buckets with about equally many rows (bounds sampled by
    ``percentile_approx``, for text by range pieces of that column, so at most
    ``2**bits`` values reach the driver), and the bits of the buckets are
    interleaved to one sort key. Nulls are in the first bucket.
    """
    if len(columns) == 1:
        return df.repartitionByRange(partitions, *columns).sortWithinPartitions(*columns)
    numbers = {c: _as_number(df, c) for c in columns if not isinstance(df.schema[c].dataType, T.StringType)}
    steps = [i / 2**bits for i in range(1, 2**bits)]
    bounds = df.agg(*[F.percentile_approx(n, steps, 10_000).alias(c) for c, n in numbers.items()]).first() if numbers else {}
    out = df
    z = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        if c in numbers:
            splits = [float("-inf"), *sorted({float(b) for b in bounds[c] or []}), float("inf")]
            out = out.withColumn(f"_n{i}", F.coalesce(numbers[c].cast("double"), F.lit(float("-inf"))))
            out = Bucketizer(splits=splits, inputCol=f"_n{i}", outputCol=f"_b{i}", handleInvalid="keep").transform(out)
        else:
            out = out.withColumn(f"_b{i}", F.when(F.col(c).isNull(), F.lit(0)).otherwise(_bucket(F.col(c), _text_bounds(df, c, 2**bits))))
        bucket = F.col(f"_b{i}").cast("long")
        for bit in range(bits):
            one = F.shiftright(bucket, bit).bitwiseAND(F.lit(1).cast("long"))
            z = z.bitwiseOR(F.shiftleft(one, bit * len(columns) + i))
    out = out.withColumn("_z", z)
    return out.repartitionByRange(partitions, "_z").sortWithinPartitions("_z").select(*df.columns)


def _as_number(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return epoch_micros(column).cast("double")
    return F.col(column).cast("double")


def _text_bounds(df: DataFrame, column: str, pieces: int) -> list[str]:
    """The largest whole value of each range piece but the last, in order."""
    ranged = df.select(column).filter(F.col(column).isNotNull()).repartitionByRange(pieces, column)
    tops = ranged.groupBy(F.spark_partition_id().alias("piece")).agg(F.max(column).alias("top")).collect()
    return sorted({r.top for r in tops}, key=lambda t: t.encode())[:-1]


def _bucket(value: Column, bounds: list[str], first: int = 0) -> Column:
    """How many bounds lie below the value, as a balanced tree of comparisons."""
    if not bounds:
        return F.lit(first)
    middle = len(bounds) // 2
    return F.when(value <= F.lit(bounds[middle]), _bucket(value, bounds[:middle], first)).otherwise(
        _bucket(value, bounds[middle + 1:], first + middle + 1))
