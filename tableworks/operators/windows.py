"""Per-key ordering operators: latest row, neighbours, rolling totals, episodes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .blocks import (
    DAY,
    adjacent_rows,
    as_column,
    epoch_micros,
    number_rows,
    rolling_range,
    row_frame,
    running,
)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key (largest ``order`` tuple).

    An aggregate, not a window: every map task sends one row per key.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.col(c) for c in order])
    newest = F.max_by(F.struct(*[F.col(c) for c in rest]), rank).alias("_row")
    best = df.groupBy(*keys).agg(newest)
    return best.select(*keys, *[F.col("_row").getField(c).alias(c) for c in rest]).select(*df.columns)


def latest_with_ties(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """All rows that share the newest ``order`` value of their key (dense rank 1)."""
    top = df.groupBy(*[F.col(k).alias(f"_of_{k}") for k in keys]).agg(F.max(order).alias("_top"))
    same = F.col(order) == F.col("_top")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return df.join(top, same).select(*df.columns)


def gap_label(
    df: DataFrame,
    keys: Sequence[str],
    start: str,
    stop: str,
    tie: str,
    days: float,
    label: str = "is_repeat",
) -> DataFrame:
    """1 when a row starts less than ``days`` after the previous row of the key stopped."""
    near = adjacent_rows(df, keys, [start, tie], epoch_micros(start), {"_prev_stop": F.col(stop)})
    gap = epoch_micros(start) - epoch_micros("_prev_stop")
    within = gap < F.lit(int(days * DAY * 1_000_000))
    return near.withColumn(label, F.coalesce(within, F.lit(False)).cast("int")).drop("_prev_stop")


def neighbour_values(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    along: Column,
    values: Mapping[str, tuple[str, int]],
) -> DataFrame:
    """``lag`` for positive offsets, ``lead`` for negative ones, of (column, offset)."""
    if all(abs(n) == 1 for _, n in values.values()):
        back = {name: F.col(c) for name, (c, n) in values.items() if n == 1}
        ahead = {name: F.col(c) for name, (c, n) in values.items() if n == -1}
        return adjacent_rows(df, keys, order, along, back, ahead).select(*df.columns, *values)
    reach = max(abs(n) for _, n in values.values())
    return row_frame(
        df, keys, [F.col(c) for c in order], along, reach, reach,
        {name: lambda w, c=c, n=n: F.lag(c, n).over(w) for name, (c, n) in values.items()},
    )


def rolling_totals(
    df: DataFrame, keys: Sequence[str], ts: str, seconds: int,
    outputs: Mapping[str, tuple[str, str]], block_seconds: float | None = None,
) -> DataFrame:
    """Sum, count, mean, min, max over the last ``seconds`` by event time."""
    return rolling_range(df, keys, ts, seconds, outputs, block_seconds)


def rolling_days(
    daily: DataFrame, day: str, spans: Sequence[int], columns: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """Trailing ``n``-day totals on rows that are already one per key and day.

    The input is bounded by the number of days per key, so a plain window is
    enough. A span of 7 covers the day itself and the six before it.
    """
    number = F.unix_date(F.col(day).cast("date"))
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(number)
    out = daily
    for n in spans:
        frame = w.rangeBetween(1 - n, 0)
        out = out.withColumns({f"{c}_{n}d": F.sum(c).over(frame) for c in columns})
    return out


def centered_mean(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], along: Column,
    columns: Mapping[str, str], reach: int = 7,
) -> DataFrame:
    """Moving average over ``reach`` rows on each side."""
    return row_frame(
        df, keys, [F.col(c) for c in order], along, reach, reach,
        {
            out: lambda w, c=c: F.avg(c).over(w.rowsBetween(-reach, reach))
            for out, c in columns.items()
        },
    )


def partition_max(df: DataFrame, keys: Sequence[str], value: str, out: str, factor: float = 1.0) -> DataFrame:
    """The group maximum (times ``factor``) on every row, by aggregate and join."""
    top = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg((F.max(value) * F.lit(factor)).alias(out))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return df.join(top, same, "left").select(*df.columns, out)


def back_adjust(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], along: Column,
    price: str, factor: str, out: str = "adjusted",
) -> DataFrame:
    """Price times the product of all *later* factors of the key.

    The product is a running sum of logarithms from the newest row backwards,
    so the blocks run backwards too.
    """
    newest_first = [F.col(c).desc() for c in order]
    summed = running(
        df, keys, newest_first, -along,
        {"_log": ("sum", F.log(F.col(factor)))}, include_current=False,
    )
    return summed.withColumn(out, F.col(price) * F.exp(F.coalesce(F.col("_log"), F.lit(0.0)))).drop("_log")


def top_k_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows per group.

    Spark limits each group inside every map task before the shuffle, so a hot
    group sends at most ``k`` rows per task.
    """
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def merge_intervals(
    df: DataFrame, keys: Sequence[str], start: str, stop: str,
    gap_seconds: int = 0,
) -> DataFrame:
    """Overlapping or nearly touching intervals joined into episodes.

    An interval opens an episode when it starts more than ``gap_seconds`` after
    everything seen before it has ended. An interval without a start is an
    episode of its own. Returns keys, bounds and member count.
    """
    along = epoch_micros(start)
    order = [F.col("_s"), F.col("_e")]
    base = df.withColumn("_s", epoch_micros(start)).withColumn("_e", epoch_micros(stop))
    # ties on (start, stop) are interchangeable, so their order does not matter
    seen = running(base, keys, order, along, {"_seen": ("max", F.when(F.col("_s").isNotNull(), F.col("_e")))}, include_current=False)
    seen = materialise(seen, "intervals")  # the second scan must not repeat the first
    opens = (F.col("_seen").isNull() | (F.col("_s") > F.col("_seen") + gap_seconds * 1_000_000)).cast("long")
    # "seen" of equal rows may differ, but only the first of them can open
    numbered = running(seen.withColumn("_open", opens), keys, [*order, F.col("_open").desc()], along,
                       {"_episode": ("sum", F.col("_open"))})
    return (
        numbered.groupBy(*keys, "_episode")
        .agg(F.min(start).alias(start), F.max(stop).alias(stop), F.count(F.lit(1)).alias("members"))
        .drop("_episode")
    )


def sequence_number(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], along: Column, out: str = "seq"
) -> DataFrame:
    """Ordinal of each row within its key."""
    return number_rows(df, keys, [as_column(o) for o in order], along, out)


def assign_episode(
    events: DataFrame, episodes: DataFrame, keys: Sequence[str], event_id: str, ts: str,
    start: str, stop: str, priority: str,
) -> DataFrame:
    """The best episode containing each event: smallest ``priority`` expression,
    then earliest start. Adds the episode's columns and ``priority``.

    Candidates come from a range join by interval levels; the choice is an aggregate per
    event, so a hot key is spread over its events.
    """
    from .joins import join_range

    found = join_range(events, episodes, keys, ts, start, stop, closed=True)
    found = found.withColumn("priority", F.expr(priority)).filter("priority IS NOT NULL")
    rest = [c for c in found.columns if c != event_id]
    best = found.groupBy(event_id).agg(
        F.min_by(F.struct(*rest), F.struct("priority", start, stop)).alias("_best")
    )
    return best.select(event_id, "_best.*")
