"""Ordered per-key scans that stay balanced when one key holds most rows.

``Window.partitionBy(key)`` sends a whole key to one task. The functions here
first look for keys with more rows than a task should take (one aggregate).
Without any, a plain window over one shuffle does the work. Otherwise the hot
keys, and only those, are cut into *blocks* of equal rows along their ordering
column:

1. aggregate every (key, block) to one summary row (map-side combined),
2. fold the summaries over the earlier (or later) blocks of the key: one row
   per block, so this window is small even for the hottest key,
3. finish inside (key, block) and add what the neighbours carried in.

The big data is shuffled once, by (key, block).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..session import materialise

DAY = 86_400

# rows of one key that one task may take before the key is cut
TARGET_ROWS = 5_000_000


class Carry(NamedTuple):
    """``agg`` summarises one block; ``fold`` (sum, max, min, last, first) joins
    the blocks before the own one, or after it with ``later``."""

    name: str
    agg: Column
    fold: str
    later: bool = False


_FOLDS = {
    "sum": F.sum,
    "max": F.max,
    "min": F.min,
    "last": lambda c: F.last(c, ignorenulls=True),
    "first": lambda c: F.first(c, ignorenulls=True),
}


def as_column(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_micros(col: str | Column) -> Column:
    """Microseconds since 1970 of a timestamp or date (sessions run in UTC)."""
    return F.unix_micros(as_column(col).cast("timestamp"))


def epoch_seconds(col: str | Column) -> Column:
    return F.floor(epoch_micros(col) / F.lit(1_000_000)).cast("long")


def key_struct(keys: Sequence[str]) -> Column:
    """Keys as one struct: equal also where a key is null, so no row is lost."""
    return F.struct(*[F.col(k) for k in keys])


def hot_keys(cut: DataFrame) -> DataFrame | None:
    """Stored table of the keys (column ``_key``) with more than ``TARGET_ROWS`` rows: ``_n``, ``_lo``, ``_hi`` of ``_along``.

    At most rows / ``TARGET_ROWS`` keys qualify; none gives None.
    """
    counts = cut.groupBy("_key").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_along").alias("_lo"), F.max("_along").alias("_hi"))
    found = materialise(counts.filter(F.col("_n") > TARGET_ROWS), "hot-keys")
    return None if found.isEmpty() else found


def _block_bounds(cut: DataFrame, hot: DataFrame) -> DataFrame:
    """Per hot key the values of ``_along`` at which its blocks begin: ``_step`` bounds in each array of ``_bounds``.

    The bounds are quantiles, so blocks are equal in rows and not in width. The
    summary they come from grows with the blocks, not with the rows.
    """
    most = -(-hot.agg(F.max("_n")).first()[0] // TARGET_ROWS)
    shares = [i / most for i in range(1, most)]
    # ten times finer than a block
    bounds = cut.join(hot.select("_key", "_n"), "_key").groupBy("_key", "_n").agg(
        F.percentile_approx("_along", shares, 10 * most + 1_000).alias("_all"))
    each = F.greatest(F.lit(1), F.floor(F.lit(most) / F.ceil(F.col("_n") / F.lit(TARGET_ROWS)))).cast("int")
    own = F.array_distinct(F.filter("_all", lambda x, i: (i + 1) % F.col("_each") == 0))
    step = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size("_own"))).cast("int"))
    chunks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.size("_own") / F.col("_step")).cast("int") - 1)),
        lambda c: F.slice("_own", c * F.col("_step") + 1, F.col("_step")))
    # a key without any value has no bounds; all its rows are in the block of nulls
    bounds = bounds.withColumn("_each", each).withColumn("_own", own).withColumn("_step", step)
    return bounds.select("_key", "_n", "_step", F.when(F.size("_own") > 0, chunks).alias("_bounds"))


def cut_blocks(df: DataFrame, keys: Sequence[str], along: Column, width: float | None = None) -> tuple[DataFrame, bool]:
    """Add ``_key`` and ``_block``; tells whether any key has several blocks.

    ``along`` is a number that rises with the order. A hot key gets blocks of
    about ``TARGET_ROWS`` rows each; rows with equal ``along`` stay in one, as
    do those without. A given ``width`` is used for all keys instead.
    """
    cut = df.withColumn("_key", key_struct(keys)).withColumn("_along", along.cast("double"))
    if width is not None:
        block = F.floor(F.col("_along") / F.lit(float(width))).cast("long")
        return cut.withColumn("_block", F.coalesce(block, F.lit(-(2**62)))).drop("_along"), True
    hot = hot_keys(cut)
    if hot is None:
        return cut.withColumn("_block", F.lit(0).cast("long")).drop("_along"), False
    joined = cut.join(materialise(_block_bounds(cut, hot), "block-bounds"), "_key", "left")
    # bounds not above the row's value: first whole arrays, then inside the last of them
    passed = lambda bounds: F.size(F.filter(bounds, lambda b: b <= F.col("_along")))
    arrays = passed(F.transform("_bounds", lambda c: F.get(c, F.lit(0))))
    block = F.when(F.col("_arrays") > 0, (F.col("_arrays") - 1) * F.col("_step") + passed(F.get("_bounds", F.col("_arrays") - 1))).otherwise(0)
    # nulls sort first, and other keys have one block
    block = F.when(F.col("_n").isNull(), 0).when(F.col("_along").isNull(), -1).otherwise(block)
    out = joined.withColumn("_arrays", arrays).withColumn("_block", block.cast("long"))
    return out.drop("_along", "_n", "_step", "_bounds", "_arrays"), True


def carry_in(df: DataFrame, carries: Sequence[Carry], split: bool = True) -> DataFrame:
    """Add, per row, each carry folded over the earlier (or later) blocks of its key.

    Without a ``split`` there are no other blocks and every carry is null.
    """
    if not split:
        return df.withColumns({c.name: F.lit(None) for c in carries})
    key, block = "_key", "_block"
    summary = df.groupBy(key, block).agg(*[c.agg.alias(c.name) for c in carries])
    order = Window.partitionBy(key).orderBy(block)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(1, Window.unboundedFollowing)
    folded = summary.select(
        key, block,
        *[_FOLDS[c.fold](F.col(c.name)).over(after if c.later else before).alias(c.name) for c in carries],
    )
    return df.join(folded, [key, block], "left")


def number_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], along: Column, out: str, width: float | None = None
) -> DataFrame:
    """``row_number`` per key. ``along`` is a number that rises with the first order column."""
    cut, split = cut_blocks(df, keys, along, width)
    cut = carry_in(cut, [Carry("_before", F.count(F.lit(1)), "sum")], split)
    inside = F.row_number().over(Window.partitionBy("_key", "_block").orderBy(*order))
    return cut.withColumn(
        out, inside.cast("long") + F.coalesce(F.col("_before"), F.lit(0))
    ).drop("_key", "_block", "_before")


def adjacent_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    along: Column,
    previous: Mapping[str, Column | str] | None = None,
    following: Mapping[str, Column | str] | None = None,
    width: float | None = None,
) -> DataFrame:
    """``lag`` and ``lead`` by one row of several values, in one scan.

    ``order`` columns are ascending and must be unique within a key.
    """
    rank = F.struct(*[F.col(c) for c in order])
    cut, split = cut_blocks(df, keys, along, width)
    sides = [(n, v) for n, v in (("_back", previous), ("_ahead", following)) if v]
    for name, values in sides:
        cut = cut.withColumn(name, F.struct(*[as_column(v).alias(n) for n, v in values.items()]))
    carries = [
        Carry("_edge_back", F.max_by("_back", rank), "last")
        if name == "_back"
        else Carry("_edge_ahead", F.min_by("_ahead", rank), "first", later=True)
        for name, _ in sides
    ]
    cut = carry_in(cut, carries, split)
    w = Window.partitionBy("_key", "_block").orderBy(*order)
    out = [F.col(c) for c in df.columns]
    for name, values in sides:
        near = (F.lag if name == "_back" else F.lead)(name).over(w)
        cut = cut.withColumn(f"_near{name}", near)
        # a neighbour struct is never null itself, so coalesce keeps null values apart
        found = F.coalesce(F.col(f"_near{name}"), F.col(f"_edge{name}"))
        out += [found.getField(n).alias(n) for n in values]
    return cut.select(*out)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    along: Column,
    outputs: Mapping[str, tuple[str, Column]],
    include_current: bool = True,
    width: float | None = None,
) -> DataFrame:
    """Running sum, max, min or last from the start of the key.

    ``outputs`` maps a name to (fold, expression). With ``include_current``
    off, the frame ends one row before the current one. ``last`` needs an
    ascending order.
    """
    cut, split = cut_blocks(df, keys, along, width)
    aggs = {"sum": F.sum, "max": F.max, "min": F.min}
    names = list(outputs)
    for i, name in enumerate(names):
        cut = cut.withColumn(f"_in{i}", outputs[name][1])
    carries = []
    for i, name in enumerate(names):
        fold = outputs[name][0]
        agg = (
            F.max_by(f"_in{i}", F.when(F.col(f"_in{i}").isNotNull(), F.struct(*order)))
            if fold == "last"
            else aggs[fold](f"_in{i}")
        )
        carries.append(Carry(f"_carry{i}", agg, fold))
    cut = carry_in(cut, carries, split)
    w = (
        Window.partitionBy("_key", "_block")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0 if include_current else -1)
    )
    columns = [F.col(c) for c in df.columns]
    for i, name in enumerate(names):
        fold = outputs[name][0]
        local = _FOLDS[fold](F.col(f"_in{i}")).over(w)
        carried = F.col(f"_carry{i}")
        if fold == "last":
            value = F.coalesce(local, carried)
        elif fold == "sum":
            value = F.when(
                local.isNotNull() | carried.isNotNull(),
                F.coalesce(local, F.lit(0)) + F.coalesce(carried, F.lit(0)),
            )
        else:
            value = (F.greatest if fold == "max" else F.least)(local, carried)
        columns.append(value.alias(name))
    return cut.select(*columns)


def rolling_range(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    seconds: int,
    outputs: Mapping[str, tuple[str, str]],
    block_seconds: float | None = None,
) -> DataFrame:
    """Aggregates over ``[t - seconds, t]`` per key, both ends included.

    ``outputs`` maps a name to (sum | count | min | max | avg, column). Keys
    that fit one task use a plain range window; hot keys are cut finer than
    the window where their rows need it (see ``_rolling_blocks``).
    ``block_seconds``, a divisor of ``seconds``, forces that for all keys.
    """
    if block_seconds is not None:
        return _rolling_blocks(df, keys, ts, seconds, outputs, round(seconds / block_seconds))
    cut = df.withColumn("_key", key_struct(keys)).withColumn("_along", epoch_micros(ts).cast("double"))
    hot = hot_keys(cut)
    cold = cut
    if hot is not None:
        table = hot.select("_key")
        cold = cut.join(table, "_key", "left_anti")
        density = F.max(F.col("_n") / F.greatest(F.col("_hi") - F.col("_lo"), F.lit(1.0)))
        busiest = hot.agg(density).first()[0] or 1.0
        pieces = _divisor(seconds * 1_000_000, busiest * seconds * 1_000_000 / TARGET_ROWS)
        hot_part = _rolling_blocks(
            cut.join(table, "_key", "left_semi").select(*df.columns), keys, ts, seconds, outputs, pieces)
    w = Window.partitionBy("_key").orderBy("_t").rangeBetween(-seconds * 1_000_000, 0)
    agg = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "avg": F.avg}
    plain = cold.withColumn("_t", epoch_micros(ts)).withColumns(
        {name: agg[fn](c).over(w) for name, (fn, c) in outputs.items()}
    ).select(*df.columns, *outputs)
    return plain if hot is None else plain.unionByName(hot_part)


def _divisor(span: int, wanted: float) -> int:
    """The smallest divisor of ``span`` of the form 2^i 5^j that is at least ``wanted``."""
    fits = sorted(2**i * 5**j for i in range(20) for j in range(10) if span % (2**i * 5**j) == 0)
    return next((f for f in fits if f >= wanted), fits[-1])


def _rolling_blocks(
    df: DataFrame, keys: Sequence[str], ts: str, seconds: int, outputs: Mapping[str, tuple[str, str]], pieces: int
) -> DataFrame:
    """Rolling aggregates with ``pieces`` blocks per window.

    A window is the head of its own block, the whole blocks between, and the
    tail of the block where it begins. For the tail each row is sent once more,
    shifted by the window length: a shifted copy at or after the current time
    is still inside. No subtraction, so the result does not drift.
    """
    if seconds * 1_000_000 % pieces:
        raise ValueError("blocks must divide the window")
    base: dict[str, tuple[str, str]] = {}
    for name, (fn, col) in outputs.items():
        if fn == "avg":
            base[f"_s_{name}"] = ("sum", col)
            base[f"_n_{name}"] = ("count", col)
        else:
            base[f"_v_{name}"] = (fn, col)
    agg = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
    join = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
    span = seconds * 1_000_000
    width = span // pieces
    inputs = sorted({c for _, c in base.values()})

    own = df.withColumn("_key", key_struct(keys)).withColumn("_t", epoch_micros(ts))
    own = own.withColumn("_block", F.floor(F.col("_t") / width).cast("long"))
    totals = own.groupBy("_key", "_block").agg(
        *[agg[fn](c).alias(n) for n, (fn, c) in base.items()]
    )
    # blocks wholly inside the window, seen from each block that has rows
    whole = Window.partitionBy("_key").orderBy("_block").rangeBetween(1 - pieces, -1)
    middle = totals.select(
        "_key", "_block",
        *[join[fn](F.col(n)).over(whole).alias(f"{n}_mid") for n, (fn, _) in base.items()],
    )
    ghosts = own.select(
        "_key",
        (F.col("_t") + span).alias("_t"),
        (F.col("_block") + pieces).alias("_block"),
        *[F.col(c).alias(f"_g_{c}") for c in inputs],
        F.lit(True).alias("_ghost"),
    )
    mixed = own.withColumn("_ghost", F.lit(False)).unionByName(ghosts, allowMissingColumns=True)
    w = Window.partitionBy("_key", "_block").orderBy("_t")
    head = w.rangeBetween(Window.unboundedPreceding, 0)
    tail = w.rangeBetween(0, Window.unboundedFollowing)
    for n, (fn, c) in base.items():
        mine = F.when(~F.col("_ghost"), F.col(c))
        theirs = F.when(F.col("_ghost"), F.col(f"_g_{c}"))
        mixed = mixed.withColumn(f"{n}_head", agg[fn](mine).over(head))
        mixed = mixed.withColumn(f"{n}_tail", agg[fn](theirs).over(tail))
    done = mixed.filter(~F.col("_ghost")).join(middle, ["_key", "_block"], "left")

    def total(n: str, fn: str) -> Column:
        parts = [F.col(f"{n}_head"), F.col(f"{n}_mid"), F.col(f"{n}_tail")]
        if fn in ("min", "max"):
            return (F.least if fn == "min" else F.greatest)(*parts)
        some = parts[0].isNotNull() | parts[1].isNotNull() | parts[2].isNotNull()
        filled = [F.coalesce(p, F.lit(0)) for p in parts]
        return F.when(some, filled[0] + filled[1] + filled[2])

    columns = [F.col(c) for c in df.columns]
    for name, (fn, _) in outputs.items():
        if fn == "avg":
            value = total(f"_s_{name}", "sum") / F.nullif(total(f"_n_{name}", "count"), F.lit(0))
        else:
            value = total(f"_v_{name}", fn)
        columns.append(value.alias(name))
    return done.select(*columns)


def row_frame(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    along: Column,
    before: int,
    after: int,
    outputs: Mapping[str, Callable[[WindowSpec], Column]],
    segment_rows: int = 1_000_000,
    width: float | None = None,
) -> DataFrame:
    """Window results that reach ``before`` rows back and ``after`` rows ahead.

    Rows are numbered, cut into segments of equal length, and only the few rows
    near a segment edge are copied to the neighbour. Each output is a function
    of the ordered window, such as ``lambda w: F.lag("v", 2).over(w)``.
    """
    if max(before, after) >= segment_rows:
        raise ValueError("frame longer than a segment")
    numbered = number_rows(df, keys, order, along, "_rn", width).withColumn("_key", key_struct(keys))
    place = F.pmod(F.col("_rn"), F.lit(segment_rows))
    home = F.floor(F.col("_rn") / segment_rows)
    spread = numbered.withColumn("_home", home).withColumn(
        "_seg",
        F.explode(
            F.array_compact(
                F.array(
                    home,
                    F.when(place < after, home - 1),
                    F.when(place >= segment_rows - before, home + 1),
                )
            )
        ),
    )
    w = Window.partitionBy("_key", "_seg").orderBy("_rn")
    return (
        spread.withColumns({n: build(w) for n, build in outputs.items()})
        .filter(F.col("_seg") == F.col("_home"))
        .select(*df.columns, *outputs)
    )
