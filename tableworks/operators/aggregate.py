"""Grouped analytics. Spark combines partial results before every shuffle, so a
hot group costs each task one row; nothing here collects a group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import as_column


def entity_profile(
    users: DataFrame, orders: DataFrame, events: DataFrame, user: str,
    order_time: str, amount: str, event_time: str, event_id: str, session: str, platform: str, asof: str,
) -> DataFrame:
    """Customer 360: order and event totals per user, joined to the user row.

    Each side is aggregated to one row per user before the joins.
    """
    bought = orders.groupBy(user).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum(amount).alias("total_amount"),
        F.max(order_time).alias("last_transaction"),
    )
    acted = events.groupBy(user).agg(
        F.min_by(platform, F.struct(event_time, event_id)).alias("first_platform"),
        F.count(F.lit(1)).alias("event_count"),
        F.count_distinct(session).alias("session_count"),
        F.max(event_time).alias("last_event"),
    )
    day = F.lit(asof).cast("date")
    return (
        users.join(bought, user)
        .join(acted, user)
        .withColumns({
            "days_since_last_transaction": F.datediff(day, "last_transaction"),
            "days_since_last_event": F.datediff(day, "last_event"),
        })
    )


def sensor_stats(
    df: DataFrame, keys: Sequence[str], ts: str, columns: Sequence[str],
    probabilities: Sequence[float] = (0.1, 0.3, 0.6, 0.8, 0.95), grain: str = "hour", accuracy: int = 10_000,
) -> DataFrame:
    """Mean, population deviation and percentile array per key and time grain.

    ``percentile_approx`` keeps a mergeable summary; below ``accuracy`` rows
    per group it is exact.
    """
    stats = []
    for c in columns:
        stats += [
            F.avg(c).alias(f"avg_{c}"),
            F.stddev_pop(c).alias(f"std_{c}"),
            F.percentile_approx(c, list(probabilities), accuracy).alias(f"percentiles_{c}"),
        ]
    return df.groupBy(*keys, F.date_trunc(grain, ts).alias("window_start")).agg(*stats)


def trailing_aggregates(
    df: DataFrame, key: str, ts: str, amount: str, prefix: str,
    months: Sequence[int] = (12, 6, 3), partner: str | None = None, anchor: DataFrame | None = None,
) -> DataFrame:
    """Count, sum, mean (and distinct partners) over trailing windows, one scan.

    Windows end at the newest date of ``anchor`` (default: ``df``).
    """
    newest = (anchor if anchor is not None else df).agg(F.max(F.col(ts).cast("date")).alias("d")).scalar()
    aggs: list[Column] = []
    widest = max(months)
    for m in months:
        inside = F.col(ts).cast("date") >= F.add_months(newest, -m)
        aggs += [
            F.count_if(inside).alias(f"{prefix}_cnt_{m}m"),
            F.sum(F.when(inside, F.col(amount))).alias(f"{prefix}_amt_{m}m"),
            F.avg(F.when(inside, F.col(amount))).alias(f"{prefix}_avg_{m}m"),
        ]
        if partner:
            aggs.append(F.count_distinct(F.when(inside, F.col(partner))).alias(f"{prefix}_partners_{m}m"))
    return df.filter(F.col(ts).cast("date") >= F.add_months(newest, -widest)).groupBy(key).agg(*aggs)


def conditional_counts(df: DataFrame, keys: Sequence[str], flags: Mapping[str, str], distinct: Mapping[str, tuple[str, str]] | None = None,
                       rates: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """Funnel: name -> predicate counts, distinct counts under a predicate, rates of two names."""
    aggs = [F.count_if(F.expr(p)).alias(n) for n, p in flags.items()]
    aggs += [F.count_distinct(F.when(F.expr(p), F.col(c))).alias(n) for n, (p, c) in (distinct or {}).items()]
    out = df.groupBy(*keys).agg(*aggs)
    return out.withColumns({n: F.try_divide(F.col(a), F.col(b)) for n, (a, b) in (rates or {}).items()}) if rates else out


def multi_level_totals(df: DataFrame, dims: Sequence[str], aggs: Mapping[str, Column], sets: Sequence[Sequence[str]] | None = None) -> DataFrame:
    """Detail rows, totals per dimension and the grand total, marked 'ALL'.

    A real null in a dimension stays null: only grouped-out columns say ALL.
    """
    cube = (
        df.cube(*dims)
        if sets is None
        else df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(d) for d in dims])
    )
    out = cube.agg(*[F.grouping(d).alias(f"_g_{d}") for d in dims], *[c.alias(n) for n, c in aggs.items()])
    labelled = [F.when(F.col(f"_g_{d}") == 1, F.lit("ALL")).otherwise(F.col(d).cast("string")).alias(d) for d in dims]
    return out.select(*labelled, *aggs)


def grand_total(df: DataFrame, aggs: Mapping[str, Column]) -> DataFrame:
    """One row, also for an empty input."""
    return df.groupingSets([[]]).agg(*[c.alias(n) for n, c in aggs.items()])


def group_all(df: DataFrame, dims: Mapping[str, Column | str], aggs: Mapping[str, Column], having: str | None = None) -> DataFrame:
    """Group by aliased expressions, with a filter on the result's own names."""
    out = df.groupBy(*[as_column(c).alias(n) for n, c in dims.items()]).agg(*[c.alias(n) for n, c in aggs.items()])
    return out.filter(having) if having else out


def collect_values(df: DataFrame, keys: Sequence[str], column: str, out: str, separator: str | None = None) -> DataFrame:
    """Sorted distinct values per key; joined to text when a separator is given."""
    distinct = df.select(*keys, column).filter(F.col(column).isNotNull()).distinct()
    values = F.array_sort(F.collect_set(F.col(column)))
    return distinct.groupBy(*keys).agg((F.array_join(values, separator) if separator else values).alias(out))


def pivot_wide(df: DataFrame, index: Sequence[str], column: str, values: Sequence[object], value: str) -> DataFrame:
    """Long metrics to columns. The value list is given, so no extra job runs."""
    return df.groupBy(*index).pivot(column, list(values)).agg(F.first(value, ignorenulls=True))


def period_kpi(df: DataFrame, ts: str, grain: str, aggs: Mapping[str, Column], keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(F.date_trunc(grain, ts).cast("date").alias("period"), *keys).agg(*[c.alias(n) for n, c in aggs.items()])


def period_change(df: DataFrame, ts: str, value: Column, grain: str = "month", keys: Sequence[str] = ()) -> DataFrame:
    """Total per period with difference and percent change to the period before.

    The window runs on one row per key and period.
    """
    out = period_kpi(df, ts, grain, {"total": value}, keys)
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("period")
    before = F.lag("total").over(w)
    return out.withColumns({
        "change": F.col("total") - before,
        "change_pct": F.try_divide(F.lit(100.0) * (F.col("total") - before), before),
    })


def ratio_kpi(df: DataFrame, keys: Sequence[str], numerator: Column, denominator: Column, out: str = "ratio", digits: int = 4) -> DataFrame:
    """Ratio of two aggregates, null when the denominator is 0."""
    return df.groupBy(*keys).agg(F.round(F.try_divide(numerator.cast("double"), denominator.cast("double")), digits).alias(out))


def share_of_total(df: DataFrame, keys: Sequence[str], value: Column, out: str = "share") -> DataFrame:
    """Each group's part of the total; the total comes from the grouped rows."""
    grouped = df.groupBy(*keys).agg(value.alias("total"))
    whole = grouped.agg(F.sum("total").alias("s")).scalar()
    return grouped.withColumn(out, F.try_divide(F.col("total").cast("double"), whole))


def pair_flow(df: DataFrame, origin: str, destination: str, aggs: Mapping[str, Column], keys: Sequence[str] = ()) -> DataFrame:
    """Totals per (origin, destination) with the key of the unordered pair."""
    pair = F.concat_ws("-", F.least(origin, destination), F.greatest(origin, destination))
    return df.withColumn("pair", pair).groupBy(origin, destination, "pair", *keys).agg(*[c.alias(n) for n, c in aggs.items()])


def histogram(df: DataFrame, column: str, width: float, keys: Sequence[str] = ()) -> DataFrame:
    low = F.floor(F.col(column) / F.lit(width)) * F.lit(width)
    return df.groupBy(low.alias("bin"), *keys).agg(F.count(F.lit(1)).alias("n"))


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[object]) -> DataFrame:
    """Counts of every pair; missing pairs are 0."""
    out = df.groupBy(row).pivot(column, list(values)).agg(F.count(F.lit(1)))
    names = [c for c in out.columns if c != row]
    return out.select(row, *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(f"{column}_{c}") for c in names])


def loss_ratio(
    policies: DataFrame, claims: DataFrame, start: str, stop: str, keys: Sequence[str] = (),
    premium: str = "premium", begins: str = "begins", ends: str = "ends", amount: str = "amount", claim_date: str = "claim_date",
) -> DataFrame:
    """Claims / earned premium in ``[start, stop]`` and in the equally long period before.

    Earned premium is the monthly premium times the months a policy was active
    inside the period. Both periods are sums of the same pass.
    """
    def earned_in(label: str, lo: Column, hi: Column) -> Column:
        months = F.months_between(F.least(F.col(ends), hi), F.greatest(F.col(begins), lo))
        active = (F.col(begins) <= hi) & (F.col(ends) >= lo)
        return F.sum(F.when(active, F.col(premium) * months)).alias(f"{label}_premium")

    def paid_in(label: str, lo: Column, hi: Column) -> Column:
        inside = (F.col(claim_date) >= lo) & (F.col(claim_date) <= hi)
        return F.sum(F.when(inside, F.col(amount))).alias(f"{label}_claims")

    lo, hi = F.lit(start).cast("date"), F.lit(stop).cast("date")
    length = F.datediff(hi, lo)
    before_hi = F.date_sub(lo, 1)
    before_lo = F.date_sub(before_hi, length)
    group = list(keys)
    earned = policies.groupBy(*group).agg(earned_in("current", lo, hi), earned_in("prior", before_lo, before_hi))
    paid = claims.groupBy(*group).agg(paid_in("current", lo, hi), paid_in("prior", before_lo, before_hi))
    if group:
        joined = earned.join(paid, group, "left")
    else:
        joined = earned.select("*", paid.select("current_claims").scalar().alias("current_claims"),
                               paid.select("prior_claims").scalar().alias("prior_claims"))
    return joined.withColumns({
        f"{p}_loss_ratio": F.try_divide(F.coalesce(F.col(f"{p}_claims"), F.lit(0.0)), F.col(f"{p}_premium"))
        for p in ("current", "prior")
    })


def shortage(demand: DataFrame, supply: DataFrame, item: str, need: str, have: str, fanout: bool = False) -> DataFrame:
    """Items needed beyond what is there.

    Each side is summed before the join. ``fanout=True`` joins first, which
    multiplies rows that occur several times; kept for comparing old reports.
    """
    if fanout:
        out = demand.join(supply, item, "left").groupBy(item).agg(
            F.sum(need).alias("demand"), F.coalesce(F.sum(have), F.lit(0)).alias("supply")
        )
    else:
        left = demand.groupBy(item).agg(F.sum(need).alias("demand"))
        right = supply.groupBy(item).agg(F.sum(have).alias("supply"))
        out = left.join(right, item, "left").withColumn("supply", F.coalesce("supply", F.lit(0)))
    return out.withColumn("short", F.col("demand") - F.col("supply")).filter("short > 0")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys seen more than once, and null keys."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | missing)


def active_users(df: DataFrame, user: str, ts: str, grain: str = "day", keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(F.date_trunc(grain, ts).cast("date").alias("period"), *keys).agg(F.count_distinct(user).alias("users"))


def week_start_sunday(ts: str | Column) -> Column:
    day = as_column(ts).cast("date")
    return F.date_sub(day, F.dayofweek(day) - 1)


def volatility(df: DataFrame, keys: Sequence[str], ts: str, value: str) -> DataFrame:
    """Sample deviation of a value per key and week (weeks begin on Sunday)."""
    return df.groupBy(*keys, week_start_sunday(ts).alias("week")).agg(
        F.stddev_samp(value).alias("volatility"), F.count(value).alias("n")
    )


def describe_table(df: DataFrame, columns: Sequence[str], accuracy: int = 1_000_000) -> DataFrame:
    """count, mean, std, min, quartiles, max of each column, one row per column.

    One pass over the table; the single result row is then turned.
    """
    names = ["n", "mean", "std", "min", "p25", "p50", "p75", "max"]
    aggs = []
    for c in columns:
        v = F.col(c).cast("double")
        aggs.append(F.struct(
            F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"),
            F.percentile_approx(v, [0.25, 0.5, 0.75], accuracy).alias("q"), F.max(v).alias("max"),
        ).alias(c))
    wide = df.agg(*aggs)
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"),
            *[
                (F.col(c)["q"][("p25", "p50", "p75").index(n)] if n.startswith("p") else F.col(c)[n]).alias(n)
                for n in names
            ],
        )
        for c in columns
    ])
    return wide.select(F.explode(rows).alias("_r")).select("_r.*")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows in order (each task keeps n, the driver merges)."""
    return df.orderBy(*order).limit(n)


def sort_multi(df: DataFrame, **directions: str) -> DataFrame:
    """Sort by ``column="asc" | "desc"``; nulls last in both directions."""
    return df.orderBy(*[
        (F.asc_nulls_last if d == "asc" else F.desc_nulls_last)(c) for c, d in directions.items()
    ])


def limit_offset(df: DataFrame, order: Sequence[Column | str], limit: int, offset: int) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(limit)


def shuffle_rows(df: DataFrame, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """A repeatable random order: a distributed sort by key hash."""
    return df.orderBy(F.xxhash64(*[F.col(k) for k in keys], F.lit(seed)), *keys)


def union_all(first: DataFrame, *rest: DataFrame, by_name: bool = True, fill: bool = False) -> DataFrame:
    for df in rest:
        first = first.unionByName(df, allowMissingColumns=fill) if by_name else first.union(df)
    return first


def union_distinct(first: DataFrame, *rest: DataFrame) -> DataFrame:
    return union_all(first, *rest, by_name=False).distinct()


