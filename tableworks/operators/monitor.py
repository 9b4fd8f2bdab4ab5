"""Profiles, drift and model quality over time windows.

Every operator first reduces the big table to small summaries (one row per
window, slice, class or bin); comparisons run on those.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise


def _windows(ts: str, granularities: Sequence[str]) -> Column:
    """One (granularity, window_start) per wanted granularity, such as day, week or month."""
    return F.explode(F.array(*[
        F.struct(F.lit(g).alias("granularity"), F.date_trunc(g, ts).alias("window_start")) for g in granularities
    ])).alias("_w")


def profile_metrics(
    df: DataFrame, ts: str, granularities: Sequence[str], columns: Sequence[str], slices: Sequence[str] = (),
    probabilities: Sequence[float] = (0.5,), accuracy: int = 10_000,
) -> DataFrame:
    """Per granularity x window x slice x column: counts, zeros, distinct, spread, quantiles.

    ``:table`` rows hold the row count. All columns are profiled in the same
    aggregate, and slices are grouping sets, so the table is scanned once;
    distinct counts and quantiles are mergeable sketches.
    """
    w = ["_w.granularity", "_w.window_start"]
    base = df.select("*", _windows(ts, granularities)).select(*w, *columns, *slices)
    keys = ["granularity", "window_start"]
    stats = []
    for c in columns:
        v = F.col(c).cast("double")
        stats.append(F.struct(
            F.lit(c).alias("column_name"), F.count(v).alias("n"), F.count_if(v.isNull()).alias("nulls"),
            F.count_if(v == 0).alias("zeros"), F.approx_count_distinct(v, 0.02).alias("distinct_values"),
            F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("stddev"),
            F.percentile_approx(v, list(probabilities), accuracy).alias("quantiles"),
        ))
    none = F.lit(None).cast("double")
    stats.append(F.struct(
        F.lit(":table").alias("column_name"), F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("nulls"),
        F.lit(0).cast("long").alias("zeros"), F.lit(None).cast("long").alias("distinct_values"),
        *[none.alias(n) for n in ("min", "max", "mean", "stddev")], F.lit(None).cast("array<double>").alias("quantiles"),
    ))
    sets = [keys, *[[*keys, s] for s in slices]]
    if slices:
        grouped = base.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in (*keys, *slices)])
        out = grouped.agg(*[F.grouping(s).alias(f"_g_{s}") for s in slices], F.array(*stats).alias("_s"))
        key, value = F.lit(None).cast("string"), F.lit(None).cast("string")
        for s in slices:
            own = F.col(f"_g_{s}") == 0
            key = F.when(own, F.lit(s)).otherwise(key)
            value = F.when(own, F.col(s).cast("string")).otherwise(value)
    else:
        out = base.groupBy(*keys).agg(F.array(*stats).alias("_s"))
        key = value = F.lit(None).cast("string")
    return out.select(*keys, key.alias("slice_key"), value.alias("slice_value"), F.inline("_s"))


def frequent_items(df: DataFrame, ts: str, granularity: str, column: str, k: int = 10) -> DataFrame:
    """The k most frequent values per window."""
    counts = df.groupBy(F.date_trunc(granularity, ts).alias("window_start"), F.col(column).cast("string").alias("item")).agg(
        F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("window_start").orderBy(F.desc("n"), F.asc_nulls_last("item"))
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def distributions(df: DataFrame, window: Column, bin_of: Column) -> DataFrame:
    """Share of each bin per window: the input of ``drift_metrics``."""
    counts = df.groupBy(window.alias("window_start"), bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("window_start").agg(F.sum("n").alias("total"))
    return counts.join(totals, "window_start").withColumn("share", F.col("n") / F.col("total"))


def number_bins(column: str, bounds: Sequence[float]) -> Column:
    """Index of the bin a number falls into (bounds ascending)."""
    out = F.lit(len(bounds))
    for i in range(len(bounds) - 1, -1, -1):
        out = F.when(F.col(column) < bounds[i], i).otherwise(out)
    return F.when(F.col(column).isNotNull(), out)


def drift_metrics(dist: DataFrame, baseline: DataFrame | None = None) -> DataFrame:
    """Each window against the one before it, or against a baseline distribution.

    Gives total variation, L-infinity, Jensen-Shannon distance (base 2),
    chi-square, PSI, and for ordered bins the Kolmogorov-Smirnov distance.
    ``dist`` and ``baseline`` (bin, share) have one row per bin, so the
    comparison is small whatever the size of the table; it is stored once, as
    it is used several times. A baseline may have up to 1000 bins.
    """
    dist = materialise(dist, "distribution")
    windows = dist.select("window_start", "total").distinct()
    cur = dist.select("window_start", "bin", F.col("share").alias("p"))
    if baseline is None:
        order = Window.orderBy("window_start")
        pairs = windows.withColumn("base_start", F.lag("window_start").over(order)).filter("base_start IS NOT NULL")
        base = dist.select(F.col("window_start").alias("base_start"), "bin", F.col("share").alias("q"))
        base = pairs.select("window_start", "base_start").join(base, "base_start").select("window_start", "bin", "q")
        kind = "CONSECUTIVE"
    else:
        bins = baseline.select("bin", F.col("share").alias("q")).limit(1_001).collect()
        if len(bins) > 1_000:
            raise ValueError("baseline has more than 1000 bins")
        pairs = windows
        # every window meets every bin of the baseline
        base = windows.select("window_start", F.inline(F.array(*[
            F.struct(F.lit(x.bin).alias("bin"), F.lit(x.q).alias("q")) for x in bins])))
        kind = "BASELINE"
    cur = cur.join(pairs.select("window_start"), "window_start", "left_semi").withColumn("q", F.lit(None).cast("double"))
    both = cur.unionByName(base.withColumn("p", F.lit(None).cast("double"))).groupBy("window_start", "bin").agg(
        F.coalesce(F.max("p"), F.lit(0.0)).alias("p"), F.coalesce(F.max("q"), F.lit(0.0)).alias("q"))
    order = Window.partitionBy("window_start").orderBy(F.asc_nulls_first("bin"))
    both = both.withColumns({"cp": F.sum("p").over(order), "cq": F.sum("q").over(order)})
    p, q = F.col("p"), F.col("q")
    m = (p + q) / 2
    js = (F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0)) / 2
    # empty bins get a floor so that the index stays finite
    floor = F.lit(1e-4)
    pf, qf = F.greatest(p, floor), F.greatest(q, floor)
    out = both.groupBy("window_start").agg(
        (F.sum(F.abs(p - q)) / 2).alias("tv_distance"),
        F.max(F.abs(p - q)).alias("l_infinity_distance"),
        F.sqrt(F.greatest(F.sum(js), F.lit(0.0))).alias("js_distance"),
        F.sum(F.when(q > 0, F.pow(p - q, 2) / q)).alias("_chi"),
        F.sum((pf - qf) * F.log(pf / qf)).alias("population_stability_index"),
        F.max(F.abs(F.col("cp") - F.col("cq"))).alias("ks_distance"),
    )
    return out.join(windows, "window_start").select(
        "window_start", F.lit(kind).alias("drift_type"), "tv_distance", "l_infinity_distance", "js_distance",
        (F.col("_chi") * F.col("total")).alias("chi_square"), "population_stability_index", "ks_distance")


def custom_metrics(
    df: DataFrame, keys: Mapping[str, Column], columns: Sequence[str],
    aggregate: Mapping[str, str], derived: Mapping[str, str] | None = None, drift: Mapping[str, str] | None = None,
    bindings: Mapping[str, str] | None = None,
) -> DataFrame:
    """User-written metrics. Templates may use ``{{input_column}}`` and names of ``bindings``.

    ``aggregate``: aggregate SQL over rows; ``derived``: SQL over the
    aggregates of the same row; ``drift``: SQL over ``current`` and ``base``,
    the aggregates of this and the previous window (the first key).
    """
    def render(template: str, column: str) -> str:
        text = template.replace("{{input_column}}", column)
        for name, value in (bindings or {}).items():
            text = text.replace("{{" + name + "}}", value)
        return text

    rows = [
        F.struct(F.lit(c).alias("column_name"), *[F.expr(render(t, c)).cast("double").alias(n) for n, t in aggregate.items()])
        for c in columns
    ]
    grouped = df.groupBy(*[k.alias(n) for n, k in keys.items()]).agg(F.array(*rows).alias("_m"))
    out = grouped.select(*keys, F.inline("_m"))
    names = [*aggregate]
    for name, template in (derived or {}).items():
        out = out.withColumn(name, F.expr(template))
        names.append(name)
    if drift:
        first, *other = keys
        w = Window.partitionBy(*other, "column_name").orderBy(first)
        here = F.struct(*names)
        out = out.withColumns({"current": here, "base": F.lag(here).over(w)})
        out = out.withColumns({n: F.expr(t) for n, t in drift.items()}).drop("current", "base")
    return out


def regression_quality(df: DataFrame, keys: Mapping[str, Column], label: str, prediction: str) -> DataFrame:
    """MSE, MAE and R2 per key."""
    y, p = F.col(label), F.col(prediction)
    return df.filter(y.isNotNull() & p.isNotNull()).groupBy(*[k.alias(n) for n, k in keys.items()]).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.pow(y - p, 2)).alias("mse"), F.avg(F.abs(y - p)).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.sum(F.pow(y - p, 2)), F.var_pop(y) * F.count(F.lit(1)))).alias("r2"))


def classification_quality(df: DataFrame, keys: Mapping[str, Column], label: str, prediction: str) -> DataFrame:
    """Accuracy, weighted precision and recall, macro F1 per key.

    Rows are reduced to confusion counts first; classes are then few rows.
    """
    names = list(keys)
    counts = df.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull()).groupBy(
        *[k.alias(n) for n, k in keys.items()], F.col(label).alias("_y"), F.col(prediction).alias("_p")
    ).agg(F.count(F.lit(1)).alias("_n"))
    roles = F.explode(F.array(
        F.struct(F.col("_y").alias("cls"), F.col("_n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col("_y") == F.col("_p"), F.col("_n")).otherwise(0).alias("hit")),
        F.struct(F.col("_p").alias("cls"), F.lit(0).cast("long").alias("support"), F.col("_n").alias("predicted"),
                 F.lit(0).cast("long").alias("hit")),
    ))
    per = counts.select(*names, roles.alias("_r")).select(*names, "_r.*").groupBy(*names, "cls").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hit").alias("hit"))
    precision = F.coalesce(F.try_divide(F.col("hit").cast("double"), F.col("predicted")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(F.col("hit").cast("double"), F.col("support")), F.lit(0.0))
    per = per.withColumns({"precision": precision, "recall": recall})
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
    total = F.sum("support")
    return per.withColumn("f1", f1).groupBy(*names).agg(
        total.alias("n"), (F.sum("hit") / total).alias("accuracy"),
        (F.sum(F.col("precision") * F.col("support")) / total).alias("weighted_precision"),
        (F.sum(F.col("recall") * F.col("support")) / total).alias("weighted_recall"), F.avg("f1").alias("macro_f1"))


def baseline_view(df: DataFrame, ts: str) -> DataFrame:
    """Rows of the first day."""
    first = df.agg(F.min(F.col(ts).cast("date")).alias("d")).scalar()
    return df.filter(F.col(ts).cast("date") == first)


def violations(
    performance: DataFrame, drift: DataFrame, performance_limits: Mapping[str, tuple[str, float]],
    drift_limits: Mapping[str, float], key: str = "window_start", allowed: int = 0,
) -> DataFrame:
    """Breached limits per window and whether to retrain.

    ``performance_limits``: metric -> ("min" or "max", bound); ``drift``: long
    rows (key, metric, value), turned wide by the metrics in ``drift_limits``.
    """
    wide = drift.groupBy(key).pivot("metric", list(drift_limits)).agg(F.max("value"))
    joined = performance.join(wide, key, "left")
    def one(broken: Column) -> Column:
        return F.when(broken, 1).otherwise(0)
    perf = F.lit(0)
    for metric, (side, bound) in performance_limits.items():
        perf = perf + one(F.col(metric) < bound if side == "min" else F.col(metric) > bound)
    moved = F.lit(0)
    for metric, bound in drift_limits.items():
        moved = moved + one(F.col(metric) > bound)
    return joined.select(
        key, perf.alias("performance_violations"), moved.alias("drift_violations"),
        (perf + moved > allowed).alias("retrain"))


def freshness_checks(df: DataFrame, ts: str, key: str, granularity: str = "day") -> DataFrame:
    """Rows, missing ids and repeated ids per window."""
    per_id = df.groupBy(F.date_trunc(granularity, ts).alias("window_start"), key).agg(F.count(F.lit(1)).alias("_n"))
    return per_id.groupBy("window_start").agg(
        F.sum("_n").alias("n"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_n"))), F.lit(0)).alias("null_ids"),
        F.count_if(F.col(key).isNotNull() & (F.col("_n") > 1)).alias("repeated_ids"))
