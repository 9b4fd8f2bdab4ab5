"""Per-group forecasts of daily series."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .aggregate import multi_level_totals
from .joins import join_range


def prepare_series(usage: DataFrame, prices: DataFrame | None, keys: Sequence[str], dims: Sequence[str], day: str, quantity: str,
                   price: str | None = None, start: str | None = None, stop: str | None = None,
                   active_since: str | None = None, cap_factor: float = 1.2) -> DataFrame:
    """Priced usage as daily sums per dimension, with 'ALL' levels and a cap column.

    Prices hold over intervals; dimensions without usage since ``active_since``
    are left out. Returns ds, the dimensions, y, quantity, cap.
    """
    priced = usage
    amount = F.col(quantity)
    if prices is not None:
        priced = join_range(usage, prices, keys, day, start, stop)
        amount = F.col(quantity) * F.col(price)
    daily = priced.groupBy(F.col(day).cast("date").alias("ds"), *dims).agg(
        F.sum(amount).alias("y"), F.sum(quantity).alias("quantity"))
    # from here on: at most days x groups rows
    levels = [["ds", *[d for i, d in enumerate(dims) if mask >> i & 1]] for mask in range(2 ** len(dims))]
    totals = multi_level_totals(daily, ["ds", *dims], {"y": F.sum("y"), "quantity": F.sum("quantity")}, levels)
    totals = totals.withColumn("ds", F.col("ds").cast("date"))
    if active_since:
        recent = totals.filter(F.col("ds") >= F.lit(active_since).cast("date")).select(*dims).distinct()
        totals = totals.join(recent, list(dims), "left_semi")
    top = totals.groupBy(*dims).agg((F.max("y") * cap_factor).alias("cap"))
    return totals.join(top, list(dims)).select("ds", *dims, "y", "quantity", "cap")


def fit_series(days: np.ndarray, y: np.ndarray, horizon: int, level: float) -> tuple[np.ndarray, np.ndarray]:
    """Least squares on trend and day of week; returns the fit with its horizon and the residual band."""
    last = int(days.max())
    grid = np.arange(int(days.min()), last + horizon + 1)
    origin, span = float(days.min()), max(1.0, float(last - days.min()))

    def design(d: np.ndarray) -> np.ndarray:
        # one column per weekday (their sum is the intercept) and the trend
        return np.column_stack([(d - origin) / span, *[(d % 7 == w).astype(float) for w in range(7)]])

    coef, *_ = np.linalg.lstsq(design(days.astype(float)), y, rcond=None)
    residual = np.abs(y - design(days.astype(float)) @ coef)
    return design(grid.astype(float)) @ coef, np.quantile(residual, level)


def forecast_groups(series: DataFrame, keys: Sequence[str], ds: str = "ds", y: str = "y", horizon: int = 93,
                    level: float = 0.8, shortest: int = 10) -> DataFrame:
    """One small model per group, groups in parallel; adds ``horizon`` days.

    The input has one row per group and day, so a group is bounded by its days.
    Series of ``shortest`` points or fewer are returned as they are.
    """
    kinds = {f.name: f.dataType.simpleString() for f in series.schema}
    schema = ", ".join([f"`{k}` {kinds[k]}" for k in keys] + [f"`{ds}` date", f"`{y}` double", "yhat double", "yhat_lower double", "yhat_upper double"])

    def model(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.dropna(subset=[y]).sort_values(ds)
        values = pdf[y].to_numpy(dtype=float)
        stamps = pd.to_datetime(pdf[ds])
        if len(pdf) <= shortest:
            out = pd.DataFrame({ds: stamps.dt.date, y: values, "yhat": values, "yhat_lower": values, "yhat_upper": values})
        else:
            days = (stamps - pd.Timestamp("1970-01-01")).dt.days.to_numpy()
            fit, band = fit_series(days, values, horizon, level)
            first = int(days.min())
            grid = np.arange(first, first + len(fit))
            known = dict(zip(days.tolist(), values.tolist()))
            out = pd.DataFrame({
                ds: (pd.Timestamp("1970-01-01") + pd.to_timedelta(grid, unit="D")).date,
                y: [known.get(int(d), np.nan) for d in grid],
                "yhat": fit, "yhat_lower": fit - band, "yhat_upper": fit + band,
            })
            # a day missing inside the history is not forecast
            out = out[[int(d) in known or int(d) > int(days.max()) for d in grid]]
        for i, k in enumerate(keys):
            out.insert(i, k, key[i])
        return out

    picked = series.select(*keys, F.col(ds).cast("date").alias(ds), F.col(y).cast("double").alias(y))
    return picked.groupBy(*keys).applyInPandas(model, schema)


def assemble_forecast(forecast: DataFrame, keys: Sequence[str], ds: str = "ds", y: str = "y", reach: int = 7) -> DataFrame:
    """Past and future in one table: not below 0, flagged, with smoothed bands.

    Days without a known value are predictions. The window runs over the days
    of one group.
    """
    zero = F.lit(0.0)
    past = forecast.select(*keys, ds, F.col(y).alias("value"), F.greatest("yhat_lower", zero).alias("lower"),
                           F.greatest("yhat_upper", zero).alias("upper"), F.lit(False).alias("is_prediction")).filter("value IS NOT NULL")
    ahead = forecast.filter(F.col(y).isNull() | F.isnan(y)).select(
        *keys, ds, F.greatest("yhat", zero).alias("value"), F.greatest("yhat_lower", zero).alias("lower"),
        F.greatest("yhat_upper", zero).alias("upper"), F.lit(True).alias("is_prediction"))
    both = past.filter(~F.isnan("value")).unionByName(ahead)
    w = Window.partitionBy(*keys).orderBy(ds).rowsBetween(-reach, reach)
    return both.withColumns({"lower_smooth": F.avg("lower").over(w), "upper_smooth": F.avg("upper").over(w)})


def top_series(table: DataFrame, keys: Sequence[str], value: str, ds: str, since: str, k: int = 5, exclude: Column | None = None) -> DataFrame:
    """Rows since a date of the k groups with the largest total."""
    recent = table.filter(F.col(ds) >= F.lit(since).cast("date"))
    ranked = recent if exclude is None else recent.filter(~exclude)
    best = ranked.groupBy(*keys).agg(F.sum(value).alias("_t")).orderBy(F.desc("_t"), *keys).limit(k)
    return recent.join(best.select(*keys), list(keys), "left_semi")
