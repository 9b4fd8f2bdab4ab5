"""Functions callable by name from SQL."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def register_sql_function(spark: SparkSession, name: str, arguments: Mapping[str, str], returns: str, body: str, comment: str = "") -> None:
    """A scalar SQL function. Argument types may carry a default: ``"INT DEFAULT 3"``."""
    args = ", ".join(f"{n} {t}" for n, t in arguments.items())
    note = f" COMMENT '{comment.replace(chr(39), chr(39) * 2)}'" if comment else ""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {returns}{note} RETURN {body}")


def register_table_function(spark: SparkSession, name: str, arguments: Mapping[str, str], returns: str, query: str) -> None:
    """A parameterised lookup that returns rows; Spark inlines it into the calling query."""
    args = ", ".join(f"{n} {t}" for n, t in arguments.items())
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS TABLE({returns}) RETURN {query}")


def register_python_function(spark: SparkSession, name: str, fn: Callable, returns: str) -> None:
    """A Python scalar function for SQL, exchanged in Arrow batches. Prefer an expression where one exists."""
    spark.udf.register(name, F.udf(fn, returns, useArrow=True))


def register_pandas_function(spark: SparkSession, name: str, fn: Callable[[pd.Series], pd.Series], returns: str) -> None:
    """A vectorised one-column function for SQL."""

    def batch(s: pd.Series) -> pd.Series:
        return fn(s)

    spark.udf.register(name, F.pandas_udf(batch, returns))


def with_setup(setup: Callable[[], Callable[[pd.Series], pd.Series]], returns: str):
    """A vectorised function whose setup (loading a model) runs once per Python worker task."""

    @F.pandas_udf(returns)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        apply = setup()
        for s in batches:
            yield apply(s)

    return run


def struct_function(fn: Callable[..., pd.DataFrame], returns: str, *columns: str) -> Column:
    """Several columns in, a struct out, in Arrow batches."""

    def call(packed: pd.DataFrame) -> pd.DataFrame:
        return fn(*[packed[c] for c in packed.columns])

    call.__annotations__ = {"packed": pd.DataFrame, "return": pd.DataFrame}
    return F.pandas_udf(call, returns)(F.struct(*columns))


def per_group(df: DataFrame, keys: list[str], fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """A pandas function per group. The caller must know that a group is small."""
    return df.groupBy(*keys).applyInPandas(fn, schema)


def per_partition(df: DataFrame, fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    return df.mapInPandas(fn, schema)


def register_linear_model(spark: SparkSession, name: str, weights: Mapping[str, float], intercept: float = 0.0, logistic: bool = True) -> None:
    """A linear model as a SQL function of its features, in order: stays in the JVM."""
    total = " + ".join([repr(float(intercept)), *[f"{w!r} * {c}" for c, w in ((c, float(w)) for c, w in weights.items())]])
    body = f"1 / (1 + exp(-({total})))" if logistic else total
    register_sql_function(spark, name, {c: "DOUBLE" for c in weights}, "DOUBLE", body)


def linear_weights(model: PipelineModel, features: list[str]) -> tuple[dict[str, float], float]:
    """Weights of a fitted linear pipeline (numeric features only) on the unscaled features."""
    scaler, learner = model.stages[-2], model.stages[-1]
    scale = [s if s else 1.0 for s in scaler.std.toArray()]
    return {f: float(w / s) for f, w, s in zip(features, learner.coefficients.toArray(), scale)}, float(learner.intercept)
