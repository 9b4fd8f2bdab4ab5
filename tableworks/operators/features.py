"""Feature tables, training sets, model scoring and comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import BATCH, append_batch, read_log
from .clean import hash_share
from .joins import join_asof
from .windows import latest_per_key


# ---- feature tables -------------------------------------------------------

def unique_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows; a repeated key stops the job."""
    rest = [c for c in df.columns if c not in keys]
    one = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*rest)).alias("_row"))
    guarded = F.when(F.col("_n") > 1, F.raise_error(F.lit(f"feature key {list(keys)} repeats"))).otherwise(F.col("_row"))
    return one.select(*keys, guarded.alias("_row")).select(*keys, "_row.*").select(*df.columns)


WRITTEN = "_written"


def write_features(df: DataFrame, path: str, keys: Sequence[str], version: int, ts: str | None = None, mode: str = "merge") -> None:
    """Store features under their primary key (plus time key).

    ``merge`` updates and inserts: the rows are appended to a log with the
    names of their columns, so a write may add columns and leaves those it
    lacks as they are. ``overwrite`` replaces all rows. ``version`` numbers the
    write, later ones higher: repeating it is harmless. A table that is
    overwritten with rows read from itself is materialised before.
    """
    checked = unique_rows(df, [*keys, *([ts] if ts else [])])
    marked = checked.withColumn(WRITTEN, F.array(*[F.lit(c) for c in df.columns]))
    if mode == "overwrite":
        marked.withColumn(BATCH, F.lit(version).cast("long")).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").partitionBy(BATCH).parquet(path)
        return
    append_batch(marked, version, path)


def read_features(spark: SparkSession, path: str, keys: Sequence[str], ts: str | None = None) -> DataFrame:
    """The newest value of every feature per key: one aggregate over the log, a column counts only where it was written."""
    log = read_log(spark, path)
    full = [*keys, *([ts] if ts else [])]
    rest = [c for c in log.columns if c not in (*full, WRITTEN, BATCH)]
    newest = [
        F.max_by(F.struct(F.col(c)), F.when(F.array_contains(WRITTEN, c), F.col(BATCH))).getField(c).alias(c) for c in rest
    ]
    if not rest:
        return log.select(*full).distinct()
    return log.groupBy(*full).agg(*newest)


def write_features_stream(stream: DataFrame, path: str, keys: Sequence[str], checkpoint: str, ts: str | None = None) -> None:
    """Merge a feature stream batch by batch and stop when it is caught up."""
    (
        stream.writeStream.foreachBatch(lambda b, i: write_features(b, path, keys, i, ts))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    )


@dataclass
class Lookup:
    """Features to attach: ``keys`` maps label column -> feature column."""

    table: DataFrame
    keys: Mapping[str, str]
    features: Sequence[str]
    label_ts: str | None = None
    feature_ts: str | None = None
    tie: str | None = None
    lookback_seconds: int | None = None
    rename: Mapping[str, str] = field(default_factory=dict)


def training_set(labels: DataFrame, lookups: Sequence[Lookup], functions: Mapping[str, str] | None = None,
                 exclude: Sequence[str] = ()) -> DataFrame:
    """Labels with looked-up features (plain or point-in-time) and on-demand expressions."""
    out = labels
    for item in lookups:
        names = {f: item.rename.get(f, f) for f in item.features}
        if item.feature_ts is None:
            right = item.table.select(*[F.col(v).alias(f"_k_{k}") for k, v in item.keys.items()],
                                      *[F.col(f).alias(n) for f, n in names.items()])
            cond = F.lit(True)
            for k in item.keys:
                cond = cond & (F.col(k) == F.col(f"_k_{k}"))
            out = out.join(right, cond, "left").drop(*[f"_k_{k}" for k in item.keys])
        else:
            right = item.table.select(*[F.col(v).alias(k) for k, v in item.keys.items()], F.col(item.feature_ts).alias("_fts"),
                                      *([F.col(item.tie).alias("_ftie")] if item.tie else []),
                                      *[F.col(f).alias(n) for f, n in names.items()])
            out = join_asof(out, right, list(item.keys), item.label_ts, "_fts", list(names.values()),
                            tie="_ftie" if item.tie else None, lookback_seconds=item.lookback_seconds).drop("_fts")
    for name, expression in (functions or {}).items():
        out = out.withColumn(name, F.expr(expression))
    return out.drop(*exclude)


def feature_function(expression: str, bindings: Mapping[str, str]) -> Column:
    """An on-demand feature: ``{name}`` in the expression stands for a bound column."""
    return F.expr(expression.format(**{n: f"`{c}`" for n, c in bindings.items()}))


def build_label(df: DataFrame, condition: str, out: str = "label", unknown: object = None) -> DataFrame:
    """1 or 0 by condition; ``unknown`` where it cannot be decided."""
    hit = F.expr(condition)
    return df.withColumn(out, F.when(hit, 1).when(~hit, 0).otherwise(F.lit(unknown).cast("int")))


def assemble_training(features: DataFrame, labels: DataFrame, key: Sequence[str], drop: Sequence[str] = ()) -> DataFrame:
    """Features joined to labels, personal columns removed."""
    return features.join(labels, list(key)).drop(*drop)


# ---- models ---------------------------------------------------------------

def train_classifier(df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str] = (), weight: str | None = None,
                     kind: str = "logistic", grid: Mapping[str, Sequence[object]] | None = None, folds: int = 3, seed: int = 42) -> PipelineModel:
    """Impute, encode, scale and fit, all distributed; with ``grid`` by cross validation."""
    filled = [f"_f_{c}" for c in numeric]
    stages = [Imputer(inputCols=list(numeric), outputCols=filled, strategy="median")]
    encoded = []
    if categorical:
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=[f"_i_{c}" for c in categorical], handleInvalid="keep"))
        encoded = [f"_o_{c}" for c in categorical]
        stages.append(OneHotEncoder(inputCols=[f"_i_{c}" for c in categorical], outputCols=encoded, handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=[*filled, *encoded], outputCol="_raw"))
    stages.append(StandardScaler(inputCol="_raw", outputCol="features", withMean=False))
    if kind == "logistic":
        learner = LogisticRegression(featuresCol="features", labelCol=label, maxIter=20)
    elif kind == "boosted":
        learner = GBTClassifier(featuresCol="features", labelCol=label, maxIter=20, seed=seed)
    else:
        raise ValueError(f"unknown kind {kind!r}")
    if weight:
        learner = learner.setWeightCol(weight)
    pipe = Pipeline(stages=[*stages, learner])
    typed = df.withColumns({c: F.col(c).cast("double") for c in (*numeric, label)})
    if not grid:
        return pipe.fit(typed)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(learner.getParam(name), list(values))
    search = CrossValidator(estimator=pipe, estimatorParamMaps=builder.build(), numFolds=folds, seed=seed,
                            evaluator=BinaryClassificationEvaluator(labelCol=label))
    return search.fit(typed).bestModel


def score_batch(df: DataFrame, model: PipelineModel, numeric: Sequence[str], keep: Sequence[str], version: str, alias: str, scored_at: str) -> DataFrame:
    """Predictions next to the ids, with the model's version, alias and scoring time."""
    out = model.transform(df.withColumns({c: F.col(c).cast("double") for c in numeric}))
    return out.select(
        *keep, F.col("prediction"), F.get(vector_to_array("probability"), F.lit(1)).alias("score"),
        F.lit(version).alias("model_version"), F.lit(alias).alias("model_alias"), F.lit(scored_at).cast("timestamp").alias("scored_at"))


def score_latest(df: DataFrame, metadata: DataFrame, model: PipelineModel, key: str, order: Sequence[str], numeric: Sequence[str], version: str, scored_at: str) -> DataFrame:
    """The newest row per key, joined to its metadata, scored."""
    newest = latest_per_key(df, [key], order).join(metadata, key)
    return score_batch(newest, model, numeric, [key], version, "latest", scored_at)


def compare_models(df: DataFrame, label: str, predictions: Mapping[str, str], costs: Mapping[str, float]) -> DataFrame:
    """Confusion counts, F1 and money value per model; ``promote`` when F1 is not worse than the first model's.

    ``predictions``: model -> 0/1 column; ``costs``: value of tp, fp, fn, tn.
    All models are counted in one pass.
    """
    rows = []
    for name, column in predictions.items():
        y, p = F.col(label) == 1, F.col(column) == 1
        rows.append(F.struct(
            F.lit(name).alias("model"), F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
            F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn")))
    counts = df.agg(F.array(*rows).alias("_r")).select(F.inline("_r"))
    value = sum((F.col(c) * F.lit(float(v)) for c, v in costs.items()), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2.0 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0))
    out = counts.withColumns({"f1": f1, "value": value})
    champion = out.filter(F.col("model") == next(iter(predictions))).select("f1").scalar()
    return out.withColumn("promote", F.col("f1") >= champion)


def traffic_split(df: DataFrame, keys: Sequence[str], shares: Mapping[str, float], seed: int = 42, out: str = "variant") -> DataFrame:
    """A fixed variant per key: shares of a hash, so the same key always gets the same one."""
    share = hash_share(keys, seed)
    total, edge, value = float(sum(shares.values())), 0.0, None
    names = list(shares)
    for name in names[:-1]:
        edge += shares[name] / total
        value = F.when(share < edge, name) if value is None else value.when(share < edge, name)
    return df.withColumn(out, value.otherwise(names[-1]) if value is not None else F.lit(names[-1]))


def explain_linear(df: DataFrame, coefficients: Mapping[str, float], keep: Sequence[str]) -> DataFrame:
    """Contribution of each feature per row: coefficient x (value - mean), means in one pass."""
    means = df.agg(*[F.avg(c).alias(c) for c in coefficients])
    return df.select(*keep, *[
        (F.lit(float(w)) * (F.col(c) - means.select(c).scalar())).alias(f"contribution_{c}") for c, w in coefficients.items()
    ])


def mean_importance(contributions: DataFrame, prefix: str = "contribution_") -> DataFrame:
    """Mean absolute contribution per feature."""
    names = [c for c in contributions.columns if c.startswith(prefix)]
    rows = [F.struct(F.lit(c[len(prefix):]).alias("feature"), F.avg(F.abs(F.col(c))).alias("importance")) for c in names]
    return contributions.agg(F.array(*rows).alias("_r")).select(F.inline("_r"))


def fairness_gap(df: DataFrame, group: str, outputs: Sequence[str]) -> DataFrame:
    """Demographic parity difference: largest minus smallest group mean of each output."""
    per = df.groupBy(group).agg(*[F.avg(c).alias(c) for c in outputs])
    rows = [F.struct(F.lit(c).alias("output"), (F.max(c) - F.min(c)).alias("gap")) for c in outputs]
    return per.agg(F.array(*rows).alias("_r")).select(F.inline("_r"))
