"""Nearest vectors: an exact scan for few queries, an inverted-file index for many."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise
from .windows import top_k_per_group

# queries multiplied at once inside a task: with a full tile their scores take 8 MB
QUERY_ROWS = 64
# rows of a cell, and queries at a cell, that meet in one task
CELL_ROWS, CELL_QUERIES = 16_384, 4_096


def vector_top_k(
    queries: DataFrame, base: DataFrame, query_id: str, base_id: str, vector: str, k: int, metric: str = "cosine",
    max_query_mb: int = 4,
) -> DataFrame:
    """Exact k nearest ``base`` rows per query row (cosine, dot, or l2 similarity).

    Up to ``max_query_mb`` of queries (their size is checked) travel to the
    tasks: the base is read where it lies, each task multiplies its batches with
    the query matrix and keeps k rows per query, so only k x queries rows per
    task are shuffled. More queries stay distributed and meet the base in tiles
    (``_meet``), each row of either side once per slice of the other.
    """
    _known(metric)
    size = queries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vector)).alias("d")).first()
    if size.n * (size.d or 0) * 4 <= max_query_mb << 20:
        found = _scan(queries, base, query_id, base_id, vector, k, metric)
        return top_k_per_group(found, [query_id], [F.desc("score"), F.asc(base_id)], k)
    one = F.lit(0).alias("cell")
    q = queries.select(F.col(query_id).alias("q"), F.col(vector).alias("v"), one)
    b = base.select(F.col(base_id).alias("b"), F.col(vector).alias("v"), one)
    return _ranked(_meet(q, b, k, metric), query_id, base_id, k)


def _known(metric: str) -> None:
    if metric not in ("cosine", "dot", "l2"):
        raise ValueError(f"unknown metric {metric!r}")


def _scan(queries: DataFrame, base: DataFrame, query_id: str, base_id: str, vector: str, k: int, metric: str) -> DataFrame:
    spark = base.sparkSession
    rows = queries.select(query_id, vector).toArrow().to_pylist()  # bounded by ``max_query_mb``
    ids = [r[query_id] for r in rows]
    matrix = np.array([r[vector] for r in rows], dtype=np.float64).reshape(len(rows), -1)
    shared = spark.sparkContext.broadcast((ids, _unit(matrix) if metric == "cosine" else matrix))
    schema = T.StructType([
        T.StructField(query_id, queries.schema[query_id].dataType),
        T.StructField(base_id, base.schema[base_id].dataType),
        T.StructField("score", T.DoubleType()),
    ])

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, q = shared.value
        best: list[tuple[np.ndarray, np.ndarray]] | None = None
        for pdf in batches:
            if not len(pdf) or not len(names):
                continue
            x = np.stack(pdf["v"].to_numpy()).astype(np.float64)
            if metric == "cosine":
                x = _unit(x)
            keys = pdf["b"].to_numpy()
            if best is None:
                best = [(np.empty(0), keys[:0])] * len(names)
            for start in range(0, len(names), QUERY_ROWS):
                scores = _scores(q[start:start + QUERY_ROWS], x, metric)
                for i, row in enumerate(scores, start):
                    best[i] = _merge_top(best[i], row, keys, k)
        if best is not None:
            for name, (s, b) in zip(names, best):
                yield pd.DataFrame({query_id: [name] * len(s), base_id: b, "score": s})

    picked = base.select(F.col(base_id).alias("b"), F.col(vector).alias("v")).filter("v IS NOT NULL")
    return picked.mapInPandas(scan, schema)


def _scores(q: np.ndarray, x: np.ndarray, metric: str, squares: np.ndarray | None = None) -> np.ndarray:
    """All scores of ``q`` and ``x``, in one array of their size; ``squares`` are the squared lengths of ``x`` if they are known."""
    out = q @ x.T
    if metric != "l2":
        return out
    out *= -2
    out += (q**2).sum(1)[:, None]
    out += ((x**2).sum(1) if squares is None else squares)[None, :]
    np.maximum(out, 0.0, out=out)
    return np.negative(np.sqrt(out, out=out), out=out)


def _merge_top(best: tuple[np.ndarray, np.ndarray], scores: np.ndarray, keys: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of those kept and a new batch; ties go to the smaller id, as in the final ranking."""
    worst = best[0][-1] if len(best[0]) == k else -np.inf
    if len(scores) > k:
        worst = max(worst, np.partition(scores, len(scores) - k)[len(scores) - k])
    fresh = np.flatnonzero(scores >= worst)
    s = np.concatenate([best[0], scores[fresh]])
    b = np.concatenate([best[1], keys[fresh]])
    top = np.lexsort((b, -s))[:k]
    return s[top], b[top]


def _unit(m: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, length, out=np.zeros_like(m), where=length > 0)


def _ranked(found: DataFrame, query_id: str, base_id: str, k: int) -> DataFrame:
    named = found.select(F.col("q").alias(query_id), F.col("b").alias(base_id), "score")
    return top_k_per_group(named, [query_id], [F.desc("score"), F.asc(base_id)], k)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy().astype(np.float64, copy=False).reshape(len(column), -1)


def _meet(queries: DataFrame, base: DataFrame, k: int, metric: str) -> DataFrame:
    """Per query (q, v, cell) the k best base rows (b, v, cell) of the same cell, found in tiles.

    Both sides of a cell are cut into slices by id, as many as its counted rows
    need, and every slice of queries meets every slice of rows by an equi join
    on (cell, slice, slice). A large cell or a crowd of queries at one cell is
    spread over tasks, and a task holds one tile whatever the tables' sizes.
    """
    queries, base = queries.filter("v IS NOT NULL"), base.filter("v IS NOT NULL")
    rows = base.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / CELL_ROWS).cast("int").alias("row_slices"))
    asks = queries.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / CELL_QUERIES).cast("int").alias("query_slices"))
    sizes = materialise(rows.join(asks, "cell"), "cells")  # one row per cell

    def dealt(side: DataFrame, own: str, other: str, key: str) -> DataFrame:
        each = F.explode(F.sequence(F.lit(0), F.col(f"{other}_slices") - 1))
        mine = F.pmod(F.xxhash64(key), F.col(f"{own}_slices")).cast("int")
        return side.join(sizes, "cell").select("cell", mine.alias(f"{own}_slice"), each.alias(f"{other}_slice"), key, F.col("v").cast("array<double>").alias("v"))

    q, b = dealt(queries, "query", "row", "q"), dealt(base, "row", "query", "b")
    schema = T.StructType([T.StructField("q", queries.schema["q"].dataType), T.StructField("b", base.schema["b"].dataType), T.StructField("score", T.DoubleType())])
    by = ["cell", "row_slice", "query_slice"]

    def tile(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not asked.num_rows or not held.num_rows:
            return pa.table({"q": asked["q"].slice(0, 0), "b": held["b"].slice(0, 0), "score": pa.array([], pa.float64())})
        x, y = _matrix(asked["v"]), _matrix(held["v"])
        if metric == "cosine":
            x, y = _unit(x), _unit(y)
        keys = np.array(held["b"].to_pylist())
        squares = (y**2).sum(1)
        at, ids, scores = [], [], []
        for start in range(0, len(x), QUERY_ROWS):
            for i, row in enumerate(_scores(x[start:start + QUERY_ROWS], y, metric, squares), start):
                s, found = _merge_top((np.empty(0), keys[:0]), row, keys, k)
                at.append(np.full(len(s), i))
                ids.append(found)
                scores.append(s)
        return pa.table({"q": asked["q"].combine_chunks().take(pa.array(np.concatenate(at))), "b": pa.array(np.concatenate(ids), held["b"].type), "score": np.concatenate(scores)})

    return q.groupBy(*by).cogroup(b.groupBy(*by)).applyInArrow(tile, schema)


@dataclass
class VectorIndex:
    """Base rows (b, v) in the lists of their nearest centres (cell), and the largest distance to each centre in its list (``radii``)."""

    rows: DataFrame
    base_id: str
    metric: str
    centres: np.ndarray
    radii: np.ndarray

    def search(self, queries: DataFrame, query_id: str, vector: str, k: int, probes: int = 8, exact: bool = False) -> DataFrame:
        """k nearest base rows per query: query_id, base_id, score, rank.

        Queries stay distributed. Each goes to its ``probes`` nearest cells by
        an equi join, and rows are scored in full precision there, so only the
        choice of cells is approximate. With ``exact`` a second step visits every further cell that may
        hold a nearer row by the triangle inequality: its centre's distance
        less its radius is within the k-th distance found. Null vectors find
        and are found by nothing.
        """
        asked = queries.select(F.col(query_id).alias("q"), F.col(vector).cast("array<double>").alias("v")).filter("v IS NOT NULL")
        asked = materialise(asked.withColumn("near", _nearest(asked, self.centres, self.metric, probes)), "asked")
        first = _meet(asked.select("q", "v", F.explode("near").alias("cell")), self.rows, k, self.metric)
        if not exact or not len(self.centres):
            return _ranked(first, query_id, self.base_id, k)
        first = materialise(top_k_per_group(first, ["q"], [F.desc("score"), F.asc("b")], k).select("q", "b", "score"), "found")
        reach = first.groupBy("q").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("worst"))
        wider = asked.join(reach, "q", "left")
        wider = wider.withColumn("more", F.array_except(_within(wider, self.centres, self.radii, self.metric), "near"))
        second = _meet(wider.select("q", "v", F.explode("more").alias("cell")), self.rows, k, self.metric)
        return _ranked(first.unionByName(second), query_id, self.base_id, k)


def _points(vectors: pd.Series, metric: str) -> np.ndarray:
    x = np.stack(vectors.to_numpy()).astype(np.float64)
    return _unit(x) if metric == "cosine" else x


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return -_scores(x, centres, "l2")


def _nearest(df: DataFrame, centres: np.ndarray, metric: str, n: int) -> Column:
    """The ``n`` nearest cells of each vector; the one cell there is where nothing was clustered."""
    if not len(centres):
        return F.array(F.lit(0))
    shared = df.sparkSession.sparkContext.broadcast(centres)  # bounded by ``cells``

    @F.pandas_udf("array<int>")
    def near(vectors: pd.Series) -> pd.Series:
        d = _distances(_points(vectors, metric), shared.value) if len(vectors) else np.empty((0, 1))
        return pd.Series(list(np.argsort(d, axis=1, kind="stable")[:, :n].astype(np.int32)))

    return near("v")


def _within(df: DataFrame, centres: np.ndarray, radii: np.ndarray, metric: str) -> Column:
    """All cells that may hold a row as near as ``worst`` (a score; null: any row)."""
    shared = df.sparkSession.sparkContext.broadcast((centres, radii))

    @F.pandas_udf("array<int>")
    def cells(vectors: pd.Series, worst: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=object)
        centres, radii = shared.value
        score = worst.to_numpy(dtype=np.float64)
        # for unit vectors the squared distance is 2 - 2 x cosine
        limit = np.sqrt(np.maximum(2 - 2 * score, 0)) if metric == "cosine" else -score
        limit = np.where(np.isnan(limit), np.inf, limit)
        least = _distances(_points(vectors, metric), centres) - radii[None, :]
        slack = 1e-6 * (1 + np.abs(least))  # rounding of the distances above
        return pd.Series([np.flatnonzero(row).astype(np.int32) for row in least - slack <= limit[:, None]])

    return cells("v", "worst")


def build_vector_index(
    base: DataFrame, base_id: str, vector: str, cells: int = 64, metric: str = "l2", sample_rows: int = 20_000, rounds: int = 10, seed: int = 42,
) -> VectorIndex:
    """An inverted-file index over every row of ``base``.

    The ``cells`` centres are fitted by k-means on at most ``sample_rows`` rows
    (those of the smallest id hashes, about); then each row, sampled or not,
    goes to the list of its nearest centre. For cosine the vectors' directions
    are clustered. Rows with a null vector are in no list. Larger tables want
    more cells: about the square root of the rows.
    """
    if metric not in ("cosine", "l2"):
        raise ValueError(f"no index for the metric {metric!r}")
    held = base.select(F.col(base_id).alias("b"), F.col(vector).cast("array<double>").alias("v")).filter("v IS NOT NULL")
    total = held.count()
    share = min(1.0, sample_rows / max(total, 1))
    drawn = held.filter(F.pmod(F.xxhash64("b"), F.lit(1_000_000)) < int(share * 1_000_000) + 1).limit(sample_rows)
    point = F.col("v")
    if metric == "cosine":
        length = F.sqrt(F.aggregate(point, F.lit(0.0), lambda a, x: a + x * x))
        point = F.transform(point, lambda x: x / F.when(length > 0, length).otherwise(1.0))
    drawn = materialise(drawn.select(point.alias("v")), "sample")
    different = drawn.distinct().limit(cells).count()
    if different > 1:
        points = drawn.select(array_to_vector("v").alias("point"))
        centres = np.array(KMeans(featuresCol="point", k=min(cells, different), maxIter=rounds, seed=seed).fit(points).clusterCenters())
    else:
        centres = np.zeros((0, 1))  # nothing to cluster: one list
    rows = materialise(held.withColumn("cell", F.get(_nearest(held, centres, metric, 1), F.lit(0))), "index")
    if not len(centres):
        return VectorIndex(rows, base_id, metric, centres, np.empty(0))
    shared = base.sparkSession.sparkContext.broadcast(centres)

    @F.pandas_udf("double")
    def off(vectors: pd.Series, cell: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=float)
        return pd.Series(np.linalg.norm(_points(vectors, metric) - shared.value[cell.to_numpy()], axis=1))

    far = rows.select("cell", off("v", "cell").alias("r")).groupBy("cell").agg(F.max("r").alias("r")).toPandas()  # a row per cell
    radii = np.full(len(centres), -np.inf)
    radii[far["cell"].to_numpy(dtype=int)] = far["r"].to_numpy()
    return VectorIndex(rows, base_id, metric, centres, radii)


def vector_near(
    queries: DataFrame, base: DataFrame, query_id: str, base_id: str, vector: str, k: int, threshold: float | None = None,
    metric: str = "l2", cells: int = 64, probes: int = 8, exact: bool = False,
) -> DataFrame:
    """Index ``base`` and search it once: up to k rows per query, within a Euclidean ``threshold`` if one is given."""
    found = build_vector_index(base, base_id, vector, cells, metric).search(queries, query_id, vector, k, probes, exact)
    if threshold is None:
        return found
    return found.filter(F.col("score") >= (-threshold if metric == "l2" else 1 - threshold * threshold / 2))
