"""Near-duplicate embeddings: int8 quantised tile products with error bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernel import runs
from .links import local_roots, tile_pairs
from .scratch import Scratch, finish
from .spread import attach, components

TILE_ROWS = 1024


def unit_rows(flat: np.ndarray, dims: int) -> np.ndarray:
    """Rows of length one, in double precision; scaled by their largest part first so that squares stay finite."""
    x = flat.astype(np.float64).reshape(-1, dims)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Int8 codes, the scale of each row, and the exact length of what rounding left over."""
    scale = np.abs(x).max(axis=1) / 127.0
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    rest = np.linalg.norm(x - codes * scale[:, None], axis=1)
    return codes, scale, rest


def linked_pairs(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """All (i, j) with cosine >= threshold.

    With x = s q + e the product of two rows is s_x s_y (q_x . q_y) plus at most
    |e_x| |s_y q_y| + |s_x q_x| |e_y| + |e_x| |e_y| (Cauchy-Schwarz), so only
    pairs that reach the threshold with that bound added are computed in double
    precision. The integer products are carried by float32 matrix products,
    which are exact while dims * 127 * 127 < 2**24; wider rows are summed in
    pieces. A bound of 1e-9 covers the rounding of the scales.
    """
    (qx, sx, ex), (qy, sy, ey) = quantise(x), quantise(y)
    dot = np.zeros((len(x), len(y)), dtype=np.float64)
    for at in range(0, x.shape[1], 1024):
        dot += qx[:, at:at + 1024].astype(np.float32) @ qy[:, at:at + 1024].astype(np.float32).T
    nx, ny = sx * np.linalg.norm(qx.astype(np.float64), axis=1), sy * np.linalg.norm(qy.astype(np.float64), axis=1)
    dot *= sx[:, None]
    dot *= sy[None, :]
    dot += np.outer(ex, ny + ey)
    dot += np.outer(nx, ey)
    i, j = np.nonzero(dot >= threshold - 1e-9)
    true = np.empty(len(i), dtype=bool)
    for at in range(0, len(i), 1 << 16):
        part = slice(at, at + (1 << 16))
        true[part] = np.einsum("ij,ij->i", x[i[part]], y[j[part]]) >= threshold
    return i[true], j[true]


def near_embeddings(
    vectors: DataFrame, threshold: float = 0.98, tile_rows: int = TILE_ROWS,
    vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """Links between vectors of one label with cosine >= ``threshold``: vec_id, n_links, component_id, kept.

    Equal vectors of a label are one class with a count. The classes of a label
    and length are dealt into tiles of about ``tile_rows``, every two tiles meet
    in one task, and a task returns counts and links to local roots, no pairs.
    Tiles of a large label are spread over many tasks; their number grows with
    the square of the label, as counting every vector's links exactly demands.

    Vectors that are null, empty, zero or hold null or non-finite parts, and rows with a
    null label or id link with nothing: n_links 0, their own component. Vectors
    of different length link with nothing. Rows that repeat an id count as
    vectors of their own, but share the id's component. Empty tables give no rows.
    """
    scratch = Scratch(vectors.sparkSession)
    base = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"), F.col(label).alias("label"))
    fine = F.col("v").isNotNull() & F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists("v", lambda e: e != 0)
    good = base.filter(fine & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    # 0.0 and -0.0 are equal: adding 0 makes them one
    good = good.withColumn("v", F.transform("v", lambda e: e + F.lit(0.0))).withColumn("dims", F.size("v"))
    good = good.withColumn("label", F.xxhash64("label"))
    classes = good.groupBy("label", "dims", "v").agg(F.min("vec_id").alias("cid"), F.count(F.lit(1)).alias("copies"))
    classes = scratch.write(classes.withColumn("content", F.xxhash64("v")), "classes")

    tiles = classes.groupBy("label", "dims").agg(F.ceil(F.count(F.lit(1)) / tile_rows).cast("int").alias("tiles"))
    dealt = attach(classes, scratch.write(tiles, "tiles"), ["label", "dims"])
    own = F.pmod(F.xxhash64("content", F.lit(1)), F.col("tiles")).cast("int")
    dealt = dealt.withColumn("own", own).withColumn("pair", F.explode(tile_pairs(F.col("own"), F.col("tiles"))))
    dealt = dealt.select("label", "dims", F.col("pair.i").alias("i"), F.col("pair.j").alias("j"), "own", "cid", "content", "copies", "v")
    keys = ["label", "dims", "i", "j"]
    sorted_ = dealt.repartition(*keys).sortWithinPartitions(*keys)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, keys):
            i, j, dims = group["i"][0].as_py(), group["j"][0].as_py(), group["dims"][0].as_py()
            ids, content = group["cid"].to_numpy(), group["content"].to_numpy()
            copies, mine = group["copies"].to_numpy(), group["own"].to_numpy()
            x = unit_rows(group["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False), dims)
            left, right = np.flatnonzero(mine == i), np.flatnonzero(mine == j)
            a, b = linked_pairs(x[left], x[right], threshold)
            a, b = left[a], right[b]
            if i == j:
                a, b = a[a != b], b[a != b]
                n = np.bincount(a, weights=copies[b], minlength=len(ids))
            else:
                n = np.bincount(a, weights=copies[b], minlength=len(ids)) + np.bincount(b, weights=copies[a], minlength=len(ids))
            roots = local_roots(len(ids), a, b)
            hit = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({
                "cid": ids[hit], "label": group["label"].to_numpy()[hit], "content": content[hit], "n": n[hit].astype(np.int64), "root": ids[roots[hit]]})

    met = scratch.write(sorted_.mapInArrow(meet, "cid long, label long, content long, n long, root long"), "met")
    links = met.groupBy("cid", "label", "content").agg(F.sum("n").alias("n"))
    # copies of one class, and rows that share an id, are joined through the class's smallest id
    edges = met.select(F.col("cid").alias("a"), F.col("root").alias("b"))
    classed = good.select("vec_id", "label", "dims", "v").join(classes, ["label", "dims", "v"])
    classed = scratch.write(classed.select("vec_id", "label", "content", "cid", "copies"), "classed")
    edges = edges.unionByName(classed.select(F.col("vec_id").alias("a"), F.col("cid").alias("b")))
    roots = scratch.write(components(edges, scratch), "roots")

    counted = classed.join(links.select(F.col("cid").alias("l_cid"), F.col("label").alias("l_label"), F.col("content").alias("l_content"), "n"),
                           (F.col("cid") == F.col("l_cid")) & (F.col("label") == F.col("l_label")) & (F.col("content") == F.col("l_content")), "left")
    counted = counted.select("vec_id", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).cast("long").alias("n_links"))
    rest = base.filter(~(fine & F.col("label").isNotNull() & F.col("vec_id").isNotNull()) | fine.isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"))
    out = counted.unionByName(rest).join(roots, F.col("vec_id") == F.col("node"), "left")
    component = F.coalesce("root", "vec_id")
    out = out.select("vec_id", "n_links", component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
    return finish(scratch, out, "links")
