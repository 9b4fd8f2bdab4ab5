"""Near-duplicate texts: MinHash with tensored banding, candidates verified on whole shingle sets."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .kernel import mix, runs, shingle_sets, slices, words
from .links import local_roots, tile_pairs
from .scratch import Scratch, finish
from .spread import apart, attach, by_key, components, wide

# Shingles of one tile: about so many are compared with as many in one task.
TILE_SHINGLES = 400_000
TILE_ROWS = 1024
# Shared shingles counted at once: columns of a dense 0/1 matrix.
COLUMNS = 2048


def collections_for(similarity: float, rows: int, miss: float) -> int:
    """Hashes per side so that a pair of that similarity shares no table with a chance below ``miss``.

    A pair meets in a table (i, j) if the i-th value of the first and the j-th
    of the second collection agree, so it is missed if all of one side differ:
    at most 2 (1 - s^rows)^m.
    """
    if similarity >= 1:
        return 1
    return max(1, math.ceil(math.log(miss / 2) / math.log(1 - similarity**rows)))


def _seeds(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(7))
    return rng.integers(1, 2**63, count, dtype=np.uint64) | np.uint64(1), rng.integers(0, 2**63, count, dtype=np.uint64)


def minhashes(flat: np.ndarray, starts: np.ndarray, mul: np.ndarray, add: np.ndarray) -> np.ndarray:
    """The minimum of each hash over each set; one row per hash, sets are not empty."""
    out = np.empty((len(mul), len(starts)), dtype=np.uint64)
    h = np.empty_like(flat)
    for i in range(len(mul)):
        np.multiply(flat, mul[i], out=h)
        h += add[i]
        h ^= h >> np.uint64(32)
        out[i] = np.minimum.reduceat(h, starts)
    return out


@contextmanager
def _bloom(spark: SparkSession):
    """Spark's own runtime filter for joins at any size; the filter itself is bounded (8 MB by default).

    Spark makes none for a join with a side that it takes for small enough to be broadcast, so no side is.
    """
    names = {f"spark.sql.optimizer.runtime.bloomFilter.{k}": v for k, v in (("applicationSideScanSizeThreshold", "0"), ("creationSideThreshold", "1g"))}
    names["spark.sql.autoBroadcastJoinThreshold"] = "-1"
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    try:
        yield
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def near_duplicates(
    docs: DataFrame, shingle: int = 5, similarity: float = 0.8, rows: int = 2, miss: float = 2e-5,
    doc_id: str = "doc_id", text: str = "text", content: bool = False,
) -> DataFrame:
    """Documents linked by shingle sets with Jaccard >= ``similarity``: doc_id, n_shingles, component_id, kept.

    1. Whole texts become sets of word shingles (64-bit hashes) and two small
       collections of ``m`` values, each made of ``rows`` minhashes. Texts with
       equal sets are one class with its smallest id.
    2. Tensored banding: every pair of a value of the first and one of the
       second collection is a table key. m * m tables cost 2 * m * rows
       minhashes; ``collections_for`` gives m for the chance ``miss``.
    3. Each table key names its smallest class as hub; a class goes, with its
       whole set, to the cell of each of its hubs, so all classes with a common
       key meet in a cell. Cells are cut into tiles by their shingles, and all
       tiles of a cell meet pairwise in separate tasks.
    4. In a cell, exact intersection sizes (0/1 matrix products over shared
       shingles) confirm links. Members linked to the hub are one component
       already, so pairs among them are not compared again. A task returns
       links to local roots, no pairs; components are joined iteratively.

    Words are separated by spaces, tabs and line ends, A-Z is lowered. With
    fewer words than ``shingle`` the whole sequence is one shingle. Null, empty
    and wordless texts have no shingles and link with nothing. Rows with a null
    id link with nothing, have a null component and are kept. Rows that repeat
    an id are judged by their own text. Empty tables give no rows. ``content``
    adds a hash of the text.
    """
    scratch = Scratch(docs.sparkSession)
    m = collections_for(similarity, rows, miss)
    mul, add = _seeds(2 * m * rows)
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    extra = ["content"] if content else []
    hashed = base.withColumn("content", F.xxhash64("text")) if content else base

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            flat, bounds = shingle_sets(words(part.column("text")), shingle)
            n = np.diff(bounds)
            some = np.flatnonzero(n)
            digest: list[bytes | None] = [None] * part.num_rows
            values: list[np.ndarray | None] = [None] * part.num_rows
            if len(some):
                starts = bounds[:-1][some]
                one, two = np.add.reduceat(mix(flat), starts), np.add.reduceat(mix(flat + np.uint64(1)), starts)
                h = minhashes(flat, starts, mul, add).reshape(2 * m, rows, len(some))
                v = h[:, 0]
                for r in range(1, rows):
                    v = mix(v + h[:, r])
                v = np.ascontiguousarray(v.T).view(np.int64)
                for at, d in enumerate(some):
                    digest[d], values[d] = one[at].tobytes() + two[at].tobytes(), v[at]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n), pa.array(digest, pa.binary()), pa.array(values, pa.list_(pa.int64())), *[part.column(c) for c in extra]],
                ["doc_id", "n", "digest", "values", *extra])

    signed = scratch.write(hashed.mapInArrow(sign, "doc_id long, n long, digest binary, values array<long>" + (", content long" if content else "")), "signed")
    usable = signed.filter("n > 0 AND doc_id IS NOT NULL")
    classes = usable.groupBy("digest", "n").agg(F.min("doc_id").alias("cid"), F.first("values").alias("values"))
    classes = scratch.write(classes, "classes")

    key = F.xxhash64(F.lit(0).alias("t"), "a", "x", "b", "y")
    # each class becomes m * m keys: few packed files would be few long tasks
    spread_out = classes.repartition(wide(classes), "cid")
    sides = spread_out.select("cid", F.posexplode(F.slice("values", 1, m)).alias("a", "x"), F.slice("values", m + 1, m).alias("second"))
    keys = sides.select("cid", "a", "x", F.posexplode("second").alias("b", "y")).select("cid", key.alias("key"))
    hubs = keys.groupBy(F.col("key").alias("h_key")).agg(F.min("cid").alias("hub"))
    pairs = keys.join(by_key(hubs), F.col("key") == F.col("h_key")).filter("cid <> hub").select("cid", "hub").distinct()
    pairs = scratch.write(pairs, "pairs")

    seats = scratch.write(pairs.unionByName(pairs.select(F.col("hub").alias("cid"), "hub").distinct()), "seats")
    sized = seats.join(by_key(classes.select(F.col("cid").alias("c_id"), "n")), F.col("cid") == F.col("c_id"))
    cells = sized.groupBy("hub").agg(
        F.greatest(F.ceil(F.sum("n") / TILE_SHINGLES), F.ceil(F.count(F.lit(1)) / TILE_ROWS)).cast("int").alias("tiles"))
    cells = scratch.write(cells, "cells")
    # as above: a seat becomes one per tile
    seated = attach(seats, cells, ["hub"]).repartition(wide(seats), "cid")
    own = F.pmod(F.xxhash64("cid", F.lit(2)), F.col("tiles")).cast("int")
    hub_row = F.col("cid") == F.col("hub")
    # the hub sits in every tile pair: each task finds out who is linked to it
    every = F.flatten(F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda i: F.transform(F.sequence(i, F.col("tiles") - 1), lambda j: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j")))))
    seated = seated.withColumn("own", own).withColumn("pair", F.explode(F.when(hub_row, every).otherwise(tile_pairs(F.col("own"), F.col("tiles")))))
    asked = seated.groupBy("cid").agg(F.collect_list(F.struct("hub", F.col("pair.i").alias("i"), F.col("pair.j").alias("j"), "own")).alias("seats"))
    asked = scratch.write(asked, "asked")
    # every class has a seat; Spark makes the filter only from a side with a condition
    sent = base.join(by_key(asked.filter("size(seats) > 0")), F.col("doc_id") == F.col("cid")).select("cid", "text", "seats")

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            flat, bounds = shingle_sets(words(part.column("text")), shingle)
            for d, (cid, places) in enumerate(zip(part.column("cid").to_pylist(), part.column("seats").to_pylist())):
                s = flat[bounds[d]:bounds[d + 1]].view(np.int64)
                for at in range(0, len(places), 64):
                    some = places[at:at + 64]
                    held = pa.ListArray.from_arrays(np.arange(len(some) + 1, dtype=np.int32) * len(s), np.tile(s, len(some)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p[c] for p in some], t) for c, t in (("hub", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("own", pa.int32()))]
                        + [pa.array([cid] * len(some), pa.int64()), held], ["hub", "i", "j", "own", "cid", "s"])

    tabled = sent.mapInArrow(seat, "hub long, i int, j int, own int, cid long, s array<long>")
    tabled = tabled.repartition("hub", "i", "j").sortWithinPartitions("hub", "i", "j")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        for group in runs(batches, ["hub", "i", "j"]):
            ids = group["cid"].to_numpy()
            if len(ids) < 2:
                continue
            s = group["s"].combine_chunks()
            a, b = confirmed(ids == group["hub"][0].as_py(), group["own"].to_numpy(), group["i"][0].as_py(), group["j"][0].as_py(),
                             s.flatten().to_numpy(), np.diff(s.offsets.to_numpy()), similarity)
            roots = local_roots(len(ids), a, b)
            moved = np.flatnonzero(roots != np.arange(len(ids)))
            if len(moved):
                out.append((ids[moved], ids[roots[moved]]))
                held += len(moved)
            if held > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["a", "b"])
                out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["a", "b"])

    # only texts that sit in a cell need to be moved: a Bloom filter of their ids drops the others in the scan
    with _bloom(docs.sparkSession):
        edges = scratch.write(tabled.mapInArrow(verify, "a long, b long"), "links")
    roots = scratch.write(components(edges, scratch), "roots")
    named = classes.select(F.col("digest").alias("c_digest"), F.col("n").alias("c_n"), "cid").join(by_key(roots), F.col("cid") == F.col("node"), "left")
    named = named.select("c_digest", "c_n", F.coalesce("root", "cid").alias("component"))
    joined = signed.select("doc_id", "n", "digest", *extra).join(by_key(named), (F.col("digest") == F.col("c_digest")) & (F.col("n") == F.col("c_n")), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    out = joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"), *extra)
    return finish(scratch, out, "near-duplicates")


def confirmed(hub: np.ndarray, own: np.ndarray, i: int, j: int, flat: np.ndarray, sizes: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of rows of one tile pair; ``flat`` holds the sets row by row. Enough pairs for the components, not all."""
    least = Fraction(str(similarity))  # as written: 0.804 is 201 / 250
    n = len(sizes)
    row = np.repeat(np.arange(n), sizes)
    order = np.argsort(flat, kind="stable")
    ranked = flat[order]
    fresh = np.ones(len(ranked), dtype=bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    term = np.cumsum(fresh) - 1
    shared = np.bincount(term)[term] > 1
    row, term = row[order][shared], term[shared]
    if not len(term):
        return term, term
    first = np.ones(len(term), dtype=bool)
    first[1:] = term[1:] != term[:-1]
    column = np.cumsum(first) - 1

    def reach(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Linked pairs between the rows ``a`` and the rows ``b``."""
        if not len(a) or not len(b):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        place_a, place_b = np.full(n, -1), np.full(n, -1)
        place_a[a], place_b[b] = np.arange(len(a)), np.arange(len(b))
        both = np.zeros((len(a), len(b)), dtype=np.float32)
        bounds = np.searchsorted(column, np.arange(0, column[-1] + 1 + COLUMNS, COLUMNS))
        for k, (at, to) in enumerate(zip(bounds, bounds[1:])):
            r, c = row[at:to], column[at:to] - k * COLUMNS
            width = min(COLUMNS, int(column[-1]) + 1 - k * COLUMNS)
            x, y = np.zeros((len(a), width), np.float32), np.zeros((len(b), width), np.float32)
            ra, rb = place_a[r], place_b[r]
            x[ra[ra >= 0], c[ra >= 0]] = 1
            y[rb[rb >= 0], c[rb >= 0]] = 1
            both += x @ y.T
        union = sizes[a][:, None] + sizes[b][None, :] - both
        p, q = np.nonzero(least.denominator * both.astype(np.int64) >= least.numerator * union.astype(np.int64))
        return a[p], b[q]

    hubs = np.flatnonzero(hub)
    every = np.arange(n)
    a, b = reach(hubs, every)
    near = hub.copy()
    near[b] = True
    far = ~near
    mine, other = own == i, own == j
    parts = [(a, b), reach(np.flatnonzero(far & mine), np.flatnonzero(other))]
    if i != j:
        parts.append(reach(np.flatnonzero(far & other), np.flatnonzero(mine & near)))
    a, b = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    return a[a != b], b[a != b]


def without_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates (its smallest id), columns unchanged.

    Rows are judged by id and text: of rows that share an id only those in a
    group go, and of rows equal in id and text one stays. Rows with a null id,
    and null, empty or wordless texts, stay. Texts are read where they lie; only
    rows that may go are moved (``spread.apart``). An empty table stays empty;
    clashing columns are kept.
    """
    judged = near_duplicates(docs, doc_id=doc_id, text=text, content=True, **settings).filter("doc_id IS NOT NULL AND n_shingles > 0")
    named = judged.groupBy(F.col("doc_id").alias("_near_id"), F.col("content").alias("_near_content")).agg(F.min("kept").alias("_near_kept"), F.count(F.lit(1)).alias("_near_n"))
    named = named.filter("NOT _near_kept OR _near_n > 1")
    free, asked = apart(docs, named.select(F.xxhash64("_near_id", "_near_content").alias("key")), F.xxhash64(docs[doc_id].cast("long"), F.xxhash64(docs[text])))
    asked = asked.join(by_key(named), (asked[doc_id].cast("long") == F.col("_near_id")) & (F.xxhash64(asked[text]) == F.col("_near_content")), "left")
    asked = asked.filter("_near_kept IS NULL OR _near_kept")
    once = asked.filter("_near_n IS NULL").unionByName(asked.filter("_near_n > 1").dropDuplicates(["_near_id", "_near_content"]))
    return free.unionByName(once.select(*docs.columns))
