"""Quality classifier by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernel import mix, slices, words
from .scratch import Scratch, finish
from .spread import apart, by_key, quota_cut

BUCKETS = 1 << 14
TARGET_ROWS = 20_000

# Kinds of bytes that a word's form is made of: 0 other, 1 lower case or non-ASCII, 2 upper case, 3 digit, 4 common punctuation.
_KIND = np.zeros(256, dtype=np.uint64)
_KIND[97:123] = 1
_KIND[128:] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3
for _c in b".,;:?'\"()-":
    _KIND[_c] = 4


def ngram_buckets(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of each text, and their bounds by text.

    Per word: itself, the pair with its predecessor, and the triple of forms
    that ends at it. A form is the kind of the first, second and last byte and
    whether the word repeats its predecessor.
    """
    w = words(texts, lower=False)
    n = len(w.hashes)
    counts = np.diff(w.first)
    if not n:
        return np.empty(0, np.int64), 3 * w.first
    start = np.zeros(n, dtype=bool)
    start[w.first[:-1][counts > 0]] = True
    before = np.concatenate([w.hashes[:1], w.hashes[:-1]])
    before = np.where(start, np.uint64(1), before)
    last = w.ends - 1
    form = _KIND[w.data[w.starts]] + np.uint64(5) * _KIND[w.data[np.minimum(w.starts + 1, last)]]
    form = form + np.uint64(25) * _KIND[w.data[last]] + np.uint64(125) * (before == w.hashes).astype(np.uint64)
    back = np.where(start, np.uint64(999), np.concatenate([form[:1], form[:-1]]))
    back2 = np.where(start, np.uint64(999), np.concatenate([back[:1], back[:-1]]))
    grams = np.empty((n, 3), dtype=np.uint64)
    grams[:, 0] = w.hashes
    grams[:, 1] = mix(before * np.uint64(3) + w.hashes)
    grams[:, 2] = mix(np.uint64(1 << 40) + form + np.uint64(1000) * back + np.uint64(1_000_000) * back2)
    return (grams.ravel() & np.uint64(buckets - 1)).astype(np.int64), 3 * w.first


def importance_resample(
    docs: DataFrame, labels: DataFrame, lose: float = 0.002, buckets: int = BUCKETS, target_rows: int = TARGET_ROWS, seed: int = 6,
    doc_id: str = "doc_id", text: str = "text", label: str = "quality",
) -> DataFrame:
    """Documents drawn to resemble those labelled good: doc_id, log_weight, draw, kept.

    Two generative models are bags of hashed n-grams: the raw one counts all
    documents, the target one a bounded sample of at most ``target_rows``
    documents labelled 1 (those with the smallest hash of the id). A document's
    importance weight is the ratio of its likelihoods; ``log_weight`` is its
    logarithm. Gumbel noise on it (from a hash of id and ``seed``) and the
    largest ``k`` sums draw k documents without replacement in proportion to
    their weights. ``k`` is the number of documents whose weight reaches that
    of all but a share ``lose`` of the documents labelled 1. The k-th sum is
    found by histograms, in no single task.

    Null and empty texts have no n-grams, so weight 1 (logarithm 0). Rows with
    a null id draw one common noise. Several labels of an id count as the
    largest. Without any label 1 all documents are kept. ``buckets`` must be a power of two.
    """
    scratch = Scratch(docs.sparkSession)
    good = labels.groupBy(F.col("doc_id").alias("l_id")).agg(F.max(label).alias("l")).filter("l = 1 AND l_id IS NOT NULL").select("l_id")
    good = scratch.write(good, "good")
    sample = scratch.write(good.orderBy(F.xxhash64("l_id"), "l_id").limit(target_rows), "target")
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    marked = base.join(F.broadcast(sample), F.col("doc_id") == F.col("l_id"), "left").select("text", F.col("l_id").isNotNull().alias("target"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, buckets), dtype=np.int64)
        for part in slices(batches, "text"):
            b, bounds = ngram_buckets(part.column("text"), buckets)
            n[0] += np.bincount(b, minlength=buckets)
            target = part.column("target").to_numpy(zero_copy_only=False)
            n[1] += np.bincount(b[np.repeat(target, np.diff(bounds))], minlength=buckets)
        if n.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets)), pa.array(n[0]), pa.array(n[1])], ["bucket", "raw", "target"])

    counted = marked.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    ratio = np.zeros(buckets)
    rows = counted.collect()  # one row per bucket
    if rows:
        at = [r.bucket for r in rows]
        raw, target = np.array([r.raw for r in rows], float), np.array([r.target for r in rows], float)
        if target.sum():
            p, q = (target + 1) / (target.sum() + buckets), (raw + 1) / (raw.sum() + buckets)
            ratio[at] = np.log(p) - np.log(q)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            b, bounds = ngram_buckets(part.column("text"), buckets)
            running = np.concatenate([[0.0], np.cumsum(ratio[b])])
            weight = np.round(running[bounds[1:]] - running[bounds[:-1]], 6)
            noise = mix(part.column("hash").to_numpy().astype(np.uint64) ^ np.uint64(seed * 0x9E3779B9))
            gumbel = -np.log(-np.log(((noise >> np.uint64(11)).astype(float) + 0.5) / 2.0**53))
            draw = weight + gumbel
            bits = draw.view(np.int64)
            # the bits of a double, turned so that they order as the numbers do; a large sum gets a small rank
            order = np.where(bits < 0, ~bits, bits | np.int64(-2**63)).view(np.uint64)
            rank = (~order >> np.uint64(16)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(weight), pa.array(draw), pa.array(rank)], ["doc_id", "log_weight", "draw", "rank"])

    kind = docs.schema[doc_id].dataType.simpleString()
    scored = base.withColumn("hash", F.xxhash64("doc_id")).mapInArrow(score, f"doc_id {kind}, log_weight double, draw double, rank long")
    scored = scratch.write(scored, "scored")
    known = scored.join(by_key(good), F.col("doc_id") == F.col("l_id"))
    cut = known.agg(F.percentile_approx("log_weight", lose, 10_000).alias("c")).first().c
    if cut is None:
        return finish(scratch, scored.select("doc_id", "log_weight", "draw", F.lit(True).alias("kept")), "quality")
    k = scored.filter(F.col("log_weight") >= cut).count()
    one = scored.select(F.lit(0).alias("all"), "rank", F.lit(1).alias("size"))
    quota = scratch.write(docs.sparkSession.range(1).select(F.lit(0).alias("all"), F.lit(k).cast("long").alias("quota")), "k")
    at = scratch.write(quota_cut(one, quota, "all", scratch), "draw")
    limit = at.first().cut
    kept = F.lit(True) if limit is None else F.col("rank") < limit
    return finish(scratch, scored.select("doc_id", "log_weight", "draw", kept.alias("kept")), "quality")


def good_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", **settings) -> DataFrame:
    """``docs`` without those that are not drawn, columns unchanged.

    Decisions are by id: rows that repeat an id, null included, go only
    together. Texts are read where they lie; only rows whose id may be among the
    rejected ones are moved (``spread.apart``). Null and empty texts have weight
    1 like any other; an empty table stays empty; clashing columns are kept.
    """
    drawn = importance_resample(docs, labels, doc_id=doc_id, **settings)
    gone = drawn.groupBy("doc_id").agg(F.max("kept").alias("kept")).filter(~F.col("kept")).select(F.col("doc_id").alias("_gone"))
    free, asked = apart(docs, gone.select(F.xxhash64("_gone").alias("key")), F.xxhash64(docs[doc_id]))
    return free.unionByName(asked.join(by_key(gone), asked[doc_id].eqNullSafe(gone["_gone"]), "left_anti"))
