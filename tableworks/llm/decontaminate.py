"""Benchmark decontamination: a prefix-filtered set join in DataFrame operations only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch, finish
from .spread import apart, attach, by_key

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Everything below 0x80 that is neither a digit nor a lower-case letter separates words.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW, SHINGLE = 13, 5


def word_list(text: Column) -> Column:
    """Words of the text with A-Z lowered; none for null."""
    ascii_only = F.length(text) == F.octet_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))
    pieces = F.split(F.coalesce(lowered, F.lit("")), BREAKS)
    return F.filter(pieces, lambda w: w != "")


def benchmark_windows(items: DataFrame, window: int, shingle: int, item_id: str, text: str) -> DataFrame:
    """Distinct windows of all items: ``words`` (window words, or a shorter item whole), ``items``, ``win``."""
    w = items.select(F.col(item_id).alias("item_id"), word_list(F.col(text)).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    cut = w.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, window))).alias("words"))
    return cut.groupBy("words").agg(F.collect_set("item_id").alias("items")).withColumn("win", F.md5(F.concat_ws(" ", "words")))


def shingle_hash(words: str, at: Column, size: int) -> Column:
    """A 64-bit hash of ``size`` words from place ``at`` (0-based)."""
    return F.xxhash64(*[F.get(words, at + i) for i in range(size)])


def find_contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, per_hit: int = 20,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Words of each document inside windows of benchmark items.

    A window is ``window`` consecutive item words; a shorter item is one window
    of its own size. Steps of the prefix-filtered join:

    1. Every document is cut into word shingles, and those that occur in any
       window are kept with their place and the words around them. This is the
       one pass over all words; Spark broadcasts the shingle list only below
       its size threshold and joins by shingle otherwise.
    2. Shingles are ordered by rarity: their count over all documents. A window
       whose shingles do not all occur cannot occur itself and goes. As the
       whole window must be contained, its prefix is the one rarest shingle.
    3. Prefix shingles are joined to the places (broadcast where they are
       counted and few, by shingle otherwise); the place of the shingle in
       the window fixes where the window starts, and starts outside the
       document (positional bound) or past its end (length bound) go.
    4. The words around the place are compared with the window's words.

    Returns doc_id, n_words, n_hit (words inside any occurrence), n_items,
    item_ids (as sorted strings), contaminated (``per_hit * n_hit >= n_words``
    and a hit). Null and empty texts have no words and no hits; null or wordless
    items have no window; a null item id counts for hits, not as an item. Rows
    that repeat an id are judged by their own text; null ids are allowed. Empty
    tables give no rows, or rows without hits.
    """
    scratch = Scratch(docs.sparkSession)
    wins = scratch.write(benchmark_windows(items, window, shingle, item_id, item_text), "windows")
    sizes = sorted(r.k for r in wins.select(F.least(F.size("words"), F.lit(shingle)).alias("k")).distinct().collect())  # at most ``shingle`` values
    at = F.col("at")
    # without any window the places keep their columns: any size will do
    grams = [
        wins.filter(F.least(F.size("words"), F.lit(shingle)) == k).select("win", "words", F.explode(F.sequence(F.lit(0), F.size("words") - k)).alias("at"))
        .select("win", "at", shingle_hash("words", at, k).alias("gram"), F.lit(k).alias("k")) for k in sizes or [shingle]]
    grams = scratch.write(reduce(DataFrame.unionByName, grams), "grams")

    row = [F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("content")]
    split = docs.select(*row, word_list(F.col(text)).alias("w"))
    found = None
    for k in sizes or [shingle]:
        # place -1 is the document itself, which stays whether or not anything is found
        first = 0 if found is not None else -1
        each = split.select("doc_id", "content", "w", F.explode(F.sequence(F.lit(first), F.greatest(F.size("w") - k, F.lit(first)))).alias("at"))
        each = each.select("doc_id", "content", "w", "at", F.when((at >= 0) & (F.size("w") >= at + k), shingle_hash("w", at, k)).alias("gram"))
        wanted = grams.filter(F.col("k") == k).select(F.col("gram").alias("known")).distinct()
        low = F.greatest(at - (window - k), F.lit(0))
        hit = each.join(wanted, F.col("gram") == F.col("known"), "left").filter(F.col("known").isNotNull() | (at == -1)).select(
            "doc_id", "content", F.size("w").cast("long").alias("n_words"), F.col("known").alias("gram"), "at", low.alias("low"),
            F.when(at >= 0, F.slice("w", low + 1, at - low + window)).alias("around"))
        found = hit if found is None else found.unionByName(hit)
    found = scratch.write(found, "places")
    counted = found.filter("at = -1").select("doc_id", "content", "n_words")
    found = found.filter("at >= 0")

    rarity = found.groupBy("gram").agg(F.count(F.lit(1)).alias("seen"))
    prefix = grams.join(rarity, "gram", "left").groupBy("win").agg(
        F.min(F.coalesce("seen", F.lit(0))).alias("least"), F.min(F.struct(F.coalesce("seen", F.lit(0)), "gram", "at")).alias("p"))
    prefix = prefix.filter("least > 0").select("win", F.col("p.gram").alias("gram"), F.col("p.at").alias("offset"))
    prefix = scratch.write(prefix.join(wins.select("win", "words"), "win"), "prefix")
    start = F.col("at") - F.col("offset")
    tried = attach(found, prefix, ["gram"]).withColumn("start", start).filter("start >= low")
    tried = tried.filter(F.size("around") - (F.col("start") - F.col("low")) >= F.size("words"))
    true = tried.filter(F.slice("around", F.col("start") - F.col("low") + 1, F.size("words")) == F.col("words"))
    true = scratch.write(true.select("doc_id", "content", "win", "start", F.size("words").alias("length")), "true")

    spans = true.groupBy("doc_id", "content").agg(F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end")))).alias("spans"))
    zero = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n"))
    step = lambda a, s: F.struct(
        F.greatest(a["upto"], s["end"]).alias("upto"), (a["n"] + F.greatest(s["end"] - F.greatest(a["upto"], s["start"]), F.lit(0))).alias("n"))
    hits = spans.select("doc_id", "content", F.aggregate("spans", zero, step, lambda a: a["n"]).cast("long").alias("n_hit"))
    named = true.select("doc_id", "content", "win").distinct().join(wins.select("win", F.explode("items").alias("item")), "win")
    named = named.groupBy("doc_id", "content").agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("item_ids"))
    hits = hits.select(F.col("doc_id").alias("h_id"), F.col("content").alias("h_content"), "n_hit")
    named = named.select(F.col("doc_id").alias("i_id"), F.col("content").alias("i_content"), "item_ids")
    both = hits.join(named, reduce(Column.__and__, [F.col("h_id").eqNullSafe(F.col("i_id")), F.col("h_content").eqNullSafe(F.col("i_content"))]), "left")
    both = scratch.write(both.drop("i_id", "i_content"), "hits")

    out = counted.join(by_key(both), F.col("doc_id").eqNullSafe(F.col("h_id")) & F.col("content").eqNullSafe(F.col("h_content")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    out = out.select("doc_id", "content", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"),
                     ((n_hit > 0) & (per_hit * n_hit >= F.col("n_words"))).alias("contaminated"))
    return finish(scratch, out, "contamination")


def drop_contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``docs`` without the contaminated rows, columns unchanged.

    Rows are judged by id and text, so rows that repeat an id with another text
    stay. Texts are read where they lie; only rows that may be contaminated are
    moved (``spread.apart``). Null, empty and very long texts are judged like
    any other; an empty table or benchmark changes nothing; clashing columns are
    kept.
    """
    found = find_contamination(docs, items, doc_id=doc_id, text=text, **settings)
    bad = found.filter("contaminated").select(F.col("doc_id").alias("_bad_id"), F.col("content").alias("_bad_content")).distinct()
    free, asked = apart(docs, bad.select(F.xxhash64("_bad_id", "_bad_content").alias("key")), F.xxhash64(docs[doc_id], F.xxhash64(docs[text])))
    same = asked[doc_id].eqNullSafe(bad["_bad_id"]) & F.xxhash64(asked[text]).eqNullSafe(bad["_bad_content"])
    return free.unionByName(asked.join(by_key(bad), same, "left_anti"))
