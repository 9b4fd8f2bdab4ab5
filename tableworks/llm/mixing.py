"""Mix sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch, finish
from .spread import RANK_BITS, attach, quota_cut

WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS = 52


def word_count(text: Column) -> Column:
    """Words between spaces, tabs and line ends; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: int, scratch: Scratch) -> DataFrame:
    """Words wanted per source.

    ``sizes``: source, source_size. Sources by code point, null last, take the
    weights in turn and share ``share`` times all words; none gets more than
    ``most`` times its own, and the excess goes to the others by weight. That
    limit is a water level: sources are capped in the order of
    ``most * size / weight``, found by running sums over the list of sources.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    level = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    turn = F.array(*[F.lit(int(w)) for w in weights])
    s = sizes.withColumn("weight", F.get(turn, ((F.row_number().over(named) - 1) % len(weights)).cast("int")).cast("long"))
    s = s.withColumn("full", F.col("source_size") * most).withColumn("full_at", F.col("full") / F.col("weight"))
    every = Window.partitionBy()
    s = (s.withColumn("wanted", F.sum("source_size").over(every) * F.lit(float(share)))
         .withColumn("full_before", F.sum("full").over(level) - F.col("full"))
         .withColumn("weight_left", F.sum("weight").over(every) - F.sum("weight").over(level) + F.col("weight")))
    s = s.withColumn("capped", (F.col("wanted") - F.col("full_before")) / F.col("weight_left") * F.col("weight") >= F.col("full"))
    s = (s.withColumn("capped_size", F.coalesce(F.sum(F.when(F.col("capped"), F.col("full"))).over(every), F.lit(0)))
         .withColumn("open_weight", F.sum(F.when(~F.col("capped"), F.col("weight"))).over(every)))
    target = F.when(F.col("capped"), F.col("full").cast("double")).otherwise(
        (F.col("wanted") - F.col("capped_size")) / F.col("open_weight") * F.col("weight"))
    return s.select("source", "source_size", target.alias("target"))


def _plan(base: DataFrame, weights: tuple[int, ...], share: float, most: int, near: float, scratch: Scratch) -> DataFrame:
    """A row per source: target, whole copies, the part drawn, its long documents drawn, the cut of the others and the closing document.

    ``base``: doc_id, source, size, draw. Long documents, above ``near`` times
    the target (at most 1 / near of them make up a target, so their list is
    bounded), are drawn first, sizes by powers of two from the largest down and
    each by rank: a document is taken where that brings the sum nearer to the
    drawn part of all documents so far. So the error of large ones is made good by smaller
    ones. The sum leaves no more and no less than the others can fill. Short
    documents then fill the rest.
    """
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, most, scratch)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = targets.withColumn("whole", F.floor(ratio)).withColumn("part", ratio - F.floor(ratio))
    targets = targets.withColumn("quota", F.floor(F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))
    targets = scratch.write(targets.withColumn("long_from", F.col("target") * F.lit(near)), "targets")

    drawn = attach(base, targets.select("source", "part", "long_from"), ["source"]).filter(F.col("part") > 0)
    ranked = scratch.write(drawn.select("source", "doc_id", "size", "long_from", _rank().alias("rank")), "ranked")
    is_long = F.col("size") > F.col("long_from")
    shorts = scratch.write(ranked.filter(~is_long).groupBy("source").agg(F.sum("size").alias("short_words")), "shorts")
    one = ranked.filter(is_long).groupBy("source", "rank", "doc_id", "size").agg(F.sum("size").alias("words"))
    one = one.withColumn("less", -F.length(F.bin("size")))
    down = Window.partitionBy("source").orderBy("less")
    one = one.withColumn("upto", F.sum("words").over(down)).withColumn("after", F.sum("words").over(Window.partitionBy("source")) - F.col("upto"))
    known = attach(attach(targets.filter(F.col("part") > 0).select("source", "part", "quota"), shorts, ["source"], "left").fillna(0, ["short_words"]), scratch.write(one.groupBy("source").agg(
        F.sort_array(F.collect_list(F.struct("less", "rank", "doc_id", "size", "words", "upto", "after"))).alias("longs")), "longs"), ["source"], "left")
    d_type = "array<struct<doc_id:{0},size:bigint>>".format(base.schema["doc_id"].dataType.simpleString())
    start = F.struct(F.lit(0).cast("long").alias("words"), F.array().cast(d_type).alias("taken"))
    quota = F.col("quota")

    def step(acc: Column, d: Column) -> Column:
        limit = F.greatest(F.least(F.floor(F.col("part") * d["upto"]).cast("long"), quota), quota - F.col("short_words") - d["after"])
        fits = (d["words"] <= 2 * (limit - acc["words"])) & (acc["words"] + d["words"] <= quota)
        more = F.struct(d["doc_id"].alias("doc_id"), d["size"].alias("size"))
        return F.when(fits, F.struct((acc["words"] + d["words"]).alias("words"), F.concat(acc["taken"], F.array(more)).alias("taken"))).otherwise(acc)

    fit = F.when(F.col("longs").isNotNull(), F.aggregate("longs", start, step)).otherwise(start)
    sides = known.withColumn("fit", fit).select("source", (quota - F.col("fit.words")).alias("quota"), F.col("fit.taken").alias("longs"))
    sides = scratch.write(sides, "sides")

    short = ranked.filter(~is_long).select("source", "rank", "size")
    cuts = scratch.write(quota_cut(short, sides.select("source", "quota"), "source", scratch), "cuts")
    filled = attach(short, cuts.select("source", "cut"), ["source"]).filter(F.col("cut").isNull() | (F.col("rank") < F.col("cut")))
    filled = scratch.write(filled.groupBy("source").agg(F.sum("size").alias("filled")), "filled")
    drawn = attach(attach(sides, cuts.select("source", "cut"), ["source"]), filled, ["source"], "left")
    drawn = scratch.write(drawn.select("source", "longs", "cut", (F.col("quota") - F.coalesce("filled", F.lit(0))).alias("gap")), "drawn")
    away = F.abs(F.col("size") - F.col("gap"))
    closing = (attach(ranked, drawn, ["source"]).filter(~_inside() & (away < F.col("gap"))).groupBy("source")
               .agg(F.min(F.struct(away.alias("off"), "rank", "doc_id", "size")).alias("closing")))
    plan = attach(attach(targets, drawn, ["source"], "left"), scratch.write(closing, "closing"), ["source"], "left")
    return scratch.write(plan.drop("quota", "gap"), "plan")


def _rank() -> Column:
    """Pareto rank of a row with ``draw`` and its source's ``part``: the odds of the draw over the odds of the part."""
    odds = (F.col("draw") + 0.5) / F.lit(float(2**HASH_BITS))
    odds = (odds / (1 - odds)) / (F.col("part") / (1 - F.col("part")))
    return F.when(F.col("part") > 0, F.floor(odds / (1 + odds) * F.lit(float(2**RANK_BITS)))).cast("long")


def _inside() -> Column:
    """Whether its source's draw takes the row: a long one by name, a short one by rank."""
    named = F.exists("longs", lambda d: d["doc_id"].eqNullSafe(F.col("doc_id")) & (d["size"] == F.col("size")))
    below = F.col("cut").isNull() | (F.col("rank") < F.col("cut"))
    return F.coalesce(F.when(F.col("size") > F.col("long_from"), named).otherwise(below), F.lit(False))


def _copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows (doc_id, source, size, draw and others) with their source's plan and ``copies``."""
    placed = attach(rows, plan, ["source"]).withColumn("rank", _rank())
    inside = (F.col("part") > 0) & _inside()
    last = F.col("closing").isNotNull() & F.col("closing.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("closing.size") == F.col("size")) & ~inside & (F.col("part") > 0)
    return placed.withColumn("copies", (F.col("whole") + (inside | F.coalesce(last, F.lit(False))).cast("long")).cast("long"))


def _drawn(docs: DataFrame, seed: str, doc_id: str, text: str, source: str, *more: Column) -> DataFrame:
    digest = F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.lit(f"/{seed}")))
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
        F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long").alias("draw"), *more)


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: str = "mix", near: float = 0.001,
    doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """How often each document enters the mix: doc_id, source, size, source_size, target, copies, taken.

    A source with target / size = c gives every document floor(c) certain whole
    copies. The rest, lambda = c - floor(c), is an inclusion probability:
    documents are ranked by the odds of a random number over the odds of lambda
    (Pareto order sampling, Rosen 1997), and the sample is fixed in size: ranks
    are taken while their words fit the source's remaining words. Documents of
    more than ``near`` times the target are drawn before the others, so that
    none of them ends the draw short of it. The one further document whose
    words come nearest to the gap closes it, where that brings the sum nearer:
    a source whose short documents can fill it misses by less than ``near``.
    The random number is a hash of ``seed`` and the id.

    Null and empty texts have size 0, and are taken (0 words) by their rank. Rows that repeat id, source and size are drawn together. A null source is a
    source of its own, a null id draws as an id of its own. Texts of any length
    are counted whole. An empty table gives an empty result; sources without
    words have target 0.
    """
    scratch = Scratch(docs.sparkSession)
    base = scratch.write(_drawn(docs, seed, doc_id, text, source), "sizes")
    placed = _copies(base, _plan(base, weights, share, most, near, scratch))
    out = placed.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    return finish(scratch, out, "mix")


def mixed_documents(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: str = "mix", near: float = 0.001,
    doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as ``mix_sources`` takes it, columns unchanged.

    A row's copies follow from its id, its size and its source's row of the
    plan, so they are found where the text lies and no text is moved. Null
    texts, ids and sources, empty and very long texts, repeated rows and empty
    tables are treated as there; clashing columns are kept.
    """
    scratch = Scratch(docs.sparkSession)
    plan = _plan(scratch.write(_drawn(docs, seed, doc_id, text, source), "sizes"), weights, share, most, near, scratch)
    plan = scratch.write(plan, "mix-plan")
    whole = _copies(_drawn(docs, seed, doc_id, text, source, F.struct(*[docs[c] for c in docs.columns]).alias("_row")), plan)
    out = whole.filter("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_row.*")
    scratch.close(plan)
    return out
