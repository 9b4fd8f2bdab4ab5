"""Distributed building blocks: attach a small table, number rows, cut at a quota, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

# A table with at most this many rows is sent to every task; a larger one is joined by key.
SMALL_ROWS = 20_000


def attach(df: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join a stored table to a large frame: broadcast where its counted rows allow, by key otherwise (null keys match)."""
    few = small.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS
    right = small.select(*[F.col(c).alias(f"_r_{c}") for c in on], *[c for c in small.columns if c not in on])
    same = [df[c].eqNullSafe(right[f"_r_{c}"]) for c in on]
    joined = df.join(F.broadcast(right) if few else by_key(right), _all(same), how)
    return joined.drop(*[f"_r_{c}" for c in on])


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def by_key(df: DataFrame) -> DataFrame:
    """``df`` for a join by key, at any size: for tables that grow with the documents.

    Spark sizes a stored table by its compressed files and an exploded one as if
    no list had more than an entry, and a broadcast once planned is not taken
    back: what it takes for less than its threshold may be a hundred times that
    on the driver.
    """
    return df.hint("merge")


def wide(df: DataFrame) -> int:
    """Pieces for a range partitioning that is to stay even after a hash by piece."""
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def number_rows(df: DataFrame, group: list[str], order: list[str], scratch: Scratch, name: str = "position") -> DataFrame:
    """Gapless numbers from 0 within ``group`` by ``order``, without bringing a group into one task.

    Rows are range-partitioned by (group, order) and stored, each piece counts
    its rows per group, and the counts of earlier pieces are added to the local
    numbers. Ties are numbered in no set order, nulls come first.
    """
    keys = [*group, *order]
    pieces = scratch.write(df.repartitionByRange(wide(df), *keys).withColumn("_piece", F.spark_partition_id()), "pieces")
    by = Window.partitionBy(*group).orderBy("_piece") if group else Window.orderBy("_piece")
    counts = pieces.groupBy(*group, "_piece").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(by) - F.col("_n")).drop("_n")
    before = scratch.write(before, "offsets")
    local = pieces.withColumn("_local", F.row_number().over(Window.partitionBy("_piece", *group).orderBy(*order)) - 1)
    joined = attach(local, before, [*group, "_piece"])
    return joined.withColumn(name, (F.col("_before") + F.col("_local")).cast("long")).drop("_piece", "_local", "_before")


# Size of the bit array that tells rows no decision names: 16 MB in all, in bitmaps of 4 KB.
MARK_BITS, BITMAP_BITS = 1 << 27, 1 << 15


def apart(docs: DataFrame, keys: DataFrame, key: Column) -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` whose ``key`` (a hash) is surely not in ``keys`` (a column ``key``), and the others.

    The keys are set in a bit array of ``MARK_BITS``, and that is sent to the
    tasks: its size is bounded whatever the tables'. A row whose bit is off is
    named by no key, so it need not be moved to be compared; of the others a
    few are there by chance, and the caller compares them exactly.
    """
    spot = F.pmod(F.col("key"), F.lit(MARK_BITS)).cast("int")
    bits = keys.select(F.shiftright(spot, 15).alias("_bucket"), spot.bitwiseAND(BITMAP_BITS - 1).cast("long").alias("at"))
    bits = bits.groupBy("_bucket").agg(F.bitmap_construct_agg("at").alias("_bits"))
    mine = F.pmod(key, F.lit(MARK_BITS)).cast("int")
    marked = docs.select(F.struct(*[docs[n] for n in docs.columns]).alias("_row"), mine.alias("_spot")).withColumn("_own", F.shiftright("_spot", 15))
    marked = marked.join(F.broadcast(bits), F.col("_own") == F.col("_bucket"), "left")
    place = F.col("_spot").bitwiseAND(BITMAP_BITS - 1)
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    on = F.coalesce(F.call_function("shiftright", byte, place.bitwiseAND(7)).bitwiseAND(1) == 1, F.lit(False))
    return tuple(marked.filter(c).select("_row.*") for c in (~on, on))


RANK_BITS, LEVEL_BITS = 48, 16


def quota_cut(rows: DataFrame, quotas: DataFrame, group: str, scratch: Scratch) -> DataFrame:
    """Per group the rank at which the running ``size`` (by ``rank``, equal ranks together) first exceeds ``quota``.

    ``rows``: group, ``rank`` (0 to 2**48 - 1), ``size``. ``quotas``: group,
    ``quota``. Returns group, ``cut`` (null where all rows fit) and ``filled``
    (the size below the cut; null there too). The rank is found 16 bits at a time: a map-side
    combined histogram per level, so no group is ever sorted in one task.
    """
    state = scratch.write(quotas.select(group, F.col("quota").cast("long").alias("left"), F.lit(0).cast("long").alias("prefix"), F.lit(False).alias("fits")), "cut")
    for shift in range(RANK_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        open_ = attach(rows, state.filter(~F.col("fits")).select(group, "prefix"), [group])
        inside = open_.filter(F.shiftright("rank", shift + LEVEL_BITS) == F.col("prefix"))
        bins = inside.groupBy(group, F.shiftright("rank", shift).alias("bin")).agg(F.sum("size").alias("in_bin"))
        run = bins.withColumn("upto", F.sum("in_bin").over(Window.partitionBy(group).orderBy("bin")))
        over = attach(run, state.filter(~F.col("fits")).select(group, "left"), [group]).filter(F.col("upto") > F.col("left"))
        first = over.groupBy(group).agg(F.min(F.struct("bin", (F.col("left") - F.col("upto") + F.col("in_bin")).alias("rest"))).alias("hit"))
        first = scratch.write(first, "level")
        new = attach(state, first, [group], "left")
        previous, state = state, scratch.write(new.select(
            group, F.coalesce("hit.rest", "left").alias("left"), F.coalesce("hit.bin", "prefix").alias("prefix"),
            (F.col("fits") | F.col("hit").isNull()).alias("fits")), "cut")
        scratch.drop(previous, first)
    out = attach(quotas, state, [group])
    # without an excess at the first level every row fits; ``left`` is then the whole quota
    return out.select(group, F.when(~F.col("fits"), F.col("prefix")).alias("cut"), F.when(~F.col("fits"), F.col("quota") - F.col("left")).alias("filled"))


def components(edges: DataFrame, scratch: Scratch, rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b: long): ``node``, ``root`` (its smallest reachable node), nodes with edges only.

    Alternating large-star and small-star rounds (Kiveris et al., 2014). Every
    round is an aggregate and a join by node, so a node with very many
    neighbours is combined map-side and its join partition can be split.
    """
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = scratch.write(e, "edges")
    mark = _fingerprint(e)
    for _ in range(rounds):
        if mark[0] == 0:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(by_key(least), F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.write(large, "edges")
        least = large.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
        small = large.join(by_key(least), F.col("u") == F.col("k")).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct()
        previous, e = e, scratch.write(small, "edges")
        scratch.drop(previous, large)
        before, mark = mark, _fingerprint(e)
        if before == mark:
            break
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _fingerprint(e: DataFrame) -> tuple[int, int]:
    row = e.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("x")).first()
    return row.n, row.x
