"""Sharding by balanced label propagation: linked documents move to their neighbours' shard where its quota grants it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch, finish
from .spread import number_rows

OVERHEAD = 16
TIER = 4  # groups of one tier differ in members by less than this factor
LEVEL_BITS, LEVELS = 16, 3  # a rank is cut 16 bits at a time
MOST_ROUNDS = 500  # a tier that is not settled by then is an error

_NEAR = "array<struct<n: long, tie: int, label: int>>"


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(int(v)).cast("long") for v in values])


def _wish(rooms: list[int], turn: int) -> Column:
    """The shard a group asks for, null where none has room for all of it.

    First the shard that holds most of its documents; where that is full, the
    next one of its documents' shards; else one of all shards with room, drawn
    in proportion to their room.
    """
    members, held = F.col("members"), _longs(rooms)
    own = F.get(F.filter("near", lambda e: F.get(held, e["label"]) >= members), 0)["label"]
    order = sorted(range(len(rooms)), key=lambda k: (-rooms[k], k))
    upto = [0]
    for k in order:
        upto.append(upto[-1] + rooms[k])
    fitting = F.size(F.filter(_longs([rooms[k] for k in order]), lambda r: r >= members))
    drawn = F.pmod(F.xxhash64("group", F.lit(turn)), F.greatest(F.get(_longs(upto), fitting), F.lit(1)))
    at = F.size(F.filter(_longs(upto[1:]), lambda u: u <= drawn))
    return F.when(fitting > 0, F.coalesce(own, F.get(_longs(order), at).cast("int")))


def _grants(wishes: DataFrame, rooms: list[int]) -> tuple[Column, list[int], bool]:
    """Which wishes the shards grant (those of least rank, as far as their room goes), the room they leave, and if any is denied.

    The rank at which a shard is full is found by histograms of 16 bits of the
    rank, so no shard's wishes are sorted in one task; the driver sees a row per shard.
    """
    prefix, left, full, after = [0] * len(rooms), list(rooms), set(), list(rooms)
    for level in range(LEVELS):
        shift = LEVEL_BITS * (LEVELS - 1 - level)
        rows = wishes
        if level:
            at = _longs([prefix[k] if k in full else -1 for k in range(len(rooms))])
            rows = wishes.filter(F.shiftright("rank", shift + LEVEL_BITS) == F.get(at, F.col("shard")))
        bins = rows.groupBy("shard", F.shiftright("rank", shift).alias("bin")).agg(F.sum("members").alias("rows"))
        bins = bins.withColumn("upto", F.sum("rows").over(Window.partitionBy("shard").orderBy("bin")))
        over = F.when(F.col("upto") > F.get(_longs(left), F.col("shard")), F.struct("bin", (F.col("upto") - F.col("rows")).alias("before")))
        for r in bins.groupBy("shard").agg(F.min(over).alias("hit"), F.max("upto").alias("all")).collect():
            if r.hit is None:  # all of them fit; below the first level there is always a hit
                after[r.shard] = rooms[r.shard] - r["all"]
                continue
            full.add(r.shard)
            prefix[r.shard] = r.hit.bin
            left[r.shard] -= r.hit.before
            after[r.shard] = left[r.shard]
        if not full:
            break
    cut = _longs([prefix[k] if k in full else 1 << LEVEL_BITS * LEVELS for k in range(len(rooms))])
    return F.col("rank") < F.get(cut, F.col("shard")), after, bool(full)


def propagate(groups: DataFrame, rooms: list[int], scratch: Scratch) -> tuple[list[DataFrame], list[int]]:
    """Rounds of wishes and grants: the groups that moved in each round (with ``shard``), and the room that is left.

    ``groups``: group, members, ``near`` (documents of the group per shard, most
    first). Larger groups move first, by tiers of like size, and within a round
    by size. In a round every group that is not settled joins the labels of its
    documents, asks for one shard for all of them, and is granted it while the
    shard has room. Only settled groups take room: documents that have not moved
    yet, or have no equals, give way to those that come, so full shards exchange
    their documents. A tier ends when none of its groups fits any shard.
    """
    rooms, moves, turn = list(rooms), [], 0
    level = F.floor(F.log(float(TIER), F.col("members")) + 1e-9).cast("int")
    tiers = groups.groupBy(level.alias("level")).agg(F.max("members").alias("most"), F.min("members").alias("least")).orderBy(F.desc("level")).collect()
    for tier in tiers:
        asking = groups.filter(F.col("members").between(tier.least, tier.most))
        for _ in range(MOST_ROUNDS):
            if max(rooms) < tier.least:
                break
            turn += 1
            by_size = F.floor((tier.most - F.col("members")) * 65535 / max(tier.most - tier.least, 1)).cast("long")
            rank = F.shiftleft(by_size, 32) + F.shiftright(F.xxhash64("group", F.lit(-turn)), 32) + (1 << 31)
            wishes = asking.select("group", "members", "near", _wish(rooms, turn).alias("shard"), rank.alias("rank")).filter("shard IS NOT NULL")
            wishes = scratch.write(wishes, "wishes")
            granted, after, denied = _grants(wishes, rooms)
            if after != rooms:
                moves.append(wishes.filter(granted).select("group", "members", "near", "shard"))
            asking, rooms = wishes.filter(~granted).select("group", "members", "near"), after
            if not denied:
                break
        else:
            raise RuntimeError(f"labels not settled after {MOST_ROUNDS} rounds")
    return moves, rooms


def shard_documents(docs: DataFrame, shards: int = 40, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Shards of equal row counts that keep equal texts together: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Law ``rows``: the shards' counts differ by one at most. Documents start with
    a label by the hash of their id. Documents of equal texts are linked, and
    ``propagate`` moves them: every group adopts the shard of most of its
    documents where that has room, else another one, until no group that is
    still apart fits any shard. The state is a row per group with the counts of
    its documents by shard, not a row per link, so a group of any size is small.
    A group of more rows than a shard holds (there are fewer of them than
    shards) asks for as many whole shards as it fills, those with most of its
    documents first; its rest moves like a group of that size. Groups that fit
    nowhere lie over the room that is left, one after the other, and documents
    without equals fill it up; each cut fills a shard, so all in all there are
    fewer cuts than shards. Slots number a shard's rows by id.

    A null text has size ``OVERHEAD``, no checksum, and no equals; empty texts
    are equal to each other. Very long texts count by their hash only. Null ids
    are numbered first. Rows that repeat id and text are rows of their own and
    linked; which of them has which slot is open. Other columns are not read.
    Empty tables give no rows.
    """
    scratch, spark = Scratch(docs.sparkSession), docs.sparkSession
    raw = F.col(text)
    base = docs.select(F.col(doc_id).alias("doc_id"), (F.coalesce(F.octet_length(raw), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
                       F.crc32(raw.cast("binary")).alias("text_crc32"), F.unhex(F.md5(raw)).alias("group"))
    base = scratch.write(base, "base")
    total = base.count()
    quotas = [total // shards + (k < total % shards) for k in range(shards)]

    label = F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int")
    counts = base.filter("group IS NOT NULL").groupBy("group", label.alias("label")).agg(F.count(F.lit(1)).alias("n"))
    tie = F.hash("group", "label")  # of two shards with as many of its documents, the groups take either
    groups = counts.groupBy("group").agg(F.sum("n").alias("members"), F.sort_array(F.collect_list(F.struct("n", tie.alias("tie"), "label")), False).alias("near"))
    groups = scratch.write(groups.filter("members > 1"), "groups")

    rooms, hot, wholes = list(quotas), [], []
    for r in sorted(groups.filter(F.col("members") > max(quotas)).collect(), key=lambda r: (-r.members, bytes(r.group))):  # fewer than shards
        near, rest, whole = {e.label: e.n for e in r.near}, r.members, []
        while fits := [k for k in range(shards) if 0 < rooms[k] <= rest]:  # so far a shard is empty or full
            k = max(fits, key=lambda k: (near.get(k, 0), rooms[k], -k))
            whole.append((k, rooms[k]))
            rest, rooms[k] = rest - rooms[k], 0
        hot.append((bytearray(r.group), rest, [(e.n, e.tie, e.label) for e in r.near]))
        wholes.append(whole)
    rests = spark.createDataFrame([h for h in hot if h[1]], f"group binary, members long, near {_NEAR}")
    usual = groups.filter(F.col("members") <= max(quotas))
    moves, rooms = propagate(usual.unionByName(rests) if hot else usual, rooms, scratch)

    settled = reduce(DataFrame.unionByName, [m.select("group", "members", "shard") for m in moves]) if moves else None
    homes = {bytes(r.group): r.shard for r in settled.filter(F.col("group").isin([h[0] for h in hot])).collect()} if moves and hot else {}
    # the rows to be numbered are those of the hot groups, of groups that fit nowhere, and without equals, in this order
    runs: list[tuple[int, int]] = []
    for (group, rest, _), whole in zip(hot, wholes, strict=True):
        runs += [(rows, k) for k, rows in whole]
        home = homes.get(bytes(group))
        if home is not None:
            runs.append((rest, home))
            continue
        while rest:
            k = max(range(shards), key=lambda k: rooms[k])
            rows = min(rest, rooms[k])
            runs.append((rows, k))
            rest, rooms[k] = rest - rows, rooms[k] - rows
    runs += [(rooms[k], k) for k in sorted(range(shards), key=lambda k: -rooms[k]) if rooms[k]]
    upto = [sum(rows for rows, _ in runs[:i + 1]) for i in range(len(runs))]

    linked = groups.select(F.col("group").alias("l_group"), (-F.col("members")).alias("order"))
    if moves:
        to = settled.select(F.col("group").alias("s_group"), "shard")
        linked = linked.join(to, F.col("l_group") == F.col("s_group"), "left").drop("s_group")
        linked = linked.withColumn("shard", F.when(F.col("order") >= -max(quotas), F.col("shard")))
    else:
        linked = linked.withColumn("shard", F.lit(None).cast("int"))
    linked = scratch.write(linked, "homes")
    marked = base.join(linked, F.col("group") == F.col("l_group"), "left")
    marked = marked.select("doc_id", "size", "text_crc32", F.col("l_group").alias("group"), F.coalesce("order", F.lit(-1)).alias("order"), "shard")
    marked = scratch.write(marked, "marked")

    rows = ["doc_id", "size", "text_crc32", "shard"]
    placed = number_rows(marked.filter("shard IS NULL").drop("shard"), [], ["order", "group", "doc_id"], scratch, "place")
    if runs:
        at = F.size(F.filter(_longs(upto), lambda u: u <= F.col("place")))
        placed = placed.withColumn("shard", F.get(_longs([k for _, k in runs]), at).cast("int"))
    else:
        placed = placed.withColumn("shard", F.lit(None).cast("int"))
    both = scratch.write(marked.filter("shard IS NOT NULL").select(rows).unionByName(placed.select(rows)), "sharded")
    out = number_rows(both, ["shard"], ["doc_id", "text_crc32"], scratch, "slot")
    out = out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
    return finish(scratch, out, "shards")
