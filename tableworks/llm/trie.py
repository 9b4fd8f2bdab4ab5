"""The prefix trie of conversations: minimal-perfect-hash node tables per shard, and a small top joined by doubling."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .kernel import mix
from .scratch import Scratch, finish
from .spread import attach, number_rows, wide

# Nodes that a shard of whole subtrees, and characters that a piece of a list of ids, holds at most.
SHARD_NODES, PIECE_CHARS = 1_000_000, 1 << 20
# Nodes of several small shards put into one table.
TABLE_NODES = 100_000
KEY = ["hi", "lo"]
PARENT = ["parent_hi", "parent_lo"]


class SlotTable:
    """A minimal perfect hash of distinct 128-bit keys: key k has its own slot in 0..n-1.

    Each level hashes the keys left over into half as many places again; a key
    alone in its place stays there, the others go on. A slot is the number of
    taken places before it. ``find`` compares the key in the slot, so a key
    that is not in the table is told from one that merely hashes to its place.
    """

    LEVELS = 200

    def __init__(self, hi: np.ndarray, lo: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.hi, self.lo = np.empty_like(hi), np.empty_like(lo)
        left, first = np.arange(len(hi)), 0
        while len(left):
            if len(self.levels) == self.LEVELS:
                raise ValueError("repeated keys")
            size = len(left) + len(left) // 2 + 1
            place = self._place(hi[left], lo[left], size)
            alone = np.bincount(place, minlength=size) == 1
            slot = first + np.cumsum(alone) - 1
            self.levels.append((alone, slot))
            stays = alone[place]
            self.hi[slot[place[stays]]], self.lo[slot[place[stays]]] = hi[left[stays]], lo[left[stays]]
            first += int(stays.sum())
            left = left[~stays]

    def _place(self, hi: np.ndarray, lo: np.ndarray, size: int, level: int | None = None) -> np.ndarray:
        salt = np.uint64(0x9E3779B97F4A7C15 * (1 + (len(self.levels) if level is None else level)) % 2**64)
        return (mix(mix(hi.view(np.uint64) ^ salt) ^ lo.view(np.uint64)) % np.uint64(size)).astype(np.int64)

    def find(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Slots of the keys, -1 where a key is not in the table."""
        out = np.full(len(hi), -1, np.int64)
        left = np.arange(len(hi))
        for k, (alone, slot) in enumerate(self.levels):
            place = self._place(hi[left], lo[left], len(alone), k)
            here = alone[place]
            at, slots = left[here], slot[place[here]]
            same = (self.hi[slots] == hi[at]) & (self.lo[slots] == lo[at])
            out[at[same]] = slots[same]
            left = left[~here]
        return out


_NODE = "hi long, lo long, parent_hi long, parent_lo long, conv_id long, depth long, n_convs long, parent_conv_id long, n_children long, n_leaves long, saved_tokens long, top boolean"


def _table(rows: pa.Table) -> pa.RecordBatch:
    """Whole subtrees as flat arrays by slot, summed upwards depth by depth."""
    column = {c: rows[c].to_numpy() for c in ("hi", "lo", *PARENT, "conv_id", "depth", "n_convs", "bytes")}
    table = SlotTable(column["hi"], column["lo"])
    slots = table.find(column["hi"], column["lo"])
    flat = {c: np.empty_like(v) for c, v in column.items()}
    for c, v in column.items():
        flat[c][slots] = v
    parent = table.find(flat["parent_hi"], flat["parent_lo"])
    inner = parent >= 0
    children = np.bincount(parent[inner], minlength=len(parent))
    leaves = (children == 0).astype(np.int64)
    saved = (flat["n_convs"] - 1) * flat["bytes"]
    order = np.argsort(-flat["depth"], kind="stable")
    order = order[inner[order]]
    depth = flat["depth"][order]
    for part in np.split(order, np.flatnonzero(depth[1:] != depth[:-1]) + 1):
        np.add.at(leaves, parent[part], leaves[part])
        np.add.at(saved, parent[part], saved[part])
    above = pa.array(flat["conv_id"][np.maximum(parent, 0)], pa.int64(), mask=~inner)
    return pa.RecordBatch.from_pydict({
        **{c: flat[c] for c in ("hi", "lo", *PARENT, "conv_id", "depth", "n_convs")}, "parent_conv_id": above,
        "n_children": children.astype(np.int64), "n_leaves": leaves, "saved_tokens": saved, "top": ~inner,
    })


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sorted partition's shards; small ones share a table, none is cut."""
    held, waiting = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        waiting += batch.num_rows
        if waiting >= TABLE_NODES:
            rows = pa.Table.from_batches(held)
            shard = np.stack([rows["shard_hi"].to_numpy(), rows["shard_lo"].to_numpy()])
            starts = np.flatnonzero((shard[:, 1:] != shard[:, :-1]).any(axis=0))
            if len(starts):
                yield _table(rows.slice(0, int(starts[-1]) + 1))
                rows = rows.slice(int(starts[-1]) + 1)
            held, waiting = rows.to_batches(), rows.num_rows
    if held:
        yield _table(pa.Table.from_batches(held))


def _id_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sorted partition's ids, comma-joined per node in pieces."""
    key, ids, size, out = None, [], 0, []

    def rows():
        return pa.RecordBatch.from_pydict({c: pa.array(v, pa.string() if c == "ids" else pa.int64()) for c, v in zip((*KEY, "first", "ids"), zip(*out))})

    for batch in batches:
        for *new, conv in zip(*(batch[c].to_pylist() for c in (*KEY, "conv_id"))):
            if ids and (new != key or size >= PIECE_CHARS):
                out.append((*key, int(ids[0]), ",".join(ids)))
                ids, size = [], 0
                if len(out) == 500:
                    yield rows()
                    out = []
            key = new
            ids.append(str(conv))
            size += len(ids[-1]) + 1
    if ids:
        out.append((*key, int(ids[0]), ",".join(ids)))
    if out:
        yield rows()


def _id_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces in turn; one piece is held at a time."""
    key, digest, out = None, None, []

    def rows():
        return pa.RecordBatch.from_pydict({c: pa.array(v, pa.string() if c == "ends_sha256" else pa.int64()) for c, v in zip((*KEY, "ends_sha256"), zip(*out))})

    for batch in batches:
        for *new, ids in zip(*(batch[c].to_pylist() for c in (*KEY, "ids"))):
            if new != key:
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                    if len(out) == 10_000:
                        yield rows()
                        out = []
                key, digest = new, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
    if key is not None:
        out.append((*key, digest.hexdigest()))
        yield rows()


def numbered_turns(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """Turns as narrow rows: conv_id, k (from 0 by turn, null first; ties by the mark), mark (SHA-256 of role and text), bytes."""
    role, text = (F.coalesce(conversations[c].cast("string"), F.lit("")) for c in ("role", "text"))
    mark = F.unhex(F.sha2(F.concat(F.length(F.encode(role, "UTF-8")).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    rows = conversations.filter(conversations["conv_id"].isNotNull()).select(
        conversations["conv_id"].cast("long").alias("conv_id"), conversations["turn"].alias("turn"), mark.alias("mark"), F.octet_length(text).cast("long").alias("bytes"))
    return scratch.write(number_rows(rows, ["conv_id"], ["turn", "mark"], scratch, "k").select("conv_id", "k", "mark", "bytes"), "turns")


def with_shared_heads(turns: DataFrame, scratch: Scratch, step: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Rebuild each conversation: the first h turns of the one at the next lower multiple of ``step``, then its own after its first h.

    h is the crc32 of its decimal id modulo ``heads``. Returns the turns
    (conv_id, depth from 1, left: turns after it, mark, bytes) and all
    conversations (conv_id, length), those without turns too.
    """
    lengths = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    lengths = scratch.write(lengths.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).withColumn("base", F.col("conv_id") - F.col("conv_id") % step), "lengths")
    below = lengths.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    plan = lengths.join(below, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_own", F.lit(0))))
    plan = scratch.write(plan.withColumn("length", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "plan")
    mine = turns.join(plan.select("conv_id", "h", "taken", "length"), "conv_id").filter("k >= h")
    mine = mine.select("conv_id", (F.col("k") - F.col("h") + F.col("taken") + 1).alias("depth"), "length", "mark", "bytes")
    first = turns.filter((F.col("conv_id") % step == 0) & (F.col("k") < heads - 1)).withColumnRenamed("conv_id", "base")
    lent = first.join(plan.select("conv_id", "base", "h", "length"), "base").filter("k < h").select("conv_id", (F.col("k") + 1).alias("depth"), "length", "mark", "bytes")
    rebuilt = mine.unionByName(lent).select("conv_id", "depth", (F.col("length") - F.col("depth")).alias("left"), "mark", "bytes")
    return rebuilt, plan.select("conv_id", "length")


def _digests(sums: list[Column], depth: Column, salt: int) -> list[Column]:
    return [F.xxhash64(F.lit(salt), F.lit(k), *sums, depth.cast("long")) for k in range(2)]


def _paths(turns: DataFrame, salt: int, scratch: Scratch) -> DataFrame:
    """Digest of every prefix and of the prefix before it.

    A prefix is digested from the sums of four 31-bit hashes of its (depth,
    mark) pairs. Sums, unlike a chain, can be made in range pieces whose totals
    are carried on, so a conversation of any length is cut.
    """
    names = [f"s{k}" for k in range(4)]
    parts = [F.xxhash64(F.lit(salt), F.lit(k), "depth", "mark").bitwiseAND(0x7FFFFFFF).alias(n) for k, n in enumerate(names)]
    pieces = turns.select("conv_id", "depth", "left", F.xxhash64("mark").alias("mark"), "bytes", *parts)
    pieces = scratch.write(pieces.repartitionByRange(wide(turns), "conv_id", "depth").withColumn("piece", F.spark_partition_id()), "pieces")
    by = Window.partitionBy("conv_id").orderBy("piece")
    totals = pieces.groupBy("conv_id", "piece").agg(*[F.sum(n).alias(n) for n in names])
    carried = totals.select("conv_id", "piece", F.row_number().over(by).alias("nth"), *[(F.sum(n).over(by) - F.col(n)).alias(f"before_{n}") for n in names])
    # only a conversation cut by a piece's bound has a second piece: at most one row per bound
    carried = scratch.write(carried.filter("nth > 1").drop("nth"), "carried")
    inside = Window.partitionBy("piece", "conv_id").orderBy("depth")
    local = pieces.select("*", *[F.sum(n).over(inside).alias(f"upto_{n}") for n in names])
    local = attach(local, carried, ["conv_id", "piece"], "left")
    upto = [F.col(f"upto_{n}") + F.coalesce(f"before_{n}", F.lit(0)) for n in names]
    before = [u - F.col(n) for u, n in zip(upto, names)]
    keys = [*_digests(upto, F.col("depth"), salt), *_digests(before, F.col("depth") - 1, salt)]
    out = local.select("conv_id", "depth", "left", "mark", "bytes", *[k.alias(n) for k, n in zip(keys, [*KEY, *PARENT])])
    out = scratch.write(out, "paths")
    scratch.drop(pieces, carried)
    return out


def _verified_nodes(turns: DataFrame, scratch: Scratch, salts: int = 8) -> tuple[DataFrame, DataFrame, int]:
    """Paths and their distinct prefixes; where two different prefixes share a digest, all are digested anew with another salt."""
    same = ["depth", *PARENT, "mark", "bytes"]
    for salt in range(salts):
        paths = _paths(turns, salt, scratch)
        nodes = scratch.write(paths.groupBy(*KEY).agg(
            F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum(F.col("left") + 1).alias("weight"),
            *[F.min(c).alias(c) for c in same], *[F.max(c).alias(f"most_{c}") for c in same]), "nodes")
        clash = " or ".join(f"{c} <> most_{c}" for c in same)
        if nodes.filter(clash).isEmpty():
            return paths, nodes.select(*KEY, *PARENT, "conv_id", "depth", "n_convs", "bytes", "weight"), salt
        scratch.drop(paths, nodes)
    raise RuntimeError(f"prefix digests clash under {salts} salts")


def _sum_upwards(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """Subtree sums of ``n_leaves`` and ``saved_tokens`` by doubling: a join per doubling of the depth, not per depth."""
    state = scratch.write(nodes.select(*KEY, *[F.col(p).alias(a) for p, a in zip(PARENT, ("up_hi", "up_lo"))], "n_leaves", "saved_tokens"), "sums")
    while not state.filter("up_hi is not null").isEmpty():
        given = state.filter("up_hi is not null").groupBy("up_hi", "up_lo").agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
        given = given.withColumnsRenamed({"up_hi": "hi", "up_lo": "lo"})
        further = state.select(F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"), F.col("up_hi").alias("next_hi"), F.col("up_lo").alias("next_lo"))
        new = state.join(given, KEY, "left").join(further, ["up_hi", "up_lo"], "left").select(
            *KEY, F.col("next_hi").alias("up_hi"), F.col("next_lo").alias("up_lo"),
            (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"), (F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"))
        previous, state = state, scratch.write(new, "sums")
        scratch.drop(previous)
    return state.select(*KEY, "n_leaves", "saved_tokens")


def prefix_trie(turns: DataFrame, convs: DataFrame, scratch: Scratch) -> DataFrame:
    """A row per distinct prefix of the conversations in ``turns`` (conv_id, depth from 1, left, mark, bytes).

    ``convs`` (conv_id, length) lists all members. Returns conv_id (the smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256; see ``conversation_trie``.

    Prefixes are enumerated by digest and verified. Subtrees of at most
    ``SHARD_NODES`` turns, and at most an even share of all, are shards: each
    becomes a ``SlotTable`` whose arrays are summed through parent slots in
    depth order. The prefixes above them, those that very many turns share, are
    summed by doubling joins, so a common first turn or a conversation that
    many repeat is spread over many tasks.
    """
    if convs.isEmpty():
        return finish(scratch, convs.sparkSession.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"), "trie")
    paths, nodes, salt = _verified_nodes(turns, scratch)
    size = paths.count()
    most = max(1, min(SHARD_NODES, -(-size // wide(paths))))
    none = F.lit(None).cast("long")
    root_key = [k.alias(n) for k, n in zip(_digests([F.lit(0).cast("long")] * 4, F.lit(0), salt), KEY)]
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).select(
        *root_key, *[none.alias(p) for p in PARENT], "conv_id", F.lit(0).cast("long").alias("depth"), "n_convs", F.lit(0).cast("long").alias("bytes"))
    upper = scratch.write(nodes.filter(F.col("weight") > most).drop("weight").unionByName(root), "upper")

    flagged = attach(paths.select("conv_id", "depth", *KEY), scratch.write(upper.select(*KEY, F.lit(True).alias("is_upper")), "flags"), KEY, "left")
    begins = flagged.filter("is_upper is null").groupBy("conv_id").agg(F.min(F.struct("depth", *KEY)).alias("at"))
    begins = begins.select("conv_id", F.col("at.hi").alias("shard_hi"), F.col("at.lo").alias("shard_lo"))
    lower = nodes.filter(F.col("weight") <= most).drop("weight").join(begins, "conv_id")
    lower = lower.repartition(wide(paths), "shard_hi", "shard_lo").sortWithinPartitions("shard_hi", "shard_lo")
    lower = scratch.write(lower.mapInArrow(_tables, _NODE), "lower")

    tops = lower.filter("top").groupBy(*PARENT).agg(F.count(F.lit(1)).alias("light"), F.sum("n_leaves").alias("light_leaves"), F.sum("saved_tokens").alias("light_saved"))
    kids = upper.filter("parent_hi is not null").groupBy(*PARENT).agg(F.count(F.lit(1)).alias("heavy"))
    rename = dict(zip(PARENT, KEY))
    own = upper.join(tops.withColumnsRenamed(rename), KEY, "left").join(kids.withColumnsRenamed(rename), KEY, "left").fillna(0, ["light", "light_leaves", "light_saved", "heavy"])
    own = own.withColumn("n_children", F.col("light") + F.col("heavy"))
    own = own.withColumn("n_leaves", F.when(F.col("n_children") == 0, 1).otherwise(0) + F.col("light_leaves"))
    own = scratch.write(own.withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("bytes") + F.col("light_saved")), "own")
    above = scratch.write(upper.select(F.col("hi").alias("parent_hi"), F.col("lo").alias("parent_lo"), F.col("conv_id").alias("upper_conv_id")), "above")
    shown = [*KEY, "conv_id", "depth", "n_convs", "parent_conv_id", "n_children", "n_leaves", "saved_tokens"]
    summed = own.drop("n_leaves", "saved_tokens").join(_sum_upwards(own, scratch), KEY)
    summed = attach(summed, above, PARENT, "left").withColumnRenamed("upper_conv_id", "parent_conv_id").select(*shown)
    lower = attach(lower, above, PARENT, "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "upper_conv_id")).select(*shown)

    ends = paths.filter("left = 0").select(*KEY, "conv_id").unionByName(convs.filter("length = 0").select(*root_key, "conv_id"))
    pieces = ends.repartitionByRange(wide(paths), *KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id").mapInArrow(_id_pieces, "hi long, lo long, first long, ids string")
    digests = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(_id_digests, "hi long, lo long, ends_sha256 string")
    out = lower.unionByName(summed).join(digests, KEY, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)))
    return finish(scratch, out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"), "trie")


def conversation_trie(conversations: DataFrame, step: int = 5, heads: int = 9) -> DataFrame:
    """The prefix trie of conversations that are first rebuilt with shared heads (``with_shared_heads``).

    A node is a distinct sequence of first d turns (role and text); the root has
    none. Per node: conv_id (smallest member), depth, parent_conv_id (its
    parent's conv_id, null for the root), n_convs (members), n_children,
    n_leaves (childless nodes in its subtree, itself included), saved_tokens
    (over its subtree, members but one times the UTF-8 bytes of the last text)
    and ends_sha256 (SHA-256 of the decimal ids, ascending and comma-joined, of
    members that end there; of nothing where none does).

    Turns are ordered by turn, null first; equal turns by the SHA-256 of role
    and text, repeats stay turns of their own. Null role or text is empty; rows
    without conv_id belong to no conversation and are left out; an empty table
    has no nodes. Texts are read once, whole, and only their digests and sizes
    are moved. Other columns are not read.
    """
    scratch = Scratch(conversations.sparkSession)
    turns, convs = with_shared_heads(numbered_turns(conversations, scratch), scratch, step, heads)
    return prefix_trie(turns, convs, scratch)
