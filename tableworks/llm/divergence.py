"""How the sources of a language diverge in their terms, counted through whitespace chunks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .kernel import SPACES, text_bytes
from .scratch import Scratch, finish
from .spread import attach, number_rows

# Bytes of text whose chunks are counted together; a longer text is counted alone.
SLICE_BYTES = 32 << 20
# Rows merged at once when the slices' terms come together.
MERGE_ROWS = 100_000
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SCALE = 1_000_000_000
# Terms, and terms times sources, that a block of the pair sums holds at most.
BLOCK_TERMS, BLOCK_CELLS = 4096, 1 << 23

# White space becomes a space and A-Z become a-z, which terms do anyway: fewer chunks differ.
_FOLD = np.where(SPACES, 32, np.arange(256)).astype(np.uint8)
_FOLD[65:91] += 32


def gathered(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """Batches together until they hold ``limit`` bytes."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size >= limit:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def chunk_counts(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct whitespace chunks of some texts, and per chunk (``bounds``) its documents and its count in each."""
    data, bounds = text_bytes(texts)
    n = len(texts)
    folded = pa.LargeStringArray.from_buffers(n, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(_FOLD[data]))
    split = pc.split_pattern(folded, " ")
    coded = pc.dictionary_encode(split.flatten())
    code = coded.indices.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(split.offsets.to_numpy()))
    gap = pc.index(coded.dictionary, pa.scalar("", coded.dictionary.type)).as_py()
    real = code != gap
    keys, counts = np.unique(code[real] * n + doc[real], return_counts=True)
    return coded.dictionary, np.searchsorted(keys // n, np.arange(len(coded.dictionary) + 1)), keys % n, counts


def _packed(values: np.ndarray) -> bytes:
    """Compressed byte planes: the high bytes of small numbers are all zero."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


_SLICE = "slice long, chunks string, sizes binary, docs binary, counts binary, members binary, langs array<string>, sources array<string>"


def _count_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    first = TaskContext.get().partitionId() << 32
    for k, rows in enumerate(gathered(batches, SLICE_BYTES)):
        chunks, bounds, docs, counts = chunk_counts(rows["text"].combine_chunks())
        groups: dict[tuple[str, str], int] = {}
        members = [groups.setdefault(g, len(groups)) for g in zip(rows["lang"].to_pylist(), rows["source"].to_pylist())]
        yield pa.RecordBatch.from_pydict({
            "slice": pa.array([first + k], pa.int64()), "chunks": [" ".join(chunks.to_pylist())],
            "sizes": [_packed(np.diff(bounds))], "docs": [_packed(docs)], "counts": [_packed(counts)], "members": [_packed(np.array(members))],
            "langs": pa.array([[g[0] for g in groups]], pa.list_(pa.string())), "sources": pa.array([[g[1] for g in groups]], pa.list_(pa.string())),
        })


def _runs(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    fresh = np.ones(len(values), dtype=bool)
    fresh[1:] = values[1:] != values[:-1]
    return np.flatnonzero(fresh)


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values, kind))


_TALLY = "language int, term string, docs long, groups array<int>, times array<long>"
_TALLY_ARROW = pa.schema([("language", pa.int32()), ("term", pa.string()), ("docs", pa.int64()), ("groups", pa.list_(pa.int32())), ("times", pa.list_(pa.int64()))])


_CELLS = "language int, term string, cells binary"
_CELLS_ARROW = pa.schema([("language", pa.int32()), ("term", pa.string()), ("cells", pa.binary())])


def packed_cells(docs: np.ndarray, sizes: np.ndarray, groups: np.ndarray, times: np.ndarray) -> pa.BinaryArray:
    """Per row its documents, then a group and its count in turn, as 32-bit integers: a slice's counts fit them."""
    row = np.repeat(np.arange(len(docs)), sizes)
    begin = np.concatenate([[0], np.cumsum(1 + 2 * sizes)])
    out = np.empty(begin[-1], "<u4")
    out[begin[:-1]] = docs
    at = 2 * np.arange(len(groups)) + row + 1
    out[at], out[at + 1] = groups, times
    return pa.BinaryArray.from_buffers(pa.binary(), len(docs), [None, pa.py_buffer((4 * begin).astype(np.int32)), pa.py_buffer(out)])


def _spread_cells(batch: pa.RecordBatch) -> pa.Table:
    cells = batch.column("cells")
    begin = np.frombuffer(cells.buffers()[1], np.int32)[cells.offset:cells.offset + len(cells) + 1].astype(np.int64) // 4
    flat = np.frombuffer(cells.buffers()[2], "<u4").astype(np.int64)[begin[0]:begin[-1]]
    begin -= begin[0]
    docs = np.zeros(len(flat), dtype=bool)
    docs[begin[:-1]] = True
    pairs = flat[~docs]
    sizes = (np.diff(begin) - 1) // 2
    return pa.Table.from_arrays([batch.column("language"), batch.column("term").cast(pa.string()), pa.array(flat[docs]), _lists(pairs[::2], sizes, pa.int32()), _lists(pairs[1::2], sizes, pa.int64())], schema=_TALLY_ARROW)


def _tally(terms: pa.Table, slices: pa.Table) -> pa.Table:
    """A slice's terms: distinct documents per language, occurrences per group."""
    if not terms.num_rows or not slices.num_rows:
        return _CELLS_ARROW.empty_table()
    held, docs, counts, members = (_unpacked(slices[c][0].as_py()) for c in ("sizes", "docs", "counts", "members"))
    bounds = np.concatenate([[0], np.cumsum(held)])
    language, group = (np.array(slices[c][0].as_py(), np.int64)[members] for c in ("languages", "numbers"))
    coded = pc.dictionary_encode(terms["term"].combine_chunks())
    code, no = coded.indices.to_numpy().astype(np.int64), terms["no"].to_numpy()
    sizes = bounds[no + 1] - bounds[no]
    upto = np.concatenate([[0], np.cumsum(sizes)])
    place = np.arange(upto[-1]) + np.repeat(bounds[no] - upto[:-1], sizes)
    # a row per term and document first: several chunks of a document may hold the term, and a chunk may repeat it
    keys = np.repeat(code, sizes) * len(members) + docs[place]
    order = np.argsort(keys, kind="stable")
    at = _runs(keys[order])
    times = np.add.reduceat(counts[place][order], at)
    keys = keys[order][at]
    code, doc = keys // len(members), keys % len(members)
    order = np.lexsort((group[doc], language[doc], code))
    code, doc, times = code[order], doc[order], times[order]
    cell = _runs((code * (group.max() + 1)) + group[doc])
    times, cell_code, cell_language, cell_group = np.add.reduceat(times, cell), code[cell], language[doc[cell]], group[doc[cell]]
    row = _runs(cell_code * (language.max() + 1) + cell_language)
    return pa.Table.from_arrays([
        pa.array(cell_language[row], pa.int32()), coded.dictionary.take(pa.array(cell_code[row])).cast(pa.string()),
        packed_cells(np.diff(np.append(cell[row], len(code))), np.diff(np.append(row, len(cell))), cell_group, times),
    ], schema=_CELLS_ARROW)


def _merged(rows: pa.Table) -> pa.Table:
    """Rows sorted by (language, term), equal ones as one."""
    rows = rows.combine_chunks()
    code = pc.dictionary_encode(rows["term"].combine_chunks()).indices.to_numpy().astype(np.int64)
    language = rows["language"].to_numpy().astype(np.int64)
    run = _runs(code * (language.max() + 1) + language)
    of_row = np.repeat(np.arange(len(run)), np.diff(np.append(run, len(code))))
    docs = np.add.reduceat(rows["docs"].to_numpy(), run)
    groups, times = rows["groups"].combine_chunks(), rows["times"].combine_chunks()
    of_cell = np.repeat(of_row, pc.list_value_length(groups).to_numpy(zero_copy_only=False))
    group, times = groups.flatten().to_numpy().astype(np.int64), times.flatten().to_numpy()
    order = np.lexsort((group, of_cell))
    of_cell, group = of_cell[order], group[order]
    cell = _runs(of_cell * (group.max() + 1) + group)
    times = np.add.reduceat(times[order], cell)
    sizes = np.bincount(of_cell[cell], minlength=len(run))
    return pa.Table.from_arrays([
        pa.array(language[run], pa.int32()), rows["term"].combine_chunks().take(pa.array(run)), pa.array(docs, pa.int64()),
        _lists(group[cell], sizes, pa.int32()), _lists(times, sizes, pa.int64()),
    ], schema=_TALLY_ARROW)


def _merge_terms(least_docs: int):
    """Merge a sorted partition; a term of very many slices is held as one row while it runs on."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def kept(rows: pa.Table) -> list[pa.RecordBatch]:
            return rows.filter(pc.greater_equal(rows["docs"], least_docs)).to_batches()

        held: list[pa.Table] = []
        waiting = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(_spread_cells(batch))
            waiting += batch.num_rows
            if waiting >= MERGE_ROWS:
                rows = _merged(pa.concat_tables(held))
                yield from kept(rows.slice(0, rows.num_rows - 1))
                held, waiting = [rows.slice(rows.num_rows - 1)], 1
        if held:
            yield from kept(_merged(pa.concat_tables(held)))

    return merge


def exact_shares(times: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (times + 2) / total); in unbounded integers where 64 bits would not do."""
    if len(total) and int(np.max(times, initial=0)) + 2 > (2**63 - 1) // SCALE:
        times, total = times.astype(object), total.astype(object)
    return (1 + SCALE * (times + 2) // total).astype(np.int64)


_PAIR = "language int, a int, b int, value long"
_PAIR_ARROW = pa.schema([("language", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("value", pa.int64())])


def _pair_sums(terms: pa.Table, sources: pa.Table) -> pa.Table:
    """For every two sources of a language the sum over a block of terms; a source without a term has the share of no occurrence."""
    n = sources.num_rows
    if n < 2:
        return _PAIR_ARROW.empty_table()
    at = np.argsort(sources["place"].to_numpy())
    total = (sources["n"].to_numpy() + 2 * sources["v"].to_numpy())[at]
    first = int(pc.min(sources["group"]).as_py())
    sums = np.zeros((n, n), np.int64) if terms.num_rows == 0 else None
    if sums is None:
        groups = terms["groups"].combine_chunks()
        row = np.repeat(np.arange(terms.num_rows), pc.list_value_length(groups).to_numpy(zero_copy_only=False))
        column = groups.flatten().to_numpy().astype(np.int64) - first
        share = np.tile(exact_shares(np.zeros(n, np.int64), total), (terms.num_rows, 1))
        share[row, column] = exact_shares(terms["times"].combine_chunks().flatten().to_numpy(), total[column])
    columns = []
    for a in range(n - 1):
        if sums is None:
            p, q = share[:, a:a + 1], share[:, a + 1:]
            gap = p - q
            value = (gap * gap // (p + q)).sum(axis=0)
        else:
            value = sums[a, a + 1:]
        columns.append((np.full(n - 1 - a, a), np.arange(a + 1, n), value))
    a, b, value = (np.concatenate(c) for c in zip(*columns))
    language = np.full(len(a), sources["language"][0].as_py())
    return pa.Table.from_arrays([pa.array(language, pa.int32()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(value, pa.int64())], schema=_PAIR_ARROW)


def _share(times: Column, n: Column, v: Column) -> Column:
    """The exact share in whole billionths: decimals, since the product outgrows a long in a large corpus."""
    up = (F.lit(SCALE).cast("decimal(10,0)") * (times + 2).cast("decimal(19,0)")).cast("decimal(29,0)")
    return F.lit(1).cast("long") + F.call_function("div", up, (n + 2 * v).cast("decimal(20,0)")).cast("long")


def _gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def source_divergence(docs: DataFrame, least_docs: int = 10, top: int = 10) -> DataFrame:
    """Exact divergence of every (lang, source) group from its language's other sources and from its language.

    Returns lang, source, part, item, value, rank. Part ``pair`` has a row per
    other source of the language, part ``term`` the ``top`` terms whose share in
    the group is above that in the language. A language keeps the terms found in
    at least ``least_docs`` of its documents (rows of ``docs``).

    Whitespace chunks are counted per document in slices of 32 MB of text; each
    globally distinct chunk is split into terms once, at its first row in a
    partition by chunk, and its other rows are joined with that one, so the
    terms go back to the slices, where a slice counts a term's distinct documents and its
    occurrences per group. Slices' terms are merged in sorted streams, and a
    frequent chunk or term has one row per slice, however many documents hold it.
    Pair sums run over blocks of terms.

    Null text, lang and source count as empty strings; an empty text has no term
    but its group is there; every row is a document of its own, repeats too; an
    empty table gives no rows. Texts are read whole, of any length. Ties in
    value are ranked by item in UTF-8 order. Other columns are not read. A
    language without kept terms has pairs of value 0.
    """
    scratch = Scratch(docs.sparkSession)
    base = docs.select(*[F.coalesce(docs[c], F.lit("")).alias(c) for c in ("lang", "source", "text")])
    named = scratch.write(number_rows(base.select("lang", "source").distinct(), [], ["lang", "source"], scratch, "group"), "groups")
    firsts = named.groupBy("lang").agg(F.min("group").alias("first"), F.count(F.lit(1)).alias("n_sources"))
    languages = scratch.write(number_rows(firsts, [], ["lang"], scratch, "language"), "languages")
    named = attach(named, languages, ["lang"])
    named = scratch.write(named.select("lang", "source", F.col("group").cast("int"), F.col("language").cast("int"),
                                       (F.col("group") - F.col("first")).cast("int").alias("place"), "n_sources"), "groups")

    slices = scratch.write(base.mapInArrow(_count_slices, _SLICE), "slices")
    chunks = slices.select("slice", F.posexplode(F.split("chunks", " ")).alias("no", "chunk"))
    # one exchange by chunk serves the distinct chunks and the join: a chunk is split at its first row, the others take its terms
    alike = Window.partitionBy("chunk").orderBy("slice")
    first = F.row_number().over(alike) == 1
    spelled = F.regexp_extract_all(F.translate("chunk", UPPER, LOWER), F.lit(TERM), F.lit(0))
    split = chunks.withColumn("first", first).withColumn("spelled", F.when(F.col("first"), spelled))
    terms = split.withColumn("spelled", F.first("spelled", ignorenulls=True).over(alike)).select("slice", "no", F.explode("spelled").alias("term"))

    local = slices.select("slice", F.posexplode(F.arrays_zip("langs", "sources")).alias("k", "of"))
    local = attach(local.select("slice", "k", "of.langs", "of.sources").toDF("slice", "k", "lang", "source"), named, ["lang", "source"])
    local = local.groupBy("slice").agg(F.sort_array(F.collect_list(F.struct("k", "language", "group"))).alias("of"))
    local = local.select("slice", F.col("of.language").alias("languages"), F.col("of.group").alias("numbers"))
    counted = slices.select(F.col("slice").alias("of_slice"), "sizes", "docs", "counts", "members").join(local.withColumnRenamed("slice", "of_slice"), "of_slice")
    tallied = terms.groupBy("slice").cogroup(counted.groupBy("of_slice")).applyInArrow(_tally, _CELLS)
    ordered = tallied.repartition("language", "term").sortWithinPartitions("language", "term")
    kept = scratch.write(ordered.mapInArrow(_merge_terms(least_docs), _TALLY), "terms")

    cells = kept.select("language", "term", F.explode(F.arrays_zip("groups", "times")).alias("cell"))
    cells = cells.select("language", "term", F.col("cell.groups").alias("group"), F.col("cell.times").alias("times"))
    in_group = scratch.write(cells.groupBy("group").agg(F.sum("times").alias("n")), "totals")
    whole = F.aggregate("times", F.lit(0).cast("long"), lambda a, x: a + x)
    kept = kept.withColumn("whole", whole)
    in_language = scratch.write(kept.groupBy("language").agg(F.sum("whole").alias("whole_n"), F.count(F.lit(1)).alias("v")), "totals")
    totals = attach(attach(named, in_group, ["group"], "left"), in_language, ["language"], "left")
    totals = scratch.write(totals.fillna(0, ["n", "whole_n", "v"]), "totals")

    apart = kept.select("language", "term", "whole", F.explode(F.arrays_zip("groups", "times")).alias("cell"))
    apart = apart.select("term", "whole", F.col("cell.groups").alias("group"), F.col("cell.times").alias("times"))
    apart = attach(apart, totals.drop("language", "place", "n_sources"), ["group"])
    apart = apart.withColumn("p", _share(F.col("times"), F.col("n"), F.col("v"))).withColumn("q", _share(F.col("whole"), F.col("whole_n"), F.col("v")))
    apart = apart.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _gap(F.col("p"), F.col("q")).alias("value"))
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    apart = apart.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top)

    n_blocks = F.greatest(F.ceil(F.col("v") / BLOCK_TERMS), F.ceil(F.col("v") * F.col("n_sources") / BLOCK_CELLS), F.lit(1)).cast("int")
    blocks = scratch.write(totals.groupBy("language").agg(F.max("v").alias("v"), F.max("n_sources").alias("n_sources")).select("language", n_blocks.alias("blocks")), "blocks")
    sides = attach(totals.filter("n_sources > 1"), blocks, ["language"])
    sides = sides.select("language", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "group", "place", "n", "v")
    dealt = attach(kept.select("language", "term", "groups", "times"), blocks, ["language"])
    dealt = dealt.select("language", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"), "groups", "times")
    sums = dealt.groupBy("language", "block").cogroup(sides.groupBy("language", "block")).applyInArrow(_pair_sums, _PAIR)
    sums = scratch.write(sums.groupBy("language", "a", "b").agg(F.sum("value").alias("value")), "pairs")
    turned = sums.unionByName(sums.select("language", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    names = totals.select("language", F.col("place").alias("a"), "lang", "source")
    pairs = attach(attach(turned, names, ["language", "a"]), names.select("language", F.col("a").alias("b"), F.col("source").alias("item")), ["language", "b"])
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(by))
    return finish(scratch, apart.unionByName(pairs), "divergence")
