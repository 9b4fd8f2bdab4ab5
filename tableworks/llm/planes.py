"""Token ids in files of shuffled bit or byte planes."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .files import reading, writing
from .kernel import slices, text_bytes
from .scratch import Scratch, finish

BLOCK = 1 << 16
MAGIC = b"IDPLANE1"
# Words remembered by a Python worker; the memory is emptied when full.
KNOWN_WORDS = 1_000_000


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """The ids' bytes (4 planes) or bits (32 planes), each plane of all ids together, low to high; empty where all zero."""
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    planes = []
    for i in range(4):
        column = np.ascontiguousarray(raw[:, i])
        if kind == "byte":
            planes.append(column.tobytes() if column.any() else b"")
        elif not column.any():
            planes += [b""] * 8
        else:
            bits = (np.packbits(column & np.uint8(1 << k), bitorder="little") for k in range(8))
            planes += [b.tobytes() if b.any() else b"" for b in bits]
    return planes


def from_planes(planes: list[bytes], kind: str, count: int) -> np.ndarray:
    raw = np.zeros((4, count), np.uint8)
    for i, plane in enumerate(planes):
        if not plane:
            continue
        if kind == "byte":
            raw[i] = np.frombuffer(plane, np.uint8)
        else:
            raw[i // 8] |= np.unpackbits(np.frombuffer(plane, np.uint8), count=count, bitorder="little") << np.uint8(i % 8)
    return np.ascontiguousarray(raw.T).view("<u4").ravel()


class PlaneWriter:
    """A file of planes: blocks of ``BLOCK`` ids, each plane a zstandard frame (nothing where it is all zero).

    ``close`` writes the index after the blocks: per block its offset, number of
    ids and plane lengths; then the documents' ids and sizes; then the index's
    offset and length, and the magic again.
    """

    def __init__(self, out, kind: str = "bit", level: int = 3):
        self.out, self.kind, self.engine = out, kind, zstandard.ZstdCompressor(level=level)
        self.held: list[np.ndarray] = []
        self.waiting = 0
        self.at = self.out.write(MAGIC) or len(MAGIC)
        self.blocks: list[list] = []
        self.docs: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.total = 0

    def add(self, doc_ids: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append(doc_ids.astype("<i8"))
        self.sizes.append(sizes.astype("<i8"))
        self.held.append(ids)
        self.waiting += len(ids)
        self.total += len(ids)
        if self.waiting >= BLOCK:
            every = np.concatenate(self.held)
            full = len(every) // BLOCK * BLOCK
            for at in range(0, full, BLOCK):
                self._block(every[at:at + BLOCK])
            self.held, self.waiting = [every[full:]], len(every) - full

    def _block(self, ids: np.ndarray) -> None:
        lengths = []
        start = self.at
        for plane in to_planes(ids, self.kind):
            packed = self.engine.compress(plane) if plane else b""
            self.out.write(packed)
            self.at += len(packed)
            lengths.append(len(packed))
        self.blocks.append([start, len(ids), lengths])

    def close(self) -> None:
        if self.waiting:
            self._block(np.concatenate(self.held))
        tables = [self.engine.compress(np.concatenate(c).tobytes() if c else b"") for c in (self.docs, self.sizes)]
        head = json.dumps({"kind": self.kind, "blocks": self.blocks, "tables": [len(t) for t in tables]}).encode()
        for part in (*tables, head):
            self.out.write(part)
        start = self.at + sum(map(len, tables))
        self.out.write(np.array([start, len(head)], "<u8").tobytes() + MAGIC)


class PlaneReader:
    """Documents of a plane file, block by block."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        source.seek(size - 24)
        tail = source.read(24)
        if tail[16:] != MAGIC:
            raise ValueError("not a plane file, or not complete")
        start, length = np.frombuffer(tail[:16], "<u8").tolist()
        source.seek(start)
        head = json.loads(source.read(length))
        self.kind, self.blocks = head["kind"], head["blocks"]
        first = start - sum(head["tables"])
        source.seek(first)
        self.engine = zstandard.ZstdDecompressor()
        self.doc_ids, self.sizes = (np.frombuffer(self.engine.decompress(source.read(n)), "<i8") for n in head["tables"])

    def block(self, k: int) -> np.ndarray:
        offset, count, lengths = self.blocks[k]
        self.source.seek(offset)
        data = self.source.read(sum(lengths))
        width = count if self.kind == "byte" else -(-count // 8)
        planes, at = [], 0
        for n in lengths:
            planes.append(self.engine.decompress(data[at:at + n], max_output_size=width) if n else b"")
            at += n
        return from_planes(planes, self.kind, count)

    def documents(self) -> Iterator[tuple[int, int, int]]:
        """(doc_id, number of ids, crc32 of them) in the file's order; one block is held at a time."""
        k, ids, at = -1, np.empty(0, "<u4"), 0
        for doc, size in zip(self.doc_ids.tolist(), self.sizes.tolist()):
            crc, left = 0, size
            while left:
                if at == len(ids):
                    k, at = k + 1, 0
                    ids = self.block(k)
                some = ids[at:at + left]
                crc = zlib.crc32(some.tobytes(), crc)
                at += len(some)
                left -= len(some)
            yield doc, size, crc


# Words of these letters only are one piece for the tokenizer, and lowering maps each letter to one letter.
_PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")
# Bytes: white space becomes a space, A-Z become a-z.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[[9, 10, 11, 12, 13]] = 32
_FOLD[65:91] += 32
_MARK, _LETTER = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_MARK[33:127] = True
_MARK[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
_LETTER[97:123] = True


def _spaced(texts: pa.Array) -> pa.Array:
    """Texts with A-Z lowered, white space as single bytes, and a space before marks that follow a letter.

    The tokenizer does the same by itself: it lowers, and a run of marks begins
    a new piece after a letter. Only ASCII and the two-byte letters of Latin-1 are looked at.
    """
    data, bounds = text_bytes(texts)
    if not len(data):
        return texts
    data = _FOLD[data]
    latin = np.zeros(len(data), dtype=bool)
    latin[1:] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    gap = np.zeros(len(data), dtype=bool)
    gap[1:] = _MARK[data[1:]] & (_LETTER[data[:-1]] | latin[:-1])
    moved = np.cumsum(gap)
    out = np.full(len(data) + int(moved[-1]), 32, np.uint8)
    out[np.arange(len(data)) + moved] = data
    # a gap at a text's first byte belongs to the text before it: a trailing space does no harm
    bounds = bounds + np.concatenate([[0], moved])[bounds]
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(out))


class Encoder:
    """Token ids of texts by the tokenizers library, each distinct word encoded once.

    For a tokenizer that never joins characters across white space (its
    normaliser folds white space and its splitter drops it), a text's ids are
    the ids of its space-separated words in turn. Plain words go to the
    library's model directly; any other goes through the whole library, and so
    do texts that hold ``<|``. The memory of words is bounded.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        splitter = self.whole.pre_tokenizer
        letters = [chr(c) for c in (*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)) if chr(c).isalpha()]
        pieces = {c: "".join(p for p, _ in splitter.pre_tokenize_str(c)) for c in letters}
        self.spelled = str.maketrans(pieces)
        self._forget()

    def _forget(self) -> None:
        """Words known by number; word k's ids are ``flat[begin[k]:begin[k + 1]]``."""
        self.known: dict[str, int] = {}
        self.begin, self.flat = np.zeros(1, np.int64), np.empty(0, np.uint32)

    def word(self, word: str) -> list[int]:
        if _PLAIN.fullmatch(word):
            return [t.id for t in self.model.tokenize(word if word.isascii() else word.lower().translate(self.spelled))]
        return self.whole.encode(word, add_special_tokens=False).ids if word else []

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids and the number of ids per text."""
        texts = texts.fill_null("").cast(pa.large_string())
        if pc.any(pc.match_substring(texts, "<|")).as_py():  # may be special tokens, which are not folded
            parts = [np.array(self.whole.encode(t, add_special_tokens=False).ids, np.uint32) for t in texts.to_pylist()]
            return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
        split = pc.split_pattern(_spaced(texts), " ")
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        coded = pc.dictionary_encode(split.flatten())
        vocabulary, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        if len(self.known) + len(vocabulary) > KNOWN_WORDS:
            self._forget()
        number, fresh = [], []
        for w in vocabulary:
            at = self.known.get(w)
            if at is None:
                at = self.known[w] = len(self.begin) - 1 + len(fresh)
                fresh.append(self.word(w))
            number.append(at)
        if fresh:
            ends = self.begin[-1] + np.cumsum(np.fromiter(map(len, fresh), np.int64, len(fresh)))
            self.begin = np.concatenate([self.begin, ends])
            self.flat = np.concatenate([self.flat, np.fromiter((i for f in fresh for i in f), np.uint32)])
        at = np.array(number, np.int64)[code] if number else np.empty(0, np.int64)
        n = self.begin[at + 1] - self.begin[at]
        upto = np.concatenate([[0], np.cumsum(n)])
        place = np.arange(upto[-1]) + np.repeat(self.begin[at] - upto[:-1], n)
        return self.flat[place], np.diff(upto[bounds])


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One per Python worker: its memory of words lasts over batches and tasks."""
    return Encoder(path)


def write_token_planes(
    docs: DataFrame, tokenizer: str, end_id: int = 1, kind: str = "bit", keep: bool = False, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Write the token ids of all documents in ascending id order as plane files, and read them back.

    Returns a row per document as read: doc_id, start (ids of all documents
    before it), n_tokens (with ``end_id``), ids_crc32, file. Documents are
    range-partitioned by id, a task sorts and encodes its range and writes one
    file (see ``PlaneWriter``); the files' totals, one row per file, give the
    starts. Files appear under their name when complete, so tasks can be
    repeated.

    A null or empty text is the end id alone. Null ids come first and are
    returned as null; rows that repeat an id are ordered by the text's hash. An
    empty table gives no rows. ``kind`` is ``bit`` or ``byte``. With ``keep`` the
    files stay in the shared folder under ``file``.
    """
    scratch = Scratch(docs.sparkSession)
    folder = (Scratch(docs.sparkSession) if keep else scratch).path("planes")
    pieces = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = base.repartitionByRange(pieces, "doc_id").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        piece = TaskContext.get().partitionId()
        parts = slices(batches, "text")
        batch = next(parts, None)
        if batch is None:
            return
        uri, library = f"{folder}/{piece:06d}.planes", encoder(tokenizer)
        with writing(uri) as out:
            file, nulls = PlaneWriter(out, kind), 0
            while batch is not None:
                ids, sizes = library.encode(batch.column("text"))
                ends = np.cumsum(sizes)
                docs_here = batch.column("doc_id")
                nulls += docs_here.null_count
                file.add(docs_here.fill_null(0).to_numpy(), sizes + 1, np.insert(ids, ends, end_id))
                batch = next(parts, None)
            file.close()
        yield pa.RecordBatch.from_pydict({"piece": pa.array([piece], pa.int64()), "uri": [uri], "ids": pa.array([file.total], pa.int64()), "nulls": pa.array([nulls], pa.int64())})

    written = scratch.write(ordered.mapInArrow(write, "piece long, uri string, ids long, nulls long"), "written")
    files = max(1, written.count())
    before = F.sum("ids").over(Window.orderBy("piece")) - F.col("ids")  # one row per file
    manifest = scratch.write(written.withColumn("start", before), "manifest")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start, nulls in zip(*(batch[c].to_pylist() for c in ("uri", "start", "nulls"))):
                with reading(uri) as source:
                    out: list[tuple] = []
                    for k, (doc, size, crc) in enumerate(PlaneReader(source).documents()):
                        out.append((None if k < nulls else doc, start, size, crc, uri))
                        start += size
                        if len(out) == 5000:
                            yield _rows(out)
                            out = []
                    if out:
                        yield _rows(out)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long, file string"
    return finish(scratch, manifest.repartition(files).mapInArrow(read, schema), "tokens")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "start", "n_tokens", "ids_crc32", "file"]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n == "file" else pa.int64()) for n, c in zip(names, zip(*rows))], names)
