"""Exact byte-level BPE ids by dynamic programming over prefixes, and their decoding."""

from __future__ import annotations

import hashlib
import json
import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .kernel import slices

# The splitting pattern that byte-level tokenizer files leave to the library when they set "use_regex": a fixed value.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Pieces, and token pairs, remembered by a Python worker; a longer piece is encoded anew each time. The memory is emptied when full.
KNOWN_PIECES, KNOWN_PAIRS, KNOWN_LENGTH = 1_000_000, 2_000_000, 64
_NEVER = sys.maxsize


def byte_letters() -> dict[str, int]:
    """Letter -> byte of byte-level vocabularies: printable Latin-1 bytes are themselves, the others follow from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


class PrefixEncoder:
    """Byte-pair ids of a piece from the unique last token of each of its prefixes.

    A prefix's encoding ends in exactly one token t such that the encoding of
    the prefix without t ends in a token that stays apart from t. The tokens
    that end at a place come from an automaton with suffix links over the
    vocabulary; whether two tokens stay apart depends on them alone
    (``apart``). So a piece takes one pass over its bytes, whatever its length,
    and the ids are read off the back-pointers.
    """

    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, splitter = spec["model"], spec["pre_tokenizer"]
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if model["type"] != "BPE" or splitter["type"] != "ByteLevel" or splitter["add_prefix_space"] or not splitter["use_regex"] or spec["normalizer"] or not plain:
            raise ValueError("not a plain byte-level BPE tokenizer")
        letters = byte_letters()
        vocabulary = model["vocab"]
        self.bytes = [b""] * (1 + max([*vocabulary.values(), *(t["id"] for t in spec["added_tokens"])]))
        for token, k in vocabulary.items():
            self.bytes[k] = bytes(letters[c] for c in token)
        self.special = {}
        for t in spec["added_tokens"]:
            if t["single_word"] or t["lstrip"] or t["rstrip"]:
                raise ValueError("added tokens that take in their surroundings are not supported")
            self.bytes[t["id"]] = t["content"].encode()
            self.special[t["content"]] = t["id"]
        # a merge: rank and result of a pair; a token: the pair it is merged from and that merge's rank
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            ids = vocabulary[a], vocabulary[b]
            self.rank.setdefault(ids, rank)
            self.made.setdefault(vocabulary[a + b], (*ids, rank))
        self.single = {self.bytes[k]: k for k in vocabulary.values() if len(self.bytes[k]) == 1}
        self.automaton = ahocorasick.Automaton()
        for k in sorted(vocabulary.values()):
            if k in self.made or len(self.bytes[k]) == 1:
                self.automaton.add_word(self.bytes[k].decode("latin-1"), (k, len(self.bytes[k])))
        self.automaton.make_automaton()
        self.split = regex.compile(SPLIT)
        longest = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self.cut = regex.compile(f"({'|'.join(longest)})") if longest else None
        self.pieces: dict[str, bytes] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Parts of a token that lie at its end (side 1) or start (side 0) while it is merged, each with the rank that ends it."""
        out, until = [], _NEVER
        while True:
            out.append((token, until))
            made = self.made.get(token)
            if made is None:
                return out
            token, until = made[side], made[2]

    def apart(self, a: int, b: int) -> bool:
        """Whether the bytes of ``a`` followed by those of ``b`` are encoded as just these two.

        Merges go by rank, so each side goes through its own parts until one
        merge joins a part at the end of ``a`` with one at the start of ``b``
        before either is used up. Of equal ranks the left one comes first: it
        saves a part on the left, not one on the right.
        """
        known = self.pairs.get((a, b))
        if known is None:
            right = self._edge(b, 0)
            known = True
            for u, until in self._edge(a, 1):
                for w, end in right:
                    rank = self.rank.get((u, w))
                    if rank is not None and rank < until and rank <= end:
                        known = False
                        break
                if not known:
                    break
            if len(self.pairs) >= KNOWN_PAIRS:
                self.pairs.clear()
            self.pairs[a, b] = known
        return known

    def piece(self, data: bytes) -> list[int]:
        """The ids of one piece."""
        last = [-1] * (len(data) + 1)
        size = [0] * (len(data) + 1)
        apart = self.apart
        for at, (token, length) in self.automaton.iter(data.decode("latin-1")):
            end = at + 1
            if size[end]:
                continue
            start = end - length
            if start == 0 or size[start] and apart(last[start], token):
                last[end], size[end] = token, length
        ids, end = [], len(data)
        while end:
            if not size[end]:
                raise ValueError("a byte without a token")
            ids.append(last[end])
            end -= size[end]
        return ids[::-1]

    def _known(self, piece: str) -> bytes:
        packed = np.array(self.piece(piece.encode()), "<u4").tobytes()
        if len(piece) <= KNOWN_LENGTH:
            if len(self.pieces) >= KNOWN_PIECES:
                self.pieces.clear()
            self.pieces[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; special tokens in a text are found first, as the library does."""
        if self.cut is None or not any(s in text for s in self.special):
            return self._plain(text)
        parts = self.cut.split(text)
        return b"".join(np.array([self.special[p]], "<u4").tobytes() if k % 2 else self._plain(p) for k, p in enumerate(parts))

    def _plain(self, text: str) -> bytes:
        get = self.pieces.get
        return b"".join([get(p) or self._known(p) for p in self.split.findall(text)])

    def decode(self, packed: bytes) -> str:
        """The text of the ids, special tokens included; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(packed, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def encoder(path: str) -> PrefixEncoder:
    """One per Python worker: its memory of pieces lasts over batches and tasks."""
    return PrefixEncoder(path)


def encode_and_decode(docs: DataFrame, tokenizer: str, ids: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Token ids of every whole text by a byte-level BPE file, and the text decoded from them again.

    Returns per row of ``docs``: doc_id, n_tokens, ids_sha256 (of the ids as
    little-endian unsigned 32-bit integers), decoded_sha256 (of the decoded text
    in UTF-8) and, with ``ids``, the ids themselves. A map over the documents:
    nothing is shuffled, a lost task is run again. ``tokenizer`` is the path of
    the file on every executor.

    A null or empty text has no ids; repeated rows and ids, null ids and other
    columns are left as they are; an empty table gives no rows. Memory is that
    of the longest text and of the bounded stores of pieces and pairs; time
    grows in proportion to a text's bytes, one unbroken run included.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(tokenizer)
        for part in slices(batches, "text"):
            packed = [bpe.encode(t or "") for t in part.column("text").to_pylist()]
            columns = {
                "doc_id": part.column("doc_id"), "n_tokens": pa.array([len(p) // 4 for p in packed], pa.int64()),
                "ids_sha256": [hashlib.sha256(p).hexdigest() for p in packed],
                "decoded_sha256": [hashlib.sha256(bpe.decode(p).encode()).hexdigest() for p in packed],
            }
            if ids:
                columns["ids"] = pa.array([np.frombuffer(p, "<u4").astype(np.int32) for p in packed], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if ids else "")
    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).mapInArrow(work, schema)
