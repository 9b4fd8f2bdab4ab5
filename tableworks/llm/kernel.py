"""Numpy kernels on Arrow text columns: words, their hashes, runs of sorted rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes of text worked on at once inside a task; a longer text is worked on alone.
SLICE_BYTES = 1 << 20

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, element by element."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of some texts. ``first[i]:first[i + 1]`` are the words of text i."""

    hashes: np.ndarray
    first: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and their bounds; null counts as empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8)[bounds[0]:bounds[-1]] if held is not None else np.empty(0, np.uint8)
    return data, bounds - bounds[0]


def words(texts: pa.Array, lower: bool = True, separators: np.ndarray = SPACES) -> Words:
    """Words between separator bytes with a 64-bit hash each; ``lower`` folds A-Z only."""
    data, bounds = text_bytes(texts)
    if lower:
        data = _LOWER[data]
    inside = ~separators[data]
    if not inside.any():
        none = np.empty(0, np.int64)
        return Words(np.empty(0, np.uint64), np.zeros(len(bounds), np.int64), none, none, data)
    begin, stop = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    stop[:-1] &= ~inside[1:]
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    begin[edges] |= inside[edges]
    stop[edges - 1] |= inside[edges - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    sizes = ends - starts
    at = np.zeros(len(sizes), np.int64)
    np.cumsum(sizes[:-1], out=at[1:])
    place = np.arange(int(sizes.sum())) - np.repeat(at, sizes)
    powers = np.cumprod(np.full(int(sizes.max()), _STEP, dtype=np.uint64), dtype=np.uint64)
    hashes = np.add.reduceat(_BYTE[data[inside]] * powers[place], at)
    return Words(mix(hashes + sizes.astype(np.uint64)), np.searchsorted(starts, bounds), starts, ends, data)


def _windows(hashes: np.ndarray, width: int) -> np.ndarray:
    n = len(hashes)
    out = np.full(n - width + 1, np.uint64(width), dtype=np.uint64)
    for i in range(width):
        out ^= hashes[i:n - width + 1 + i]
        out *= _STEP + np.uint64(2 * i)
        out ^= out >> np.uint64(29)
    return mix(out)


def shingle_sets(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, sorted within a text, and their bounds by text.

    A shingle is a run of ``k`` words; fewer words are one run; none have none.
    """
    counts = np.diff(w.first)
    sizes = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.empty(bounds[-1], dtype=np.uint64)
    if len(w.hashes) >= k:
        every = _windows(w.hashes, k)
        long = counts >= k
        inner = np.repeat(w.first[:-1][long], sizes[long]) + np.arange(int(sizes[long].sum())) - np.repeat(np.cumsum(sizes[long]) - sizes[long], sizes[long])
        flat[np.repeat(long, sizes)] = every[inner]
    for d in np.flatnonzero((counts > 0) & (counts < k)):
        flat[bounds[d]] = _windows(w.hashes[w.first[d]:w.first[d + 1]], int(counts[d]))[0]
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        flat[a:b].sort()
    fresh = np.ones(len(flat), dtype=bool)
    fresh[1:] = flat[1:] != flat[:-1]
    fresh[bounds[:-1][sizes > 0]] = True
    return flat[fresh], np.concatenate([[0], np.cumsum(fresh)])[bounds]


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each slice holds about ``limit`` bytes of ``column``, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, bounds = text_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Groups of consecutive rows with equal (integer) keys, from a partition sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)
