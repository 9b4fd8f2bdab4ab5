"""Union-find inside a task and tile keys between tasks, for operators on pairs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def tile_pairs(tile: Column, tiles: Column) -> Column:
    """All tile pairs (i, j), i <= j, that a row of ``tile`` takes part in: every two tiles, and each with itself, meet once."""
    each = F.sequence(F.lit(0), tiles - 1)
    return F.transform(each, lambda t: F.struct(F.least(t, tile).cast("int").alias("i"), F.greatest(t, tile).cast("int").alias("j")))


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable by the links a-b, for each of 0..n-1: pointer jumping on arrays."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while True:
            jumped = new[new]
            if (jumped == new).all():
                break
            new = jumped
        root = new
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root
