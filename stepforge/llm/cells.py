"""The upper levels of a cover tree over a whole table: cells around rows of a bounded sample."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 2048


def usable(vector: str) -> Column:
    """Whether the vector exists and holds finite numbers only."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad, F.lit(False))


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Rows of a list column whose lists all have ``size`` numbers."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def by_size(sizes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    for size in np.unique(sizes):
        yield int(size), np.flatnonzero(sizes == size)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def pivots(rows: DataFrame, group: str, vector: str, prepare, cell_rows: int) -> dict:
    """Centres per (group, size): a net over a sample of at most ``SAMPLE`` rows of the whole table.

    Centres are rows of the sample, each the furthest from those before, so
    that the balls around them shrink level by level. A group has a centre per
    ``cell_rows`` rows it is estimated to have; groups without a row in the
    sample have none and are one cell.
    """
    total = rows.count()
    drawn = rows.select(group, vector).orderBy(F.xxhash64(vector, group)).limit(SAMPLE).collect()
    held: dict = {}
    for row in drawn:
        held.setdefault((row[0], len(row[1])), []).append(row[1])
    out, number = {}, 0
    for key, vectors in sorted(held.items(), key=repr):
        x = prepare(np.array(vectors, np.float64))
        want = int(np.ceil(total * len(x) / len(drawn) / cell_rows))
        if want < 2:
            continue
        chosen = [0]
        far = ((x - x[0]) ** 2).sum(axis=1)
        while len(chosen) < min(want, len(x)) and far.max() > 0:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
        out[key] = (number, x[chosen])
        number += len(chosen)
    return out


def distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (centers * centers).sum(axis=1)[None, :] - 2 * x @ centers.T
    return np.sqrt(np.maximum(square, 0.0))
