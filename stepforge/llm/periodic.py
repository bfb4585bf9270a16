"""Maximal periodic runs of words, found by string synchronising sets.

A run of period p repeats a stretch of p words at least three times. For every
scale ``t = 8, 16, 32, ...`` positions are selected by the least hash of the
``t``-word windows around them, so that equal contexts of ``2 t`` words are
selected alike and every stretch of ``3 t - 1`` words that is not highly
periodic (period above ``t / 3``) has a selected position among its first
``t``. A run of period p with ``(3 t - 1) / 2 <= p < 3 t`` therefore holds a
selected position whose context returns p words later: pairs of selected
positions with equal contexts propose the periods. Windows that are highly
periodic take no part in the selection. They are known at each scale from the
runs of the scales before, and periods up to 11, which the first scale omits,
are found by comparing the words with themselves some words later.

Proposals are extended word by word, so hashes choose candidates and never
decide. Work is linear in the words for each of the scales up to the longest
document of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIRST = 8
SMALL = (3 * FIRST - 1) // 2
AT_ONCE = 512
NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)
RUNS = "array<struct<start: long, length: long, period: long>>"


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(32)


def doubled(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of windows of twice the size."""
    return mixed(hashes[:-size] * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[size:]) if len(hashes) > size else hashes[:0]


def stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of true entries."""
    edges = np.flatnonzero(np.diff(same.astype(np.int8), prepend=0, append=0))
    return edges[::2], edges[1::2]


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether each of n places lies in one of the ranges."""
    depth = np.zeros(n + 1, np.int32)
    np.add.at(depth, starts, 1)
    np.add.at(depth, ends, -1)
    return np.cumsum(depth[:-1]) > 0


def synchronising(ids: np.ndarray, size: int) -> np.ndarray:
    """Positions whose window, or the one ``size`` later, has the least id of the windows in between."""
    least, width = ids, 1
    while width < size:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    least = np.minimum(least[:-1], least[1:])
    chosen = (least == ids[:len(least)]) | (least == ids[size:])
    return np.flatnonzero(chosen & (least != NEVER))


def proposals(at: np.ndarray, context: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions with the distances, from low to high, at which their context returns."""
    order = np.argsort(context, kind="stable")
    at, context = at[order], context[order]
    places, periods = [at[:0]], [at[:0]]
    for j in range(1, len(at)):
        distance = at[j:] - at[:-j]
        near = (context[j:] == context[:-j]) & (distance <= high)
        if not near.any():
            break
        near &= distance >= low
        places.append(at[:-j][near])
        periods.append(distance[near])
    return np.concatenate(places), np.concatenate(periods)


def extent(codes: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The stretch around ``at`` whose words return ``period`` later."""
    low = high = at
    step = 64
    while True:
        a, b = codes[high:high + step], codes[high + period:high + period + step]
        different = np.flatnonzero(a[:len(b)] != b)
        if different.size:
            high += int(different[0])
            break
        high += len(b)
        if len(b) < step:
            break
        step *= 2
    step = 64
    while low:
        a = codes[max(0, low - step):low]
        b = codes[max(0, low - step) + period:low + period]
        different = np.flatnonzero(a != b)
        if different.size:
            low -= len(a) - 1 - int(different[-1])
            break
        low -= len(a)
        step *= 2
    return low, high


def repetitions(codes: np.ndarray, sizes: np.ndarray, min_length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, length, period`` of the runs of texts that lie one after another in ``codes``.

    ``sizes`` are the texts' words, falling; each text ends with a code of its own.
    """
    ends = np.cumsum(sizes + 1)
    found = []
    for period in range(1, min(SMALL, int(sizes[0]) // 3) + 1 if len(sizes) else 1):
        a, b = stretches(codes[:-period] == codes[period:])
        enough = b - a + period >= max(min(FIRST, min_length), 3 * period)
        found.append(np.stack([a[enough], (b - a)[enough] + period, np.full(int(enough.sum()), period)]))
    runs = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    hashes = mixed(codes.astype(np.uint64) + np.uint64(1))
    size = 1
    while size < FIRST:
        hashes, size = doubled(hashes, size), 2 * size
    while len(sizes) and 3 * (3 * size // 2) <= sizes[0]:
        low, high = 3 * size // 2, 3 * size - 1
        n = int(ends[np.searchsorted(-sizes, -3 * low, side="right") - 1])
        hashes = hashes[:n - size + 1]
        contexts = doubled(hashes, size)
        start, length, _ = runs[:, (runs[2] <= size // 3) & (runs[1] >= size) & (runs[0] < n)]
        ids = np.where(covered(len(hashes), start, start + length - size + 1), NEVER, hashes)
        at = synchronising(ids, size)
        places, periods = proposals(at, contexts[at], low, high)
        order = np.lexsort((places, periods))
        more, last, end = [], 0, 0
        for place, period in zip(places[order].tolist(), periods[order].tolist()):
            if period == last and place < end:
                continue
            a, end = extent(codes, place, period)
            last = period
            if end - a >= 2 * period:
                more.append((a, end - a + period, period))
        if more:
            runs = np.concatenate([runs, np.array(more, np.int64).T], axis=1)
        hashes, size = contexts, 2 * size
    runs = runs[:, (runs[1] >= min_length) & (runs[1] >= 3 * runs[2])]
    # A stretch found for multiples of its period too has the same start and length: the smallest period stays.
    runs = runs[:, np.lexsort((runs[2], runs[1], runs[0]))]
    if runs.shape[1]:
        runs = runs[:, np.concatenate([[True], (np.diff(runs[0]) != 0) | (np.diff(runs[1]) != 0)])]
    return runs[0], runs[1], runs[2]


def runs_of(texts: pa.Array, min_length: int, times: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Word counts, runs and texts without the repeats of each text."""
    lists = pc.ascii_split_whitespace(texts.fill_null(""))
    words, offsets = lists.flatten(), np.diff(lists.offsets.to_numpy())
    filled = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(texts)), offsets)[filled]
    words = words.filter(pa.array(filled))
    sizes = np.bincount(owner, minlength=len(texts))
    firsts = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    # The texts one after another, longest first, each with a code of its own behind.
    sorted_sizes = sizes[order]
    begins = np.cumsum(sorted_sizes + 1) - sorted_sizes - 1
    codes = np.empty(int(sorted_sizes.sum()) + len(order), np.int64)
    place = np.arange(len(words)) + np.repeat(begins - np.cumsum(sorted_sizes) + sorted_sizes, sorted_sizes)
    source = np.arange(len(words)) + np.repeat(firsts[order] - np.cumsum(sorted_sizes) + sorted_sizes, sorted_sizes)
    codes[place] = words.dictionary_encode().indices.to_numpy()[source]
    codes[begins + sorted_sizes] = len(words) + np.arange(len(order))
    start, length, period = repetitions(codes, sorted_sizes, min_length)
    enough = length >= times * period
    start, length, period = start[enough], length[enough], period[enough]
    which = np.searchsorted(begins, start, side="right") - 1
    local, document = start - begins[which], order[which]
    by = np.lexsort((period, local, document))
    local, length, period, document = local[by], length[by], period[by], document[by]
    counts = np.bincount(document, minlength=len(texts))
    runs = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()),
        pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (local, length, period)], ["start", "length", "period"]))
    first = firsts[document] + local
    kept = ~covered(len(words), first + period, first + length)
    left = np.bincount(owner[kept], minlength=len(texts))
    collapsed = pc.binary_join(
        pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(left)]), pa.int32()), words.filter(pa.array(kept))), " ")
    return pa.array(sizes, pa.int64()), runs, collapsed


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 24, times: int = 3) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` per row, without an exchange.

    ``runs`` are the stretches of words with smallest period ``period`` that
    last for ``min_length`` words and ``times`` periods (3 at least) and that
    no neighbouring word extends, by start, then period. ``collapsed`` are the
    words joined by one space, without those that some run has after its first
    period. Words are separated by the ASCII white space. A null text has no
    words; rows that repeat an id, or have none, each get their row. Other
    columns are not read.
    """
    if times < 3:
        raise ValueError("the proposals are complete for runs of three periods and more")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, AT_ONCE):
                batch = whole.slice(at, AT_ONCE)
                n_words, runs, collapsed = runs_of(batch.column(1), min_length, times)
                yield pa.RecordBatch.from_arrays([batch.column(0), n_words, runs, collapsed], ["doc_id", "n_words", "runs", "collapsed"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, n_words long, runs {RUNS}, collapsed string")
