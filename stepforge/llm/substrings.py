"""Removing word windows that an earlier document has, with a count-min prefilter.

A window is marked by the least hash of its grams, runs of about half as many
words: equal windows have equal marks, and neighbours mostly share theirs, so a
text has about a quarter as many marks as windows. Pass one: every task sketches
its marks, cells hold 0, 1 or "2 and more", and the sketches are merged cell range
by cell range. A mark whose cells all read 2 may be repeated, any other is not:
counts are never underestimated. Pass two: only those marks are grouped for their
smallest and greatest document, and bitmaps of the marks of several documents are
sent. Pass three: windows under such a mark are grouped, exactly, by 96 bits
of hash for their smallest document, and joined back to their places.

The merged sketch has a fixed size, ``2 * 2**(cell_bits - 3)`` bytes at most,
and so may be sent to every executor. On more marks than cells it lets more
through to pass two, which costs a row a mark; pass three lets windows through by what
is repeated, not by what the table holds. Identical texts are compared once: all
but the copy of the smallest id are removed as a whole. That copy is known
from a table of digests; a bitmap of the same kind tells most other copies in
the passes, and those it doesn't tell are only compared needlessly.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepforge.llm.common import Scratch, as_bytes, kept

FACTORS = np.array([[0x9E3779B97F4A7C15], [0xC2B2AE3D27D4EB4F]], np.uint64)  # odd multipliers of the two window hashes
RANGE_BITS = 22
HELD = 1 << 21


def word_windows(words: list[bytes], size: int) -> np.ndarray:
    """Two 64-bit hashes of each window of ``size`` words, as columns."""
    n = len(words) - size + 1
    if n < 1:
        return np.zeros((2, 0), np.uint64)
    hashed = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), "<u8").reshape(-1, 2).T
    out, power = np.zeros((2, n), np.uint64), np.ones((2, 1), np.uint64)
    for i in range(size):
        out += hashed[:, i:i + n] * power
        power = power * FACTORS
    return out ^ (out >> np.uint64(32)) * FACTORS[::-1]


def window_marks(words: list[bytes], size: int) -> np.ndarray:
    """For each window of ``size`` words the least hash of its grams of half as many words."""
    gram = (size + 1) // 2
    hashed = word_windows(words, gram)[0]
    out = hashed[:max(len(words) - size + 1, 0)]
    for i in range(1, size - gram + 1):
        out = np.minimum(out, hashed[i:i + len(out)])
    return out


def distinct_marks(words: list[bytes], size: int) -> np.ndarray:
    """The marks of a text's windows as two hashes, each as often as it begins anew."""
    marks = window_marks(words, size)
    new = marks[np.concatenate([[True], marks[1:] != marks[:-1]])] if len(marks) else marks
    return mark_hashes(new)


def mark_hashes(marks: np.ndarray) -> np.ndarray:
    """Two hashes of a mark, which is a least one and so lies low itself."""
    out = marks * FACTORS
    return (out ^ out >> np.uint64(32)) * FACTORS[::-1]


def encode(cells: np.ndarray) -> bytes:
    """Ascending distinct cells of a range as gaps of a byte, 255 standing for a longer way."""
    gaps = np.diff(cells.astype(np.int64), prepend=-1)
    count = gaps // 255 + 1
    out = np.full(int(count.sum()), 255, np.uint8)
    out[np.cumsum(count) - 1] = gaps % 255
    return out.tobytes()


def decode(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, np.uint8)
    return (np.cumsum(steps, dtype=np.int64) - 1)[steps != 255]


def sketch_rows(row: int, cells: np.ndarray) -> list[tuple]:
    """``(row, range, cells met, cells met more than once)`` of one task's cells."""
    cells = np.sort(cells)
    again = cells[1:][cells[1:] == cells[:-1]]
    cells, again = [x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x for x in (cells, again)]
    out = []
    for part in np.unique(cells >> RANGE_BITS).tolist():
        low, high = part << RANGE_BITS, (part + 1) << RANGE_BITS
        own = [x[np.searchsorted(x, low):np.searchsorted(x, high)] - low for x in (cells, again)]
        out.append((row, part, encode(own[0]), encode(own[1])))
    return out


def merged(rows: DataFrame, least: int) -> DataFrame:
    """``(row, part, bits)``: a bitmap of the cells met ``least`` (1 or 2) times or more, over all tasks.

    Rows of a range are read one after the other, so a task holds one range.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(at, counts):
            return pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.int32()),
                                               pa.array([np.packbits(counts >= least, bitorder="little").tobytes()])],
                                              ["row", "part", "bits"])

        at = counts = None
        for batch in batches:
            for row, part, met, again in zip(*(c.to_pylist() for c in batch.columns)):
                if (row, part) != at:
                    if at is not None:
                        yield done(at, counts)
                    at, counts = (row, part), np.zeros(1 << RANGE_BITS, np.uint8)
                cells = decode(met)
                counts[cells] = np.minimum(counts[cells] + 1, 2)
                counts[decode(again)] = 2
        if at is not None:
            yield done(at, counts)

    return rows.repartition("row", "part").sortWithinPartitions("row", "part").mapInArrow(run, "row int, part int, bits binary")


class Bitmaps:
    """The merged bitmaps on the executors, unpacked once per worker process; those named ``before`` are read no more."""

    def __init__(self, spark: SparkSession, rows: DataFrame, depth: int, cell_bits: int, job: str, before: str = ""):
        self.name, self.job, self.depth, self.bits, self.before = uuid.uuid4().hex, job, depth, cell_bits, before
        parts = {(r.row, r.part): zlib.compress(bytes(r.bits), 1) for r in rows.toLocalIterator()}
        self.sent = spark.sparkContext.broadcast(parts)

    def unpacked(self) -> list[np.ndarray]:
        own = kept("bitmaps")
        if own.get("job") != self.job:  # those of an earlier job go first
            own["job"], own["bitmaps"] = self.job, {}
        held = own["bitmaps"]
        if self.name not in held:
            held.pop(self.before, None)
            out = [np.zeros(1 << (self.bits - 3), np.uint8) for _ in range(self.depth)]
            size = 1 << (RANGE_BITS - 3)
            for (row, part), data in self.sent.value.items():
                out[row][part * size:(part + 1) * size] = np.frombuffer(zlib.decompress(data), np.uint8)
            held[self.name] = out
        return held[self.name]

    def has(self, cells: list[np.ndarray]) -> np.ndarray:
        found = np.ones(len(cells[0]), bool)
        for bitmap, at in zip(self.unpacked(), cells):
            found &= (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return found


def cells_of(windows: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(w >> np.uint64(64 - bits)).astype(np.uint32) for w in windows]


def id_cells(ids: np.ndarray, bits: int) -> np.ndarray:
    x = ids.view(np.uint64) * FACTORS[0]
    return ((x ^ x >> np.uint64(32)) * FACTORS[1] >> np.uint64(64 - bits)).astype(np.uint32)


def sketched(frame: DataFrame, cells, depth: int, least: int) -> DataFrame:
    """Merged bitmaps of what ``cells(batch)`` yields: a list of ``depth`` cell arrays each time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held):
            rows = [r for i in range(depth) for r in sketch_rows(i, np.concatenate([h[i] for h in held]))]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                                              ["row", "part", "met", "again"])

        held, n = [], 0
        for batch in batches:
            for found in cells(batch):
                held.append(found)
                n += len(found[0])
                if n >= HELD:
                    yield out(held)
                    held, n = [], 0
        if n:
            yield out(held)

    return merged(frame.mapInArrow(run, "row int, part int, met binary, again binary"), least)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 13, cell_bits: int = 28) -> DataFrame:
    """Words of each row without those in a window that starts in a document of smaller id.

    Returns ``doc_id, n_words, n_removed, kept`` per row; ``kept`` joins the
    words left by one space. Words are ``[^\\x20\\x09-\\x0D]+``, windows ``size``
    consecutive words of one row, judged on the input. A null text has no
    words. Rows that share an id are not earlier than one another; a null id
    comes after every id and is earlier than none. Texts of fewer words than
    ``size`` are kept whole. Other columns are not read; an empty table gives an
    empty result.
    """
    if cell_bits < RANGE_BITS or cell_bits > 32:
        raise ValueError("cell_bits must lie between 22 and 32")
    spark = df.sparkSession
    scratch = Scratch(spark)
    last_id, job = (1 << 63) - 1, uuid.uuid4().hex
    docs = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(last_id)).alias("key"), F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")).withColumn("digest", F.unhex(F.md5("text")))
    prints = docs.select("key", "digest")
    first = scratch.cut(prints.groupBy("digest").agg(F.min("key").alias("first")))

    def first_cells(batch):
        yield [id_cells(batch.column(0).to_numpy(zero_copy_only=False), 27)]

    firsts = Bitmaps(spark, sketched(first.select("first"), first_cells, 1, 1), 1, 27, job)

    def texts(batch):
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        if not len(keys):
            return
        maybe = firsts.has([id_cells(keys, 27)]).tolist()
        column = batch.column(1)
        for i, ok in enumerate(maybe):
            if ok:
                yield i, column[i].as_py().split()

    def mark_cells(batch):
        for _, words in texts(batch):
            if len(words) >= size:
                yield cells_of(distinct_marks(words, size), cell_bits)

    sketch = Bitmaps(spark, sketched(docs.select("key", "text"), mark_cells, 2, 2), 2, cell_bits, job)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held):
            return pa.RecordBatch.from_arrays([pa.array(np.repeat([k for k, _ in held], [len(x) for _, x in held])),
                                               pa.array(np.concatenate([x for _, x in held]).view(np.int64))], ["key", "mark"])

        held, n = [], 0
        for batch in batches:
            for i, words in texts(batch):
                if len(words) >= size:
                    marks = distinct_marks(words, size)
                    held.append((np.int64(batch.column(0)[i].as_py()), np.unique(marks[0, sketch.has(cells_of(marks, cell_bits))])))
                    n += len(held[-1][1])
                if n >= 100_000:
                    yield out(held)
                    held, n = [], 0
        if n:
            yield out(held)

    shared = scratch.cut(docs.select("key", "text").mapInArrow(marked, "key long, mark long").groupBy("mark").agg(
        F.min("key").alias("least"), F.max("key").alias("most")).filter("least < most").select("mark"))

    def shared_cells(batch):
        yield cells_of(mark_hashes(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)), cell_bits)

    sketch.sent.unpersist()
    repeats = Bitmaps(spark, sketched(shared, shared_cells, 2, 1), 2, cell_bits, job, sketch.name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held):
            rows, at, a, b = zip(*held)
            count = list(map(len, at))
            keys = np.repeat(np.array([r[0] for r in rows], np.int64), count)
            digests = pa.array([r[1] for r in rows], pa.binary()).take(pa.array(np.repeat(np.arange(len(rows)), count)))
            return pa.RecordBatch.from_arrays(
                [pa.array(keys), digests, pa.array(np.concatenate(at).astype(np.int32)), pa.array(np.concatenate(a).view(np.int64)),
                 pa.array((np.concatenate(b) >> np.uint64(32)).astype(np.uint32).view(np.int32))], ["key", "digest", "at", "h", "g"])

        held, n = [], 0
        for batch in batches:
            for i, words in texts(batch):
                marks = mark_hashes(window_marks(words, size))
                at = np.flatnonzero(repeats.has(cells_of(mark_hashes(marks[0]), cell_bits)))
                if len(at):
                    windows = word_windows(words, size)
                    held.append(((batch.column(0)[i].as_py(), batch.column(2)[i].as_py()), at, windows[0, at], windows[1, at]))
                    n += len(at)
                if n >= 100_000:
                    yield out(held)
                    held, n = [], 0
        if n:
            yield out(held)

    found = scratch.cut(docs.select("key", "text", "digest").mapInArrow(run, "key long, digest binary, at int, h long, g int"))
    repeated = scratch.cut(found.groupBy("h", "g").agg(F.min("key").alias("least"), F.max("key").alias("most")).filter("least < most")
                           .select("h", "g", "least"))
    later = found.join(repeated, ["h", "g"]).filter("least < key")
    places = later.groupBy("key", "digest").agg(F.collect_set("at").alias("starts"))
    copies = scratch.cut(prints.join(first, "digest").filter("first < key").select("key", "digest").distinct())
    marks = scratch.cut(places.withColumn("copy", F.lit(False)).unionByName(
        copies.select("key", "digest", F.array().cast("array<int>").alias("starts"), F.lit(True).alias("copy")))
        .groupBy("key", "digest").agg(F.flatten(F.collect_list("starts")).alias("starts"), F.max("copy").alias("copy")))
    scratch.free(found, repeated, first, copies, shared)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 1000):
                batch = whole.slice(low, 1000)
                kept, total, gone = [], [], []
                for text, starts, copy in zip(as_bytes(batch.column(1)), batch.column(2), batch.column(3).to_pylist()):
                    words = text.split()
                    n = removed = len(words)
                    if copy and n >= size:
                        words = []
                    elif starts.is_valid and n:
                        cover = np.zeros(n + 1, np.int32)
                        at = starts.values.to_numpy()
                        np.add.at(cover, at, 1)
                        np.add.at(cover, at + size, -1)
                        words = [words[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()]
                    kept.append(b" ".join(words).decode("utf-8", "replace"))
                    total.append(n)
                    gone.append(removed - len(words))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                                                 ["doc_id", "n_words", "n_removed", "kept"])

    joined = docs.join(marks, ["key", "digest"], "left").select("doc_id", "text", "starts", "copy")
    return joined.mapInArrow(keep, "doc_id long, n_words long, n_removed long, kept string")
