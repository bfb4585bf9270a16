"""Packing documents into fixed windows by minimum bin slack.

A document is its ids and an end id. Whole windows are cut off first; what
remains of each document, shorter than a window, waits in a multiset of
lengths. A window takes the longest remainder and then the multiset whose sum
comes closest to the room left: subset sums are the bits of one integer, shifted
once per copy of a length, and the counts are read back from the bits before each
shift. If even the best sum leaves room while remainders wait, one of them is
cut to fill it. Remainders that fill no window wait for the next documents; those of
a task's end are cut into sequences of powers of two, which need no padding.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepforge.llm.common import as_bytes
from stepforge.llm.token_counts import AT_ONCE, compiled


def closest(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length to take so that their sum comes closest to ``room`` from below."""
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((k for k, n in counts.items() if n and k <= room), reverse=True):
        for _ in range(min(counts[length], room // length)):
            grown = (reach | reach << length) & mask
            if grown == reach:
                break
            steps.append((length, reach))
            reach = grown
            if reach >> room & 1:
                break
        if reach >> room & 1:
            break
    total, taken = reach.bit_length() - 1, defaultdict(int)
    for length, before in reversed(steps):
        if not before >> total & 1:
            taken[length] += 1
            total -= length
    return taken


class Packer:
    """Sequences of one task. A piece is ``(document, its first id, ids)`` with ids of four bytes."""

    def __init__(self, window: int, first_sequence: int):
        self.window, self.sequence = window, first_sequence
        self.waiting: dict[int, list[tuple]] = defaultdict(list)
        self.tokens = 0

    def emit(self, pieces: list[tuple]) -> list[tuple]:
        out, offset = [], 0
        for doc, start, ids in pieces:
            out.append((*doc, start, len(ids) // 4, ids, self.sequence, offset))
            offset += len(ids) // 4
        self.sequence += 1
        return out

    def wait(self, piece: tuple) -> None:
        self.waiting[len(piece[2]) // 4].append(piece)
        self.tokens += len(piece[2]) // 4

    def take(self, length: int) -> tuple:
        piece = self.waiting[length].pop()
        self.tokens -= length
        if not self.waiting[length]:
            del self.waiting[length]
        return piece

    def add(self, doc: tuple, ids: bytes) -> list[tuple]:
        """Cut off whole windows, keep the remainder waiting."""
        out, step = [], 4 * self.window
        whole = len(ids) - len(ids) % step
        for at in range(0, whole, step):
            out += self.emit([(doc, at // 4, ids[at:at + step])])
        if whole < len(ids):
            self.wait((doc, whole // 4, ids[whole:]))
        return out

    def cut(self, room: int) -> tuple:
        """The first ``room`` ids of the longest waiting remainder; the rest waits on."""
        doc, start, ids = self.take(max(self.waiting))
        if len(ids) > 4 * room:
            self.wait((doc, start + room, ids[4 * room:]))
        return doc, start, ids[:4 * room]

    def fill(self) -> list[tuple]:
        """Sequences of exactly one window while what waits can fill them."""
        out = []
        while self.tokens >= self.window:
            pieces = [self.take(max(self.waiting))]
            room = self.window - len(pieces[0][2]) // 4
            for length, n in closest({k: len(v) for k, v in self.waiting.items()}, room).items():
                pieces += [self.take(length) for _ in range(n)]
                room -= n * length
            while room:
                pieces.append(self.cut(room))
                room -= len(pieces[-1][2]) // 4
            out += self.emit(pieces)
        return out

    def end(self) -> list[tuple]:
        """What still waits, less than a window, in sequences of powers of two."""
        out = self.fill()
        while self.tokens:
            room, pieces = 1 << (self.tokens.bit_length() - 1), []
            while room:
                pieces.append(self.cut(room))
                room -= len(pieces[-1][2]) // 4
            out += self.emit(pieces)
        return out


def pack(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = 1024, end_id: int = 0,
         gather: int = 4096) -> DataFrame:
    """Pieces of documents in sequences of ``window`` ids.

    Returns ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``;
    ``ids`` are little-endian unsigned 32-bit numbers, and each id of a
    document, ``end_id`` last, lies in exactly one piece. A null text is empty
    and packs as its end id; rows that repeat an id, or have none, are packed
    each for itself. Tasks pack their own rows, ``gather`` documents and at most
    one window of remainders at a time, without an exchange; sequence ids hold
    the partition's number and so are the same when a task is run again. An
    empty table gives no pieces. Other columns are not read.
    """
    names = ["doc_id", "doc_tokens", "start", "length", "ids", "sequence_id", "offset"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, end = compiled(path), end_id.to_bytes(4, "little")
        packer, rows, held = Packer(window, TaskContext.get().partitionId() << 36), [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(at, AT_ONCE)
                found = model.ids([t.decode("utf-8", "replace") for t in as_bytes(part.column(1))])
                for doc_id, ids in zip(part.column(0).to_pylist(), found):
                    ids += end
                    rows += packer.add((doc_id, len(ids) // 4), ids)
                    held += 1
                    if held == gather or packer.tokens > gather * window // 2:
                        rows, held = rows + packer.fill(), 0
                    if len(rows) >= 2048:
                        yield batch_of(rows)
                        rows = []
        rows += packer.end()
        if rows:
            yield batch_of(rows)

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    packed = rows.mapInArrow(run, "doc_id long, doc_tokens long, start long, length long, ids binary, sequence_id long, offset long")
    return packed.select("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
