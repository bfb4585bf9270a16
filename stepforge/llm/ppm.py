"""Language-model scores by prediction with partial matching over bytes.

The trie of byte contexts is held as sorted arrays, one level per context
length: a context is the bytes before a symbol, the nearest in the lowest byte,
so that dropping its highest byte leads to the next shorter one. Counts of the
longest grams are gathered over all training texts; a shorter gram counts the
distinct longer ones it ends, as if only symbols new to the longer context had
been counted. A symbol is coded in the longest known context, or after an escape
in the next shorter one, where the symbols of the longer context are excluded:
they are all known in the shorter one too, so what an exclusion takes away is
one sum per context. Every distinct symbol gives half a count to the escape of
its context (method D), and a symbol that is not kept all of its count.

Counts cover all training texts and no gram is left out. Grams that share the
two bytes before their symbol lie in one partition, where every context of two
bytes and more is complete; the tables of the two shortest contexts (at most
65,536 symbols) are sent to all. So each partition works out the code length of
every distinct gram of the texts, and a document adds up those of its places:
the code lengths of the most frequent grams are sent to the tasks that read the
texts, all others meet their grams in a join.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepforge.llm.common import Scratch, as_bytes, kept

END = b"\n"  # not in a normalised text, whose white space is single spaces
CHUNK = 1 << 15
GATHER = 1 << 22
MEMO_BITS = 21


def normal(text: bytes) -> list[bytes]:
    return text.lower().split()


def padded(texts: list[list[bytes]], order: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one buffer, each behind ``order`` ends and with one end; and where each begins."""
    joined = [b" ".join(words) for words in texts]
    pad = END * order
    data = np.frombuffer(b"".join([pad + t + END for t in joined]), np.uint8)
    size = np.fromiter((len(t) + order + 1 for t in joined), np.int64, len(joined))
    return data, np.cumsum(size) - size


def gram_keys(data: np.ndarray, order: int) -> Iterator[tuple[int, np.ndarray]]:
    """For stretches of the buffer: the first place and the grams that end at each place from ``order`` on."""
    for low in range(order, len(data), CHUNK):
        high = min(low + CHUNK, len(data))
        part = data[low - order:high].astype(np.uint64)
        keys = part[order:].copy()
        for j in range(1, order + 1):
            keys |= part[order - j:len(part) - j] << np.uint64(8 * j)
        yield low, keys


def folded(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def places(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of ``keys`` in an ascending ``table``, -1 for those it lacks."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


class Level:
    """Contexts of one length with their symbols, from ascending distinct grams and their counts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = keys, counts - 0.5
        context = keys >> np.uint64(8)
        self.starts = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(keys) else np.zeros(0, np.int64)
        self.contexts, self.sizes = context[self.starts], np.diff(self.starts, append=len(keys))
        self.kept = np.add.reduceat(self.counts, self.starts) if len(self.starts) else np.zeros(0)


def shorter(keys: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams of ``length`` bytes that distinct longer ones end in, with how many do."""
    return np.unique(keys & np.uint64((1 << 8 * length) - 1), return_counts=True)


class Trie:
    """Probabilities of symbols after contexts of up to ``order`` bytes."""

    def __init__(self, levels: list[Level]):
        self.levels, self.order = levels, len(levels) - 1
        self.excluded = [np.zeros(len(levels[0].contexts))]
        for k in range(1, len(levels)):
            level, below = levels[k], levels[k - 1]
            at = places(below.keys, level.keys & np.uint64((1 << 8 * k) - 1))
            held = below.counts[at]
            self.excluded.append(np.add.reduceat(held, level.starts) if len(level.starts) else np.zeros(0))

    def code(self, grams: np.ndarray) -> np.ndarray:
        """log10 of the probability of each gram's last symbol after the bytes before it."""
        out, left = np.zeros(len(grams)), np.arange(len(grams))
        inner = np.full(len(grams), -1)  # the context escaped from, one byte longer
        for k in range(self.order, -1, -1):
            level, grams_left = self.levels[k], grams[left]
            at = places(level.contexts, grams_left >> np.uint64(8) & np.uint64((1 << 8 * k) - 1))
            known = at >= 0
            rows, at, inside = left[known], at[known], inner[left[known]]
            escaped = inside >= 0
            if k < self.order and len(self.levels[k + 1].contexts):
                taken = np.where(escaped, self.excluded[k + 1][inside], 0.0)
                gone = np.where(escaped, self.levels[k + 1].sizes[inside], 0)
            else:
                taken = gone = np.zeros(len(rows))
            escape = np.maximum(0.5 * level.sizes[at] - 0.5 * gone, 0.25)
            whole = level.kept[at] - taken + escape
            entry = places(level.keys, grams[rows] & np.uint64((1 << 8 * (k + 1)) - 1))
            hit = entry >= 0
            weight = np.where(hit, level.counts[entry] if len(level.counts) else 0.0, escape)
            out[rows] += np.log10(weight / whole)
            inner[rows] = at
            done = np.zeros(len(grams), bool)
            done[rows[hit]] = True
            left = left[~done[left]]
        rest = 256 - (int(self.levels[0].sizes[0]) if len(self.levels[0].sizes) else 0)
        out[left] -= np.log10(max(rest, 1))
        return out


class Coder:
    """Code lengths of the grams that were sent, with a table of recent ones, direct by hash."""

    def __init__(self, grams: np.ndarray, codes: np.ndarray):
        self.grams, self.codes = grams, codes
        self.keys = np.full(1 << MEMO_BITS, (1 << 64) - 1, np.uint64)
        self.values = np.zeros(1 << MEMO_BITS)

    def code(self, grams: np.ndarray) -> np.ndarray:
        """The code length of each gram, not a number where it was not sent."""
        slot = (grams * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - MEMO_BITS)).view(np.int64)
        out, lost = self.values[slot], np.flatnonzero(self.keys[slot] != grams)
        if len(lost):
            at = places(self.grams, grams[lost])
            out[lost] = np.where(at >= 0, self.codes[at] if len(self.codes) else np.nan, np.nan)
            self.keys[slot[lost]], self.values[slot[lost]] = grams[lost], out[lost]
        return out

    def texts(self, texts: list[list[bytes]], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sums of the code lengths known of each normalised text with its end; how many grams are left, and these."""
        if not texts:
            return np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        data, begins = padded(texts, order)
        codes, left, at = [np.zeros(order)], [], []
        for low, keys in gram_keys(data, order):
            found = self.code(keys)
            lost = np.flatnonzero(np.isnan(found))
            left.append(keys[lost])
            at.append(lost + low)
            codes.append(found)
        codes, left, at = np.nan_to_num(np.concatenate(codes)), np.concatenate(left), np.concatenate(at)
        owner = np.searchsorted(begins, at, side="right") - 1
        inside = at - begins[owner] >= order  # the ends that pad a text are given, not coded
        for i in range(order):
            codes[begins + i] = 0.0
        return np.add.reduceat(codes, begins), np.bincount(owner[inside], minlength=len(texts)), left[inside]


def counted(rows: DataFrame, order: int) -> DataFrame:
    """Partial counts ``(token, gram, n)`` of texts; a row has a token or a gram, those only in held-out texts count 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(tokens, grams, n):
            size = len(n)
            return pa.RecordBatch.from_arrays(
                [pa.nulls(size, pa.binary()) if tokens is None else pa.array(tokens, pa.binary()),
                 pa.nulls(size, pa.int64()) if grams is None else pa.array(grams.view(np.int64)), pa.array(n, pa.int64())], ["token", "gram", "n"])

        def flush():
            parts = list(words.items())
            for at in range(0, len(parts), 100_000):
                part = parts[at:at + 100_000]
                yield out([w for w, _ in part], None, [n for _, n in part])

        words, keys, counts = Counter(), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        read, n = {False: [], True: []}, 0

        def fold():
            nonlocal keys, counts, read, n
            for held_out, parts in read.items():
                if parts:
                    sorted_keys = np.sort(np.concatenate(parts))
                    first = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])) if len(sorted_keys) else np.zeros(0, np.int64)
                    keys, counts = folded(np.concatenate([keys, sorted_keys[first]]), np.concatenate(
                        [counts, np.diff(first, append=len(sorted_keys)) * (not held_out)]))
            read, n = {False: [], True: []}, 0

        for whole in batches:
            for low in range(0, whole.num_rows, 500):
                batch = whole.slice(low, 500)
                flags, every = batch.column(1).to_pylist(), [normal(t) for t in as_bytes(batch.column(0))]
                for held_out in (False, True):
                    texts = [t for t, flag in zip(every, flags) if flag == held_out]
                    if not texts:
                        continue
                    if not held_out:
                        for t in texts:
                            words.update(t)
                        words[b""] += len(texts)
                    data, begins = padded(texts, order)
                    inside = np.ones(len(data), bool)
                    for i in range(order):
                        inside[begins + i] = False
                    for at, part in gram_keys(data, order):
                        read[held_out].append(part[inside[at:at + len(part)]])
                        n += len(part)
                if n > GATHER:
                    fold()
                if len(words) > 1_500_000:
                    yield from flush()
                    words.clear()
        fold()
        yield from flush()
        for at in range(0, len(keys), 200_000):
            yield out(None, keys[at:at + 200_000], counts[at:at + 200_000])

    return rows.mapInArrow(run, "token binary, gram long, n long")


def coded(grams: DataFrame, order: int) -> DataFrame:
    """``gram, n, code`` of the distinct grams of ``(gram, n)``: the code length under the trie of those with counts.

    A partition holds all grams that share the last ``shared`` bytes before
    their symbol, so its contexts of that length and more are complete.
    """
    shared = min(2, order)
    ends = F.col("gram").bitwiseAND(F.lit((1 << 8 * (shared + 1)) - 1))
    low = []
    if shared:
        edge = grams.filter("n > 0").select(ends.alias("g")).distinct().groupBy(
            F.col("g").bitwiseAND(F.lit((1 << 8 * shared) - 1)).alias("g")).agg(F.count("*").alias("n")).toArrow().sort_by("g")
        low = [(edge["g"].to_numpy().astype(np.uint64), edge["n"].to_numpy())]
        for length in range(shared - 1, 0, -1):
            low.insert(0, shorter(low[0][0], length))
    sent = grams.sparkSession.sparkContext.broadcast(low)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = list(batches)
        if not found:
            return
        table = pa.Table.from_batches(found)
        keys, counts = table["gram"].to_numpy().view(np.uint64), table["n"].to_numpy()
        by = np.argsort(keys)
        keys, counts = keys[by], counts[by]
        levels = [(keys[counts > 0], counts[counts > 0])]
        for length in range(order, shared, -1):
            levels.insert(0, shorter(levels[0][0], length))
        trie = Trie([Level(k, c.astype(np.float64)) for k, c in [*sent.value, *levels]])
        for at in range(0, len(keys), 200_000):
            part = keys[at:at + 200_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.view(np.int64)), pa.array(counts[at:at + 200_000]), pa.array(trie.code(part))], ["gram", "n", "code"])

    before = F.shiftright("gram", 8).bitwiseAND(F.lit((1 << 8 * shared) - 1))
    return grams.repartition(before).select("gram", "n").mapInArrow(run, "gram long, n long, code double")


def most_frequent(codes: DataFrame, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending grams and code lengths of those with the largest counts, ``entries`` at most."""
    coarse = F.when(F.col("n") < 1024, F.col("n")).otherwise(F.pow(F.lit(2), F.floor(F.log2("n"))).cast("long"))
    sizes = codes.filter("n > 0").groupBy(coarse.alias("least")).agg(F.count("*").alias("m")).orderBy(F.desc("least")).collect()
    least, kept = 1, 0
    for row in sizes:
        kept += row.m
        if kept > entries:
            least = row.least + 1 if row.least < 1024 else 2 * row.least
            break
    found = codes.filter(F.col("n") >= least).select("gram", "code").toArrow()
    grams, values = found["gram"].to_numpy().view(np.uint64), found["code"].to_numpy()
    by = np.argsort(grams)
    return grams[by], values[by]


def ppm_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10, held: int = 0, order: int = 5,
               entries: int = 3_000_000, frequent: int = 300_000) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row.

    Rows whose ``crc32(id as text) mod folds`` is ``held`` are held out; all
    others train, those with a null id too. Texts are lowered (A-Z) and their words
    joined by single spaces; a token is a word, and one end closes each text.
    ``score`` is the log10 probability of the bytes of that text and its end
    under the trie; ``base_score`` that of its tokens under smoothed single
    counts. A null text is empty: one token, its end. Without training rows every
    byte costs log10 256. Repeated rows each count and get a result. Other
    columns are not read.

    The counts of the ``frequent`` most frequent tokens, and the code lengths of
    at most ``entries`` of the most frequent grams, are sent to the executors; all
    other tokens and grams of the texts meet theirs in joins. The scores do not
    depend on these two bounds.
    """
    if not 0 <= order <= 6:
        raise ValueError("a gram of order + 1 bytes must fit 63 bits")
    spark = df.sparkSession
    scratch = Scratch(spark)
    key = F.col(id_col).cast("string").cast("binary")
    held_out = F.coalesce(F.crc32(key) % folds == held, F.lit(False))
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"), F.col(text_col).cast("binary").alias("text"))
    counts = scratch.cut(counted(docs.select("text", "held_out"), order).groupBy("token", "gram").agg(F.sum("n").alias("n")))
    tokens = counts.filter("token is not null").select("token", "n")
    sums = tokens.agg(F.count("*").alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    kinds, total = sums.v, sums.n
    weight = -float(np.log10(total + 0.1 * (kinds + 1)))
    common = tokens.filter(F.octet_length("token") <= 64).orderBy(F.desc("n"), "token").limit(frequent).toArrow()
    codes = scratch.cut(coded(counts.filter("gram is not null").select("gram", "n"), order))
    sent = spark.sparkContext.broadcast((most_frequent(codes, entries), common["token"].to_pylist(), np.log10(common["n"].to_numpy() + 0.1)))
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = kept("ppm")
        if held.get("name") != name:
            parts, words, logs = sent.value
            held["name"], held["model"] = name, (Coder(*parts), dict(zip(words, logs.tolist())))
        coder, known = held["model"]
        number = TaskContext.get().partitionId() << 33
        for whole in batches:
            for low in range(0, whole.num_rows, 500):
                batch = whole.slice(low, 500)
                texts = [normal(t) for t in as_bytes(batch.column(2))]
                scores, lacking, left = coder.texts(texts, order)
                sizes, base, hits, rare = [], [], [], []
                for words in texts:
                    words.append(b"")
                    values = list(map(known.get, words))
                    lost = [w for w, v in zip(words, values) if v is None] if None in values else []
                    rare.append(lost)
                    sizes.append(len(words))
                    hits.append(len(words) - len(lost))
                    base.append(sum(v for v in values if v is not None) if lost else sum(values))
                ends = np.cumsum([0, *map(len, rare)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(number, number + len(texts))), batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                     pa.array(hits, pa.int64()), pa.array(base, pa.float64()), pa.array(scores),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array([w for r in rare for w in r], pa.binary())),
                     pa.ListArray.from_arrays(pa.array(np.cumsum([0, *lacking]).astype(np.int32)), pa.array(left.view(np.int64)))],
                    ["row", "doc_id", "held_out", "n_tokens", "known", "base", "score", "rare", "grams"])
                number += len(texts)

    scored = scratch.cut(docs.mapInArrow(
        run, "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double, rare array<binary>, grams array<long>"))
    looked = scored.select("row", F.explode("rare").alias("token")).join(tokens, "token", "left")
    rest = looked.groupBy("row").agg(F.count("n").alias("rare_known"), F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.1)).alias("rare_base"))
    coding = scored.select("row", F.explode("grams").alias("gram")).join(codes.select("gram", "code"), "gram")
    more = coding.groupBy("row").agg(F.sum("code").alias("more"))
    return scored.drop("rare", "grams").join(rest, "row", "left").join(more, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0)) + F.col("n_tokens") * F.lit(weight)).alias("base_score"),
        (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"))
