"""SentencePiece BPE by vectorised merge rounds, and decoding.

Texts are cut into words where no piece of the vocabulary can reach across,
and words not met before are encoded together: their symbols lie in one flat
array, every round looks up the rank of each pair of neighbours, takes the
least rank of each word and merges all its leftmost places that do not
overlap, and symbols are compacted until no pair is left.

Merging all places at once equals merging them one after the other unless the
new symbol may at once form a better pair. Those symbols are known from the
vocabulary (``eager``); of them one place a round is merged, and a word with
many such places (a long run of spaces) is left to a queue of its pairs.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepforge.llm.common import as_bytes, kept

SPACE = "▁"
AT_ONCE = 512
#: Words a worker remembers; beyond it they are forgotten together and learnt anew. Longer words are encoded again each time.
KEPT_WORDS, KEPT_LENGTH = 400_000, 64
#: Symbols that are merged in one array.
TOGETHER = 1 << 19
#: Eager places of a word beyond which its pairs go through a queue.
MANY = 32
NONE = np.iinfo(np.int32).max


class Pieces:
    """Tables of a BPE model with identity normaliser, dummy prefix and byte fallback."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules, trained, kind = model.normalizer_spec, model.trainer_spec, model.SentencePiece
        if (trained.model_type != trained.BPE or not trained.byte_fallback or trained.treat_whitespace_as_suffix or rules.precompiled_charsmap
                or not rules.add_dummy_prefix or rules.remove_extra_whitespaces or not rules.escape_whitespaces
                or any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in model.pieces)):
            raise ValueError("expects BPE pieces with byte fallback, a dummy prefix and no normalisation")
        self.begin, self.end = trained.bos_id, trained.eos_id
        self.unknown = {i for i, p in enumerate(model.pieces) if p.type == kind.UNKNOWN}
        self.unknown_text = trained.unk_surface
        self.byte_of = {i: int(p.piece[1:-1], 16) for i, p in enumerate(model.pieces) if p.type == kind.BYTE}
        self.byte_id = np.zeros(256, np.uint32)
        self.byte_id[list(self.byte_of.values())] = list(self.byte_of)
        self.raw = np.array([p.piece.encode() if p.type == kind.NORMAL else b"" for p in model.pieces], object)
        for i, byte in self.byte_of.items():
            self.raw[i] = bytes([byte])
        self.spoken = np.array([p.type != kind.CONTROL for p in model.pieces])
        # Ids that are not read as their bytes stand: the unknown one, and a byte that the sign of a space begins with.
        self.slow = np.array([i in self.unknown or self.byte_of.get(i) == SPACE.encode()[0] for i in range(len(model.pieces))])
        id_of = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kind.NORMAL}
        self.size = len(model.pieces)
        _, rank = np.unique([-p.score for p in model.pieces], return_inverse=True)
        self.rank = rank.astype(np.int32)
        splits = [(id_of[p[:k]], id_of[p[k:]], i) for p, i in id_of.items() for k in range(1, len(p)) if p[:k] in id_of and p[k:] in id_of]
        left, right, merged = np.array(splits, np.int64).reshape(-1, 3).T
        keys = left * self.size + right
        order = np.argsort(keys)
        self.keys, self.merged = keys[order], merged[order].astype(np.int32)
        self.eager = np.zeros(self.size, bool)
        for part in (left, right):
            self.eager[part[self.rank[merged] <= self.rank[part]]] = True
        singles = sorted((ord(p), i) for p, i in id_of.items() if len(p) == 1)
        self.points, self.point_id = np.array([s[0] for s in singles], np.uint32), np.array([s[1] for s in singles], np.int32)
        self.meets = np.unique(np.array([ord(a) << 32 | ord(b) for p in id_of for a, b in zip(p, p[1:])], np.int64))
        # Before a space that follows another character no piece goes on, and no piece holds a line end and something else.
        if any(SPACE in p.lstrip(SPACE) or len(p) > 1 and "\n" in p for p in id_of):
            raise ValueError("pieces reach across words")
        self.words = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")
        self.known: dict[str, bytes] = {}
        self.pair: dict[int, tuple[int, int]] = {}

    def ranked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and id of the piece each pair makes; ``NONE`` where it makes none."""
        keys = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = (self.keys[at] == keys) & (left >= 0) & (right >= 0)
        merged = np.where(hit, self.merged[at], 0)
        return np.where(hit, self.rank[merged], NONE), merged

    def one_by_one(self, symbols: list[int]) -> tuple[list[int], list[int]]:
        """The symbols left of one word and their first places, merged in the order of rank and place."""
        if not self.pair:
            self.pair = dict(zip(self.keys.tolist(), zip(self.rank[self.merged].tolist(), self.merged.tolist())))
        n = len(symbols)
        after, before, queue = list(range(1, n + 1)), list(range(-1, n - 1)), []

        def offer(i):
            j = after[i] if i >= 0 else n
            if j < n and min(symbols[i], symbols[j]) >= 0:
                found = self.pair.get(symbols[i] * self.size + symbols[j])
                if found:
                    heapq.heappush(queue, (found[0], i, symbols[i], symbols[j], found[1]))

        for i in range(n - 1):
            offer(i)
        while queue:
            _, i, left, right, merged = heapq.heappop(queue)
            if symbols[i] != left or after[i] >= n or symbols[after[i]] != right:
                continue
            gone = after[i]
            symbols[i], symbols[gone], after[i] = merged, None, after[gone]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        left = [i for i in range(n) if symbols[i] is not None]
        return [symbols[i] for i in left], left

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols left when no pair of a word makes a piece, with their first places.

        ``word`` numbers the word of each symbol, rising; symbols below 0 never merge.
        """
        place = np.arange(len(symbols))
        done_symbols, done_places = [], []

        def pairs(at):
            inside = at[at + 1 < len(word)]
            inside = inside[word[inside] == word[inside + 1]]
            rank[at], merged[at] = NONE, 0
            rank[inside], merged[inside] = self.ranked(symbols[inside], symbols[inside + 1])

        rank, merged = np.empty(len(symbols), np.int32), np.empty(len(symbols), np.int32)
        pairs(place)
        while len(symbols):
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(starts, append=len(word))
            open_ = np.repeat(least < NONE, sizes)
            if not open_.all():
                done_symbols.append(symbols[~open_])
                done_places.append(place[~open_])
                symbols, word, place, rank, merged = (x[open_] for x in (symbols, word, place, rank, merged))
                least, sizes = least[least < NONE], sizes[least < NONE]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == np.repeat(least, sizes))
            # Of places side by side every second one, of eager symbols only a word's first place.
            chain = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            odd = (np.arange(len(at)) - np.repeat(chain, np.diff(chain, append=len(at)))) & 1
            first = np.diff(word[at], prepend=-1) != 0
            # A word with an eager place merges only its first one: pieces of equal rank may differ.
            places = np.diff(np.flatnonzero(first), append=len(at))
            eager = np.logical_or.reduceat(self.eager[merged[at]], np.flatnonzero(first))
            if (eager & (places > MANY)).any():
                queued = np.repeat(eager & (places > MANY), sizes)
                for run in np.split(np.flatnonzero(queued), np.cumsum(sizes[eager & (places > MANY)])[:-1]):
                    found, begins = self.one_by_one(symbols[run].tolist())
                    done_symbols.append(np.array(found, np.int32))
                    done_places.append(place[run][begins])
                symbols, word, place, rank, merged = (x[~queued] for x in (symbols, word, place, rank, merged))
                continue
            at = at[np.where(np.repeat(eager, places), first, odd == 0)]
            symbols[at] = merged[at]
            left = np.ones(len(symbols), bool)
            left[at + 1] = False
            symbols, word, place, rank, merged = (x[left] for x in (symbols, word, place, rank, merged))
            at -= np.arange(len(at))
            pairs(np.unique(np.concatenate([at, at[at > 0] - 1])))
        if not done_symbols:
            return symbols, place
        symbols, place = np.concatenate(done_symbols), np.concatenate(done_places)
        order = np.argsort(place)
        return symbols[order], place[order]

    def learn(self, words: list[str]) -> None:
        """Encode words not yet known, all in one array."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        # A word is cut again wherever two characters meet in no piece.
        cut = np.ones(len(points), bool)
        met = points[:-1].astype(np.int64) << 32 | points[1:]
        cut[1:] = self.meets[np.minimum(np.searchsorted(self.meets, met), len(self.meets) - 1)] != met
        ends = np.cumsum(sizes)
        cut[ends[:-1]] = True
        at = np.minimum(np.searchsorted(self.points, points), len(self.points) - 1)
        known = self.points[at] == points
        symbols, place = self.merge(np.where(known, self.point_id[at], -1).astype(np.int32), np.cumsum(cut) - 1)
        ids, counts = symbols.astype(np.uint32), np.ones(len(symbols), np.int64)
        strange = np.flatnonzero(symbols < 0)
        if strange.size:
            data = [chr(p).encode() for p in points[place[strange]].tolist()]
            counts[strange] = list(map(len, data))
            ids = np.repeat(ids, counts)
            ids[np.repeat(symbols < 0, counts)] = self.byte_id[np.frombuffer(b"".join(data), np.uint8)]
        upto = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(place, np.concatenate([[0], ends]))] * 4
        raw, upto = ids.astype("<u4").tobytes(), upto.tolist()
        for word, a, b in zip(words, upto, upto[1:]):
            self.known[word] = raw[a:b]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids between begin and end, as little-endian unsigned 32-bit numbers."""
        cut = [self.words.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        new = list(set().union(*cut).difference(self.known))
        if len(self.known) + len(new) > KEPT_WORDS:
            self.known.clear()
            new = list(set().union(*cut))
        upto = np.cumsum(np.fromiter(map(len, new), np.int64, len(new)))
        at = 0
        while at < len(new):
            to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + TOGETHER)))
            self.learn(new[at:to])
            at = to
        begin, end = np.array([[self.begin], [self.end]], "<u4")
        out = [begin.tobytes() + b"".join(map(self.known.__getitem__, words)) + end.tobytes() for words in cut]
        for word in new:
            if len(word) > KEPT_LENGTH:
                del self.known[word]
        return out

    def decode(self, data: bytes) -> str:
        """The text of ids: spaces for their sign, the first one dropped, bytes read together."""
        ids = np.frombuffer(data, "<u4")
        if not self.slow[ids].any() and self.spoken[ids[1:-1]].all():
            try:
                text = b"".join(self.raw[ids].tolist()).decode()
                return text.replace(SPACE, " ")[bool(len(ids)) and self.drops(ids):]
            except UnicodeDecodeError:
                pass
        parts, run = [], bytearray()
        for i in ids.tolist():
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            parts.append(characters(bytes(run)))
            run.clear()
            parts.append(self.unknown_text if i in self.unknown else self.raw[i].decode().replace(SPACE, " "))
        return "".join(parts + [characters(bytes(run))])[self.drops(ids):]

    def drops(self, ids: np.ndarray) -> bool:
        """Whether the first id that has a text begins with the sign of a space."""
        texts = np.flatnonzero(self.spoken[ids])
        return bool(texts.size) and ids[texts[0]] not in self.byte_of and self.raw[ids[texts[0]]].startswith(SPACE.encode())


def characters(data: bytes) -> str:
    """UTF-8 with one replacement character for every byte that belongs to no character."""
    parts = []
    while data:
        try:
            parts.append(data.decode())
            break
        except UnicodeDecodeError as bad:
            parts += data[:bad.start].decode(), "\N{REPLACEMENT CHARACTER}"
            data = data[bad.start + 1:]
    return "".join(parts)


def pieces(path: str) -> Pieces:
    """The model of ``path``, kept by the worker process over its tasks."""
    held = kept("pieces")
    if path not in held:
        held[path] = Pieces(path)
    return held[path]


def encode_pieces(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` per row, in input order and without an exchange.

    ``ids`` are the ids of the whole text between begin and end, little-endian
    unsigned 32-bit numbers in a row, ``decoded`` is the text they stand for. A
    null text counts as empty: begin and end alone. Rows that repeat an id, or
    have none, each get their row. Other columns are not read. ``path`` names a
    model file that every executor has.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for whole in batches:
            for at in range(0, whole.num_rows, AT_ONCE):
                batch = whole.slice(at, AT_ONCE)
                ids = model.encode([t.decode("utf-8", "replace") for t in as_bytes(batch.column(1))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                     pa.array(map(model.decode, ids), pa.string())], ["doc_id", "n_tokens", "ids", "decoded"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")


def decode_pieces(df: DataFrame, path: str, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """The rows with the text of their ids as column ``to``; null ids give null.

    ``ids_col`` holds little-endian unsigned 32-bit numbers in a row. Bytes that
    make no character become replacement characters.
    """
    @F.arrow_udf("string")
    def text(ids: pa.Array) -> pa.Array:
        model = pieces(path)
        return pa.array([None if x is None else model.decode(x) for x in ids.to_pylist()], pa.string())

    return df.withColumn(to, text(F.col(ids_col)))
