"""Token counts of whole texts by a transducer compiled from a byte-level BPE file.

A byte-level BPE tokenizer is deterministic from left to right: the last token
of a prefix follows from the last tokens of its shorter prefixes, since two
tokens may stand side by side exactly when their joined bytes encode to the
two. What the next byte can change reaches back no further than the longest
vocabulary prefix that ends here, so a state is that prefix with the last
token and the relative count before each of its bytes: a finite set, built as
texts ask for it. A transition carries the emitted-token count, which is how
much the count of the prefix changes, and the token it ends with.

A white space after another character always ends a token. Texts are cut into
segments there, which is the state all paths come back to; a path through a
whole segment is kept as one transition. A chunk of a text is a map from the
pending segment at its entry to the pending segment at its exit and a count;
maps compose, so the chunks of a text are joined pairwise in a scan, and a text
of any length holds one chunk of segments at a time.
"""

from __future__ import annotations

import itertools
import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepforge.llm.common import as_bytes, kept

# The splitting pattern of byte-level BPE files that set use_regex.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters from here on go to the library, whose letter classes may be of another Unicode version.
FIRST_FOREIGN = "ɐ"
BOUNDARY = re.compile(r"(?<=\S)(?= )")
#: White space before a space: no boundary there.
SPACED = [chr(c) + " " for c in range(0x3001) if chr(c).isspace()]
ASCII_SPACED = [p for p in SPACED if p.isascii()]
CHUNK = 1 << 16
#: Most segments a worker process remembers, and texts it reads at once.
KEPT = 800_000
AT_ONCE = 500
#: Signs that are a pre-token of their own behind a word at a segment's end, and segments encoded as one text.
SIGNS = ".,;:!?"
JOINED = 2000


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, by its rule."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("\xa1"), ord("\xac") + 1), *range(ord("\xae"), ord("\xff") + 1)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Transducer:
    """BPE over the bytes of pre-tokens, with states and transitions built on demand.

    Many pre-tokens are read at once, a byte of each per step. Transitions
    built since the last rebuild of the sorted table are found in a dict.
    """

    END = "<BIh"
    LONG = 64

    def __init__(self, vocab: dict[bytes, int], merges: list[tuple[bytes, bytes]]):
        self.vocab, self.rank = vocab, {m: i for i, m in enumerate(merges)}
        self.prefixes = {t[:i] for t in vocab for i in range(1, len(t) + 1)}
        self.bytes_of = {i: t for t, i in vocab.items()}
        self.length_of = np.zeros(max(self.bytes_of) + 1, np.int64)
        for i, t in self.bytes_of.items():
            self.length_of[i] = len(t)
        self.start = len(self.length_of)  # stands for "nothing before"
        self.pairs: dict[tuple[int, bytes], bool] = {}
        self.number: dict[bytes, int] = {}
        self.states: list[bytes] = []
        self.new: dict[int, tuple[int, int, int]] = {}
        self.keys, self.steps = np.array([-1]), np.zeros((1, 3), np.int64)
        self.state(b"", [(0, self.start, 0)])

    def state(self, pending: bytes, ends: list[tuple[int, int, int]]) -> int:
        key = bytes([len(ends)]) + b"".join(struct.pack(self.END, *e) for e in ends) + pending
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
        return self.number[key]

    def merge(self, data: bytes) -> list[bytes]:
        """The tokens of ``data`` by the merge rule itself."""
        parts, none = [data[i:i + 1] for i in range(len(data))], len(self.rank)
        while len(parts) > 1:
            ranks = [self.rank.get(p, none) for p in zip(parts, parts[1:])]
            best = min(ranks)
            if best == none:
                break
            at = ranks.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follows(self, left: int, token: bytes) -> bool:
        """Whether ``token`` may stand after the token ``left``."""
        known = self.pairs.get((left, token))
        if known is None:
            before = [] if left == self.start else [self.bytes_of[left]]
            known = self.pairs[left, token] = self.merge(token) == [token] and self.merge(b"".join(before) + token) == [*before, token]
        return known

    def compile(self, key: int) -> tuple[int, int, int]:
        """The transition for ``key`` (state and byte): next state, emitted count, last token.

        A state is the pending vocabulary prefix and, for each of its suffixes
        that is one too, longest first: its length, the last token before it and
        the count up to there against the count at the end.
        """
        if key in self.new:
            return self.new[key]
        packed = self.states[key >> 8]
        cut = 1 + packed[0] * struct.calcsize(self.END)
        pending = packed[cut:] + bytes([key & 255])
        size, token, open_ends = len(pending), None, []
        for length, left, count in struct.iter_unpack(self.END, packed[1:cut]):
            suffix = pending[size - length - 1:]
            if suffix in self.prefixes:
                open_ends.append((length + 1, left, count))
                if token is None and suffix in self.vocab and self.follows(left, suffix):
                    token, emitted = self.vocab[suffix], count + 1
        if token is None:
            raise ValueError("the vocabulary lacks a byte")
        after = [(length, left, count - emitted) for length, left, count in open_ends] + [(0, token, 0)]
        out = self.new[key] = self.state(pending[size - after[0][0]:], after), emitted, token
        return out

    def step(self, keys: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        out = self.steps[at]
        lost = np.flatnonzero(self.keys[at] != keys)
        if len(lost):
            new, back = np.unique(keys[lost], return_inverse=True)
            out[lost] = np.array([self.compile(k) for k in new.tolist()])[back]
        return out

    def settle(self) -> None:
        """Move new transitions into the sorted table."""
        if len(self.new) * 8 > len(self.keys):
            keys = np.concatenate([self.keys, np.fromiter(self.new, np.int64, len(self.new))])
            order = np.argsort(keys)
            self.keys = keys[order]
            self.steps = np.concatenate([self.steps, np.array(list(self.new.values()))])[order]
            self.new = {}

    def read(self, pieces: list[bytes]) -> list[int]:
        """The token count of each pre-token."""
        if not pieces:
            return []
        out = [0] * len(pieces)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        for i in np.flatnonzero(size > self.LONG):
            out[i] = self.read_long(pieces[i])
        order = np.flatnonzero(size <= self.LONG)
        order = order[np.argsort(-size[order], kind="stable")]
        if not len(order):
            return out
        start, size = (np.cumsum(size) - size)[order], size[order]
        data = np.frombuffer(b"".join(pieces), np.uint8)
        state, count = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        for i in range(int(size[0])):
            n = int(np.searchsorted(-size, -i))  # pre-tokens longer than i
            took = self.step(state[:n] << 8 | data[start[:n] + i])
            state[:n] = took[:, 0]
            count[:n] += took[:, 1]
        for i, n in zip(order.tolist(), count.tolist()):
            out[i] = n
        return out

    def read_long(self, data: bytes) -> int:
        state, count = 0, 0
        for byte in data:
            state, emitted, _ = self.step(np.array([state << 8 | byte]))[0].tolist()
            count += emitted
        return count


def shrink(known: dict) -> None:
    """Beyond ``KEPT`` results the later half goes: what is frequent came early."""
    if len(known) > KEPT:
        early = dict(itertools.islice(known.items(), KEPT // 2))
        known.clear()
        known.update(early)


class Compiled:
    """A tokenizer file as transducer.

    ``library`` is the file's own tokenizer, for the ids of segments and for the
    counts of those that hold an added token or characters outside the Latin blocks.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, split = spec["model"], spec["pre_tokenizer"]
        level = {k: split.get(k) for k in ("type", "add_prefix_space", "use_regex")}
        if (model["type"], level) != ("BPE", {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}) or spec[
                "normalizer"] or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError(f"{path} is no plain byte-level BPE")
        symbols = byte_symbols()
        raw = lambda s: bytes(symbols[c] for c in s)
        added = {t["content"] for t in spec["added_tokens"]}
        if any(re.search(r"\s", t) for t in added) or any(t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("an added token reaches over white space")
        vocab = {raw(t): i for t, i in model["vocab"].items() if t not in added}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.transducer = Transducer(vocab, [(raw(a), raw(b)) for a, b in merges])
        self.library, self.added = Tokenizer.from_file(path), sorted(added)
        self.find = regex.compile(PATTERN).findall
        self.known: dict[bool, dict] = {False: {}, True: {}}

    def pieces(self, segment: str) -> list[str]:
        """The pre-tokens of a segment; words of letters with at most one sign behind need no pattern."""
        if segment[0] == " ":
            if segment[1:].isalpha():
                return [segment]
            if segment[1:-1].isalpha() and segment[-1] in SIGNS:
                return [segment[:-1], segment[-1]]
        return self.find(segment)

    def foreign(self, segment: str) -> bool:
        return max(segment) >= FIRST_FOREIGN or any(t in segment for t in self.added)

    def learn_counts(self, segments: list[str]) -> None:
        """Read segments not yet known by the transducer."""
        todo, pieces, known = [], [], self.known[False]
        for segment in segments:
            if self.foreign(segment):
                known[segment] = len(self.library.encode(segment, add_special_tokens=False).ids)
            else:
                found = self.pieces(segment)
                todo.append((segment, len(found)))
                pieces += found
        read = iter(self.transducer.read([p.encode() for p in pieces]))
        for segment, n in todo:
            known[segment] = sum(itertools.islice(read, n))
        self.transducer.settle()

    def learn_ids(self, segments: list[str]) -> None:
        """Encode segments not yet known by the library.

        Segments that begin with a space and end without one meet at boundaries, so they are encoded as one
        text; the bytes of the tokens tell where each segment's ids end. A word with one sign behind it is
        the word's ids and the sign's.
        """
        known, signed, words, alone, text = self.known[True], [], set(), [], " ".join(segments)
        # Nearly always none: what the whole lacks need not be looked for in every segment.
        met = [t for t in self.added if t in text]
        for segment in segments:
            if segment[0] != " " or segment[-1].isspace() or met and any(t in segment for t in met):
                alone.append(segment)
            elif segment[-1] in SIGNS and segment.isascii() and segment[1:-1].isalpha():
                signed.append(segment)
                words.add(segment[:-1])
            else:
                words.add(segment)
        words = [w for w in words if w not in known]
        for at in range(0, len(words), JOINED):
            part = words[at:at + JOINED]
            text = "".join(part)
            ids = np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            ends = np.cumsum(np.fromiter(map(len, part if text.isascii() else map(str.encode, part)), np.int64, len(part)))
            cuts, data = 4 * np.searchsorted(np.cumsum(self.transducer.length_of[ids]), ends, side="right"), ids.tobytes()
            known.update(zip(part, map(data.__getitem__, map(slice, [0, *cuts.tolist()], cuts.tolist()))))
        for segment in [*SIGNS, *alone]:
            if segment not in known:
                known[segment] = np.array(self.library.encode(segment, add_special_tokens=False).ids, "<u4").tobytes()
        for segment in signed:
            known[segment] = known[segment[:-1]] + known[segment[-1]]

    def look(self, lists: list[list[str]], ids: bool) -> list[list]:
        """Results for every segment of every list."""
        known = self.known[ids]
        shrink(known)
        new = set().union(*lists).difference(known)
        new.discard("")
        (self.learn_ids if ids else self.learn_counts)(list(new))
        known[""] = b"" if ids else 0
        return [map(known.__getitem__, x) for x in lists]

    def segment_count(self, segment: str) -> int:
        return next(self.look([[segment]], False)[0])

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        return [b"".join(x) for x in self.look(list(map(segments, texts)), True)]

    # A chunk's map: (text before its first boundary, count up to its last one, text after), or
    # (text, None, "") for a chunk without a boundary.
    def chunk_maps(self, chunks: list[str]) -> list[tuple[str, int | None, str]]:
        cut = list(map(segments, chunks))
        inner = self.look([c[1:-1] for c in cut], False)
        return [(c[0], None, "") if len(c) == 1 else (c[0], sum(n), c[-1]) for c, n in zip(cut, inner)]

    def compose(self, a: tuple, b: tuple) -> tuple:
        before = a[0] if a[1] is None else a[2]
        met = self.chunk_maps([before + b[0]])[0]
        if a[1] is None and b[1] is None:
            return met
        if a[1] is None:
            return (met[0], b[1], b[2]) if met[1] is None else (met[0], met[1] + self.segment_count(met[2]) + b[1], b[2])
        if b[1] is None:
            return (a[0], a[1], met[0]) if met[1] is None else (a[0], a[1] + self.segment_count(met[0]) + met[1], met[2])
        return a[0], a[1] + self.total(met) + b[1], b[2]

    def total(self, chunk: tuple) -> int:
        head, body, tail = chunk
        return self.segment_count(head) + (0 if body is None else body + self.segment_count(tail))

    def counts(self, texts: list[str], chunk: int = CHUNK) -> list[int]:
        """The token count of each text; long texts are read in chunks whose maps are joined pairwise."""
        out = [0] * len(texts)
        short = [i for i, t in enumerate(texts) if len(t) <= chunk]
        for i, n in zip(short, self.look([segments(texts[i]) for i in short], False)):
            out[i] = sum(n)
        for i in set(range(len(texts))).difference(short):
            text = texts[i]
            maps = [self.chunk_maps([text[k:k + chunk]])[0] for k in range(0, len(text), chunk)]
            while len(maps) > 1:
                maps = [self.compose(*maps[k:k + 2]) if k + 1 < len(maps) else maps[k] for k in range(0, len(maps), 2)]
            out[i] = self.total(maps[0])
        return out


def segments(text: str) -> list[str]:
    """Cut before every space that follows a character other than white space."""
    # A single character is found far faster than a pair, and most of these are in no text.
    if any(pair[0] in text and pair in text for pair in (ASCII_SPACED if text.isascii() else SPACED)) or text[:1] == " ":
        return BOUNDARY.split(text)
    first, *rest = text.split(" ")
    return [first, *map(" ".__add__, rest)]


def compiled(path: str) -> Compiled:
    """The transducer of ``path``, kept by the worker process over its tasks."""
    held = kept("compiled")
    if path not in held:
        held[path] = Compiled(path)
    return held[path]


def token_counts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row, in input order and without an exchange.

    A null text counts as empty: no bytes, no tokens. Rows that repeat an id,
    or have none, each get their row. Other columns are not read. ``path``
    names a byte-level BPE file every executor has.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = compiled(path)
        for whole in batches:
            for at in range(0, whole.num_rows, AT_ONCE):
                batch = whole.slice(at, AT_ONCE)
                texts = as_bytes(batch.column(1))
                counts = model.counts([t.decode("utf-8", "replace") for t in texts])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(map(len, texts), pa.int64()), pa.array(counts, pa.int64()),
                     pa.array([n > limit for n in counts], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
