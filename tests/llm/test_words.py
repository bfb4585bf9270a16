"""Periodic runs, sentence pieces and spelling variants against brute force and the library."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from stepforge.llm.periodic import periodic_runs, runs_of
from stepforge.llm.queries import QUERIES, vocabulary, with_planted_runs
from stepforge.llm.sentence_pieces import Pieces, decode_pieces, encode_pieces, pieces
from stepforge.llm.variants import near_words, spelling_variants

SF = "/root/testdata/sf0.001"
MODEL = vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_runs(words, shortest=24):
    found = {}
    for period in range(1, len(words) // 3 + 1):
        at = 0
        while at + period < len(words):
            end = at
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            if end + period - at >= max(shortest, 3 * period):
                found.setdefault((at, end + period - at), period)
            at = max(end, at + 1)
    return sorted((a, n, p) for (a, n), p in found.items())


def plain_collapse(words, runs):
    gone = {i for a, n, p in runs for i in range(a + p, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_of_random_words():
    draw = random.Random(7)
    texts = []
    for _ in range(250):
        letters, n = draw.choice([1, 2, 2, 3, 5, 60]), draw.choice([0, 1, 5, 24, 40, 100, 250, 500])
        words = [str(draw.randrange(letters)) for _ in range(n)]
        for _ in range(draw.randrange(4) if n > 10 else 0):
            a = draw.randrange(n)
            p, end = draw.randrange(1, (n - a) // 3 + 2), draw.randrange(a, n)
            for i in range(a, end):
                words[i] = words[a + (i - a) % p]
            if draw.random() < 0.5:
                words[draw.randrange(a, n)] = "x"
        texts.append(draw.choice([" ", "\n ", "\t", " \x0b"]).join(words) + draw.choice(["", " "]))
    texts += [texts[10]] * 3 + [None, "", "\x1c\x85 a"]
    n_words, runs, collapsed = (x.to_pylist() for x in runs_of(pa.array(texts), 24, 3))
    for text, n, found, left in zip(texts, n_words, runs, collapsed):
        words = words_of(text)
        expected = plain_runs(words)
        assert (n, [(r["start"], r["length"], r["period"]) for r in found]) == (len(words), expected)
        assert left == plain_collapse(words, expected)
    assert sum(map(len, runs)) > 50


def test_long_runs():
    n = 200_000
    texts = [" ".join(str(i * i % 7919) for i in range(n)), "x " * n, " ".join(str(i % 5000) for i in range(n)), " ".join(map(str, range(n)))]
    _, runs, collapsed = runs_of(pa.array(texts), 24, 3)
    assert [[tuple(r.values()) for r in x] for x in runs.to_pylist()] == [[(0, n, 7919)], [(0, n, 1)], [(0, n, 5000)], []]
    assert [len(c.split()) for c in collapsed.to_pylist()] == [7919, 1, 5000, n]


@pytest.mark.parametrize("name", ["odd", "none"])
def test_runs_bear_odd_rows(request, name):
    df = request.getfixturevalue(name)
    rows = [(r.doc_id, words_of(r.text)) for r in df.collect()]
    expected = [(d, len(w), plain_runs(w[:3000])) for d, w in rows if len(w) < 3000]
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs]) for r in periodic_runs(df).collect()]
    assert len(got) == len(rows)
    assert Counter(map(repr, (g for g in got if g[1] < 3000))) == Counter(map(repr, expected))


def plain_planted(doc, text):
    words, h = words_of(text), zlib.crc32(str(doc).encode())
    g, n = h // 10, len(words)
    if doc is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_runs_query(spark, documents):
    expected = []
    for d, text in documents.select("doc_id", "text").collect():
        words = plain_planted(d, text)
        if len(words) > 4000:
            continue
        runs = plain_runs(words)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        expected.append((d, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                         sha("".join(f"{a},{n},{p}\n" for a, n, p in runs)), sha(plain_collapse(words, runs))))
    got = {tuple(r) for r in QUERIES["op11_periodic_runs"](spark, SF).collect()}
    assert len(expected) > 150 and got.issuperset(expected) and len(got) == documents.count()
    assert sum(e[1] > 0 for e in expected) > 5


def test_planting_bears_odd_rows(odd, none):
    assert with_planted_runs(none).collect() == []
    rows = [(r.doc_id, words_of(r.text)) for r in with_planted_runs(odd).collect()]
    assert sorted(map(repr, rows)) == sorted(repr((r.doc_id, plain_planted(r.doc_id, r.text))) for r in odd.collect())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_pieces_of_random_texts(library):
    draw, model = random.Random(3), pieces(MODEL)
    parts = ["a", "b", "in", "the", " ", "  ", "\n", "\t", "中", "文", "é", "▁", "😀", "\0", "<s>", "<0x41>", "ing", "aaaa", "1", "--", "==", "“", "ß", "　", "​", "한국"]
    texts = ["", " ", "  ", "▁", "\n", " a", "a ", "a  b", " " * 5000, "=" * 333 + " " * 40 + "x", "a" * 3000, ("a" + " " * 33) * 90]
    for _ in range(1500):
        pool = draw.sample(parts, draw.choice([1, 2, 3, 5, len(parts)]))
        texts.append("".join(draw.choice(pool) for _ in range(draw.choice([1, 2, 5, 20, 100, 300]))))
    got = model.encode(texts)
    expected = library.encode(texts, add_bos=True, add_eos=True)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == expected
    assert [model.decode(x) for x in got] == [library.decode(x) for x in expected]


def test_forgotten_words_are_learnt_anew(library, monkeypatch):
    monkeypatch.setattr("stepforge.llm.sentence_pieces.KEPT_WORDS", 10)
    monkeypatch.setattr("stepforge.llm.sentence_pieces.TOGETHER", 16)
    monkeypatch.setattr("stepforge.llm.sentence_pieces.KEPT_LENGTH", 12)
    model = Pieces(MODEL)
    for k in range(3):
        texts = [f"word{i} another{i * k} wordofmanyletters{i}" for i in range(20)]
        assert [np.frombuffer(x, "<u4").tolist() for x in model.encode(texts)] == library.encode(texts, add_bos=True, add_eos=True)
        assert max(map(len, model.known)) <= 12


def test_any_ids_decode_as_the_library_does(spark, library):
    draw = random.Random(4)
    some = [0, 1, 2, 3 + 0xE2, 3 + 0x96, 3 + 0x81, 259, 28705]
    lists = [[draw.choice([draw.choice(some), draw.randrange(3, 259), draw.randrange(259, 32000)]) for _ in range(draw.randrange(12))] for _ in range(2000)]
    rows = spark.createDataFrame([(np.array(x, "<u4").tobytes(), "mine") for x in lists] + [(None, "mine")], "ids binary, text string")
    got = decode_pieces(rows, MODEL).collect()
    assert [r.decoded for r in got] == [library.decode(x) for x in lists] + [None]
    assert {r.text for r in got} == {"mine"}


@pytest.mark.parametrize("name", ["documents", "odd", "none"])
def test_pieces_of_documents(request, library, name):
    df = request.getfixturevalue(name)
    expected = []
    for r in df.collect():
        ids = library.encode(r.text or "", add_bos=True, add_eos=True)
        expected.append((r.doc_id, len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids)))
    got = [(r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in encode_pieces(df, MODEL).collect()]
    assert Counter(got) == Counter(expected)


def test_pieces_query(spark, documents, library):
    expected = set()
    for r in documents.collect():
        ids = library.encode(r.text or "", add_bos=True, add_eos=True)
        expected.add((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha(library.decode(ids))))
    assert {tuple(r) for r in QUERIES["op12_sentence_pieces"](spark, SF).collect()} == expected


def plain_variants(rows, drop_one_in=31):
    n = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{word}".encode())
            if drop_one_in and h % drop_one_in == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            n[word] += len(word) >= 7
    n = {w: k for w, k in n.items() if k >= 2}
    holes, near, form = defaultdict(set), defaultdict(set), {}
    for w in n:
        for i in range(len(w)):
            holes[w[:i], w[i + 1:]].add(w)
    for (a, b), words in holes.items():
        for w in words:
            near[w] |= words - {w}
            if a + b in n:
                near[w].add(a + b)
                near[a + b].add(w)
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 10 * n[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n)


def varied(seed):
    """Texts of words with edits at every place, of 7 to 70 symbols, with counts that form chains."""
    draw, pool = random.Random(seed), []
    for _ in range(30):
        word = "".join(draw.choice("abcé") for _ in range(draw.choice([7, 8, 9, 12, 17, 18, 20, 35, 60])))
        for k in (3, 40, 900):
            pool += [word] * k
            letters, at, what = list(word), draw.randrange(len(word)), draw.randrange(3)
            if what == 0:
                letters[at] = draw.choice("abcéz")
            else:
                letters[at:at + what - 1] = [draw.choice("abc")] if what == 1 else []
            word = "".join(letters)
        pool += [word]
    return [(i, " ".join(draw.sample(pool, len(pool) // 8))) for i in range(24)] + [(None, "Hello Ärgernis hello ärgernis"), (7, None), (7, "")]


@pytest.mark.parametrize("span", [8, 1, 3])
def test_variants(spark, span):
    rows = varied(span)
    expected = plain_variants(rows)
    got = spelling_variants(spark.createDataFrame(rows, "doc_id long, text string"), drop_one_in=31, span=span)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == expected
    assert any(e[1] != e[2] and e[1] for e in expected) and max(len(e[0]) for e in expected) > 40


def test_crowded_nodes_make_only_near_pairs(spark):
    """Words that share all but their last symbols: joined rows are the near pairs and no more."""
    words = ["unreason" + "".join("abcdefghij"[int(c)] for c in f"{i:04d}") for i in range(2000)]
    near = near_words(spark.createDataFrame([(w, 5) for w in words], "word string, n long"), 12).collect()
    expected = {(a, b) for i, a in enumerate(words) for b in words[i + 1:] if sum(x != y for x, y in zip(a, b)) == 1}
    assert {(r.word, r.other) for r in near} == expected and len(near) == len(expected)


def test_variants_bear_odd_rows(odd, none):
    assert spelling_variants(none).collect() == []
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted(map(tuple, spelling_variants(odd).collect()), key=lambda r: r[0]) == plain_variants(rows, None)


def test_variants_query(spark, documents):
    got = QUERIES["op13_spelling_variants"](spark, SF)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect())) == plain_variants(documents.select("doc_id", "text").collect())
    assert got.agg(F.count("form")).first()[0] > 0


def test_added_tokens_are_looked_for_once_a_batch():
    """New segments that hold none of the added tokens are not searched one by one; those that do are still told."""
    from stepforge.llm.queries import vocabulary
    from stepforge.llm.token_counts import Compiled

    class Counted(list):
        times = 0

        def __iter__(self):
            Counted.times += 1
            return super().__iter__()

    model = Compiled(vocabulary())
    model.added = Counted(model.added)
    rng = np.random.default_rng(4)
    words = ["".join(map(chr, rng.integers(97, 123, n))) for n in rng.integers(1, 12, 2000)]
    texts = [" ".join(words[i:i + 50]) for i in range(0, 2000, 50)] + ["café déjà vu. naïve, 中文!"]
    plain = lambda t: np.array(model.library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
    assert model.ids(texts) == [plain(t) for t in texts] and Counted.times < 10
    held = [f"some words{t} and {t} more" for t in list(model.added)] + ["other words"]
    assert model.ids(held) == [plain(t) for t in held]
