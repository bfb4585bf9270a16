"""Document operators against brute force, on the smallest table and on odd rows."""

import hashlib
import math
import re
import time
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stepforge.llm import line_dedup, ppm, quality, simhash, substrings
from stepforge.llm.common import kept
from stepforge.llm.line_dedup import dedup_lines
from stepforge.llm.mixing import mix
from stepforge.llm.packing import closest, pack
from stepforge.llm.ppm import ppm_scores
from stepforge.llm.quality import quality_scores
from stepforge.llm.queries import QUERIES, vocabulary
from stepforge.llm.simhash import keep_first, near_links, simhash_components
from stepforge.llm.substrings import remove_repeats
from stepforge.llm.token_counts import compiled, token_counts
from stepforge.session import shared_folder

SF = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def words_of(text):
    return WORD.findall((text or "").encode())


def root_of(par, x):
    while par[x] != x:
        x = par[x]
    return x


def plain_print(text):
    words = words_of("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [b" ".join(words)] if words else []
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("name", ["documents", "odd", "none"])
def test_simhash(request, name):
    df = request.getfixturevalue(name)
    rows = rows_of(df)
    prints = [plain_print(t) for _, t in rows]
    par = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = root_of(par, i), root_of(par, j)
                par[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = root_of(par, i)
        least[r] = d if least.get(r) is None else least[r] if d is None else min(d, least[r])
    expected = Counter((d, f"{p:016x}", least[root_of(par, i)]) for i, ((d, _), p) in enumerate(zip(rows, prints)))
    assert Counter(map(tuple, simhash_components(df).collect())) == expected


def test_split_buckets_lose_no_link(spark):
    near = [(0x1234 << 48 | i * 2654435761 & 0xFFFFFFFF) for i in range(300)] + [1, 3, 7, 1 << 63 | 1]
    signed = [x - (1 << 64) if x >> 63 else x for x in near]
    links = near_links(spark.createDataFrame([(x,) for x in signed], "fp long").distinct(), bucket_rows=16).collect()
    par = {x: x for x in signed}
    for r in links:
        a, b = root_of(par, r.a), root_of(par, r.b)
        par[max(a, b)] = min(a, b)
    for x in signed:
        for y in signed:
            if ((x ^ y) & (1 << 64) - 1).bit_count() <= 3:
                assert root_of(par, x) == root_of(par, y)


def test_ring_finds_every_near_pair():
    rng = np.random.default_rng(1)
    for segments, distance in ((4, 3), (8, 3), (8, 7)):
        ring = simhash.Ring(segments, distance)
        a = rng.integers(0, 1 << 63, 500).astype(np.uint64)
        b = a.copy()
        for i in range(500):
            for bit in rng.choice(64, rng.integers(0, distance + 1), replace=False):
                b[i] ^= np.uint64(1 << int(bit))
        found = set()
        for s in range(segments):
            width = np.uint64(64 // segments)
            same = np.flatnonzero((a ^ b) >> np.uint64(s) * width & np.uint64((1 << 64 // segments) - 1) == 0)
            found |= set(same[ring.near(a[same], b[same], np.full(len(same), s))].tolist())
        assert found == set(range(500))


def test_keep_first(odd):
    kept = keep_first(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(
        r.doc_id for r in simhash_components(odd, words=5).filter("doc_id = component_id").collect())


@pytest.mark.parametrize("name", ["documents", "odd", "none"])
def test_token_counts_and_packing(request, name):
    df, model = request.getfixturevalue(name), compiled(vocabulary())
    rows = rows_of(df)
    ids = [model.library.encode(t or "", add_special_tokens=False).ids for _, t in rows]
    expected = Counter((d, len((t or "").encode()), len(i), len(i) > 1024) for (d, t), i in zip(rows, ids))
    assert Counter(map(tuple, token_counts(df, vocabulary()).collect())) == expected
    pieces = pack(df, vocabulary()).collect()
    whole, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length > 0
        whole[p.doc_id, p.doc_tokens].append((p.start, bytes(p.ids)))
        sequences[p.sequence_id].append((p.offset, p.length))
    packed = sum(len(b) for v in whole.values() for _, b in v)
    assert packed == 4 * sum(len(i) + 1 for i in ids)
    for (d, _), i in zip(rows, ids):
        if sum(1 for e, _ in rows if e == d) == 1:
            assert b"".join(b for _, b in sorted(whole[d, len(i) + 1])) == np.array([*i, 0], "<u4").tobytes()
    padding = 0
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
        padding += 1024 - end if end & (end - 1) else 0
    assert padding == 0


def test_chunks_compose():
    model = compiled(vocabulary())
    for text in ("a b  c \n d' ll it'sé <|endoftext|> x" * 9, "x" * 100, " " * 40, "ab cd"):
        for chunk in (1, 3, 7, 50):
            assert model.counts([text], chunk) == [len(model.library.encode(text, add_special_tokens=False).ids)]


def test_closest_is_the_best_subset_sum():
    rng = np.random.default_rng(3)
    for _ in range(200):
        counts = Counter(rng.integers(1, 40, rng.integers(0, 8)).tolist())
        room = int(rng.integers(0, 90))
        sums = {0}
        for x in counts.elements():
            sums |= {s + x for s in sums if s + x <= room}
        taken = closest(dict(counts), room)
        assert sum(k * n for k, n in taken.items()) == max(sums)
        assert all(n <= counts[k] for k, n in taken.items())


@pytest.mark.parametrize("name", ["documents", "odd", "none"])
def test_substrings(request, name):
    df = request.getfixturevalue(name)
    rows = [(d, words_of(t)) for d, t in rows_of(df)]
    key = lambda d: math.inf if d is None else d
    first = {}
    for d, w in rows:
        for i in range(len(w) - 12):
            at = tuple(w[i:i + 13])
            first[at] = min(first.get(at, math.inf), key(d))
    expected = Counter()
    for d, w in rows:
        gone = {k for i in range(len(w) - 12) if first[tuple(w[i:i + 13])] < key(d) for k in range(i, i + 13)}
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        expected[d, len(w), len(gone), hashlib.sha256(kept).hexdigest()] += 1
    got = remove_repeats(df, cell_bits=22).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))
    assert Counter(map(tuple, got.collect())) == expected


@pytest.mark.parametrize("name", ["documents", "odd", "none"])
def test_lines(request, name):
    df = request.getfixturevalue(name)
    rows = list(dict.fromkeys(rows_of(df)))
    place, lines = lambda d: (d is None, d or 0), {}
    for d, t in rows:
        for i, line in enumerate((t or "").split("\n")):
            if line.strip():
                lines.setdefault(line, []).append((place(d), xxhash.xxh64_intdigest((t or "").encode(), 42) - 0, i))
    text = list(lines)
    sets = [{x[k:k + 5] for k in range(len(x) - 4)} or {x} for x in text]
    par = list(range(len(text)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and len(a & b) >= 0.8 * len(a | b):
                x, y = root_of(par, i), root_of(par, j)
                par[max(x, y)] = min(x, y)
    classes = len({root_of(par, i) for i in range(len(text))})
    out = dedup_lines(df)
    assert out.columns == [*df.columns, "n_lines", "n_removed"]
    got = out.select("doc_id", "text", "n_lines", "n_removed").collect()
    assert len(got) == df.count()
    distinct = {(r.doc_id, r.text): r for r in got}
    left = sum(1 for r in distinct.values() for x in (r.text or "").split("\n") if x.strip())
    # MinHash may miss a pair; a line too many is such a pair, one too few would be a wrong link.
    assert classes <= left <= classes + math.ceil(0.01 * classes)


def test_near_equal_lines_keep_the_first(spark):
    line = "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf of the woods today"
    df = spark.createDataFrame([(2, line + "\nother things"), (1, line.replace("lazy", "hazy")), (3, line.upper())], "doc_id long, text string")
    assert {r.doc_id: r.text for r in dedup_lines(df).collect()} == {
        2: "other things", 1: line.replace("lazy", "hazy"), 3: line.upper()}


def test_mixing(documents, odd, none):
    got = mix(documents, repeats=2.0).groupBy("source").agg(
        F.sum("n_tokens").alias("t"), F.sum(F.col("n_tokens") * F.col("copies")).alias("taken"), F.max("weight").alias("w"),
        F.max("n_tokens").alias("most"), F.min("copies").alias("least")).collect()
    total = sum(r.t for r in got)
    size = max(r.t / r.w for r in got)
    assert abs(sum(r.w for r in got) - 1) < 1e-9
    for r in got:
        assert r.least >= 1
        assert r.w * size / r.t <= 2.0 + 1e-6
        # Blocks are taken while they fit: at most one document of room stays.
        assert -1e-6 <= r.w * size - r.taken <= r.most + 1e-6
    assert total > 0
    flat = mix(documents, entropy=0.999, repeats=None).groupBy("source").agg(F.max("weight").alias("w")).collect()
    assert -sum(r.w * math.log(r.w) for r in flat) >= 0.999 * math.log(len(flat)) - 1e-9
    assert mix(odd).count() == odd.count() and mix(none).count() == 0
    assert mix(odd).filter("copies < 1").count() == 0


def test_mixing_weights_and_quotas(documents):
    """Weights by a closed form for repeats and by plain bisection for entropy; copies fill the quota of every source."""
    tokens = Counter()
    for r in documents.select("source", "text").collect():
        tokens[r.source] += len(words_of(r.text))
    whole = sum(tokens.values())
    p = {s: n / whole for s, n in tokens.items()}

    def weights(power):
        z = sum(x ** power for x in p.values())
        return {s: x ** power / z for s, x in p.items()}

    power = max(0.0, 1 - math.log(1.5) / math.log(max(p.values()) / min(p.values())))
    entropy = lambda w: -sum(x * math.log(x) for x in w.values())
    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if entropy(weights(middle)) >= 0.995 * math.log(len(p)) else (low, middle)
    for found, expected in ((mix(documents, repeats=1.5), weights(power)), (mix(documents, entropy=0.995, repeats=None), weights(low))):
        rows = found.select("source", "n_tokens", "weight", "copies").collect()
        assert all(abs(r.weight - expected[r.source]) < 1e-5 for r in rows)
        budget = max(tokens[s] / w for s, w in expected.items())
        for s, w in expected.items():
            own = [r for r in rows if r.source == s]
            taken, quota = sum(r.n_tokens * r.copies for r in own), w * budget
            passes = int(quota / tokens[s] + 1e-4)
            assert {r.copies for r in own} <= {passes, passes + 1}
            assert quota - max(r.n_tokens for r in own) - 1e-3 * quota <= taken <= quota * (1 + 1e-4)


def test_quality_scores_equal_plain_discriminant(spark):
    """The query's scores from class covariances and determinants written out, over the same statistics of the texts."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("doc_id % 3 = 0")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    known = {r.doc_id: r.quality for r in labels.collect()}
    rows = rows_of(df)
    x = np.array([quality.statistics((t or "").encode()) for _, t in rows], float)
    learn = [i for i, (d, _) in enumerate(rows) if zlib.crc32(str(d).encode()) % 4 != 2 and known.get(d) in (0, 1)]
    y = np.array([known[rows[i][0]] for i in learn])
    classes = [x[learn][y == k] for k in range(2)]
    common = sum((c - c.mean(0)).T @ (c - c.mean(0)) for c in classes) / len(learn)
    scale = np.sqrt(np.maximum(np.diag(common), 1e-9))
    logs = []
    for c in classes:
        cov = (0.25 * np.cov(c.T, bias=True) + 0.75 * common) / np.outer(scale, scale)
        cov = 0.98 * cov + (0.02 * np.trace(cov) / len(cov) + 1e-9) * np.eye(len(cov))
        z = (x - c.mean(0)) / scale
        logs.append(np.log(len(c) / len(learn)) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,ij->i", z, np.linalg.solve(cov, z.T).T))
    expected = {d: 1 / (1 + math.exp(min(700, max(-700, a - b)))) for (d, _), a, b in zip(rows, *logs)}
    got = quality_scores(df, labels).select("doc_id", "score").collect()
    assert len(got) == len(rows) and all(abs(r.score - expected[r.doc_id]) < 1e-6 for r in got)


def test_quality(spark, documents, odd, none):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    known = {r.doc_id: r.quality for r in labels.collect()}
    scored = quality_scores(df, labels).select("doc_id", "held_out", "score", "predicted").collect()
    held = [r for r in scored if r.held_out and r.doc_id in known]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in scored)
    assert sum(r.predicted == known[r.doc_id] for r in held) >= 0.95 * len(held)
    out = quality_scores(odd, labels)
    assert set(odd.columns) <= set(out.columns) and out.count() == odd.count() and out.filter("score is null").count() == 0
    assert quality_scores(none, labels).count() == 0
    assert quality_scores(odd, labels.filter("false")).select("score").distinct().count() == 1
    wild = labels.unionByName(spark.createDataFrame([(None, 1, 0), (1, None, 0), (2, 5, None)], labels.schema))
    assert quality_scores(odd, wild).count() == odd.count()


@pytest.mark.parametrize("name", ["documents", "odd", "none"])
def test_base_scores(request, name):
    df = request.getfixturevalue(name)
    rows = [(d, [*words_of((t or "").encode().lower().decode()), b""]) for d, t in rows_of(df)]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 10 == 0
    counts = Counter(w for d, words in rows if not held(d) for w in words)
    n, v = sum(counts.values()), len(counts)
    expected = sorted((d is None, d or 0, held(d), len(w), sum(counts[x] > 0 for x in w), n,
                       round(sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), 5)) for d, w in rows)
    got = ppm_scores(df, frequent=50).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == expected
    assert all(r.score < 0 for r in got)


def plain_trie(grams, order):
    """The counts of every level, and a walk that gives a gram's code length, from counts of the longest grams."""
    levels = {order: grams}
    for k in range(order - 1, -1, -1):
        levels[k] = Counter(g & (1 << 8 * (k + 1)) - 1 for g in levels[k + 1])
    symbols = defaultdict(dict)
    for k, counts in levels.items():
        for g, n in counts.items():
            symbols[k, g >> 8][g & 255] = n

    def walk(gram):
        out, gone = 0.0, set()
        for k in range(order, -1, -1):
            own = symbols.get((k, gram >> 8 & (1 << 8 * k) - 1))
            if not own:
                continue
            escape = max(0.5 * len(own) - 0.5 * len(gone), 0.25) if gone else 0.5 * len(own)
            whole = sum(n - 0.5 for s, n in own.items() if s not in gone) + escape
            if gram & 255 in own:
                return out + math.log10((own[gram & 255] - 0.5) / whole)
            out, gone = out + math.log10(escape / whole), set(own)
        return out - math.log10(256 - len(gone))

    return walk


def plain_grams(text, order):
    data = ppm.END * order + b" ".join(ppm.normal(text)) + ppm.END
    return [sum(data[i - j] << 8 * j for j in range(order + 1)) for i in range(order, len(data))]


@pytest.mark.parametrize("order", [0, 1, 2, 5])
def test_ppm_codes_match_a_plain_walk_and_are_a_distribution(spark, order):
    grams = Counter(g for t in (b"abab abc", b"abcab", b"zz top", b"a topic") for g in plain_grams(t, order))
    contexts = [g >> 8 for g in grams] + [0x6162636465 & (1 << 8 * order) - 1, 0x7171717171 & (1 << 8 * order) - 1]
    asked = {c << 8 | s for c in contexts for s in range(256)} - set(grams)
    frame = spark.createDataFrame([*grams.items(), *((g, 0) for g in asked)], "gram long, n long")
    codes = {r.gram: r.code for r in ppm.coded(frame, order).collect()}
    walk = plain_trie(grams, order)
    assert len(codes) == len(grams) + len(asked) and all(abs(walk(g) - c) < 1e-9 for g, c in codes.items())
    for c in contexts:
        assert abs(sum(10 ** codes[c << 8 | s] for s in range(256)) - 1) < 1e-9


@pytest.mark.parametrize("name", ["documents", "odd", "none"])
def test_ppm_scores_whatever_is_sent(request, name):
    """Whole queries against a plain trie over all training texts; what is sent to the tasks changes nothing."""
    df = request.getfixturevalue(name)
    if name == "documents":
        df = df.filter("n_chars < 4000")
    rows = rows_of(df)
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 10 == 0
    walk = plain_trie(Counter(g for d, t in rows if not held(d) for g in plain_grams((t or "").encode(), 5)), 5)
    known = {}
    code = lambda g: known[g] if g in known else known.setdefault(g, walk(g))
    expected = sorted((d is None, d or 0, round(sum(code(g) for g in plain_grams((t or "").encode(), 5)), 4)) for d, t in rows)
    for entries in (3_000_000, 1000, 0):
        got = ppm_scores(df, entries=entries).collect()
        found = sorted((r.doc_id is None, r.doc_id or 0, r.score) for r in got)
        assert [x[:2] for x in found] == [x[:2] for x in expected]
        assert np.allclose([x[2] for x in found], [x[2] for x in expected], atol=1e-3)


def test_every_query_runs_over_its_table(spark, documents):
    n = documents.count()
    for name in ("op1_simhash", "op3_token_counts", "op4_line_dedup", "op7_substrings", "op8_mixing", "op9_quality", "op10_ppm"):
        assert QUERIES[name](spark, SF).count() == n, name


def test_keep_first_finds_pairs_of_eight_tenths(spark):
    rng = np.random.default_rng(5)
    rows, pairs = [], []
    for wanted in (0.80, 0.85, 0.90, 0.95):
        for n in (30, 120, 600):
            for _ in range(25):
                words = [f"w{x}" for x in rng.integers(0, 1 << 40, n)]
                # Shingles at the end change with the last words alone, so the similarity is the one wanted or just above.
                changed = int((n - 4) * (1 - wanted) / (1 + wanted))
                other = words[:n - changed] + [f"v{x}" for x in rng.integers(0, 1 << 40, changed)]
                pairs.append((len(rows), len(rows) + 1))
                rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(other))]
    # Below it pairs must stay: three quarters of the shingles in common.
    for _ in range(25):
        words = [f"w{x}" for x in rng.integers(0, 1 << 40, 304)]
        rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(words[:260] + [f"v{x}" for x in rng.integers(0, 1 << 40, 44)]))]
    sets = [{tuple(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)} for _, t in rows]
    alike = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    assert all(alike(a, b) for a, b in pairs) and not any(alike(i, i + 1) for i in range(600, 650, 2))
    kept = {r.doc_id for r in keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {a for a, _ in pairs} | set(range(600, 650)) <= kept
    assert sum(b in kept for _, b in pairs) <= 0.01 * len(pairs)


def test_keep_first_splits_groups_and_links_chains(spark):
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([f"x{j}" for j in range(i)] + words[i:])) for i in range(0, 200, 4)] + [(900, None), (901, " "), (902, "ab cd")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    scratch = simhash.Scratch(spark)
    found = [simhash.similar_links(df, "doc_id", "text", 5, 0.8, scratch, *sizes)[1] for sizes in ((4096, 1 << 20), (4, 500))]
    whole, cut = ({r.node: r.root for r in simhash.components(spark, x).collect()} for x in found)
    assert whole == cut and len(whole) == 50 and len(set(whole.values())) == 1
    assert sorted(r.doc_id for r in keep_first(df).collect()) == [0, 900, 902]


def test_lines_of_repeats_meet_whatever_their_lengths(spark):
    word = [f"k{i}" for i in range(40)]
    lines = ["-" * 20, "-" * 40, "=" * 7, "=" * 90, "ha " * 5 + "ha", "ha " * 30 + "ha", "+---" * 6, "+---" * 21,
             " ".join(["buy now"] * 70 + word), " ".join(["buy now"] * 100 + word)]
    left = [x for r in dedup_lines(spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")).collect()
            for x in r.text.split("\n") if x.strip()]
    assert sorted(left) == sorted(lines[::2])


def test_near_lines_of_one_template_all_meet(spark):
    rng = np.random.default_rng(2)
    common, rows = [f"c{x}" for x in rng.integers(0, 10**6, 40)], []
    for _ in range(250):
        line = [f"own{x}" if own else c for c, own, x in zip(common, rng.random(40) < 0.3, rng.integers(0, 10**6, 40))]
        copy = list(line)
        copy[-1] = f"end{rng.integers(0, 10**6)}"
        rows += [" ".join(line), " ".join(copy)]
    sets = [{x[i:i + 5] for i in range(len(x) - 4)} for x in rows]
    alike = lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
    par = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if alike(i, j):
                a, b = root_of(par, i), root_of(par, j)
                par[max(a, b)] = min(a, b)
    classes = len({root_of(par, i) for i in range(len(rows))})
    assert classes >= 200
    got = dedup_lines(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).filter("n_removed = 0").count()
    assert classes <= got <= classes + 2


def test_near_duplicates_meet_by_viable_chains(spark):
    """Candidates of the stage have an equal segment, a viable chain from it on its fingerprint's ring, and near first fingerprints."""
    rng = np.random.default_rng(8)
    distance, limit, rows, wanted = simhash.candidate_distance(0.8, 64), simhash.candidate_distance(0.8), [], set()

    def flip(bits, places):
        return bits ^ sum(1 << int(p) for p in places)

    for k in range(300):
        one = [int(x) for x in rng.integers(0, 1 << 64, simhash.PRINTS, dtype=np.uint64)]
        # One bit of every segment differs, so that no segment is equal but the one cleared below.
        two = [flip(x, range(0, 64, 16)) for x in one]
        i, s = int(rng.integers(simhash.CHECKED, simhash.PRINTS)), int(rng.integers(0, 4))
        after = [int(n) for n in rng.integers(1, 17, 3)]
        two[i] = flip(one[i], [16 * ((s + 1 + j) % 4) + p for j, n in enumerate(after) for p in range(n)])
        if k % 5 == 0:
            two[0] = flip(two[0], rng.choice(np.arange(64), limit, replace=False))
        far = sum((a ^ b).bit_count() for a, b in zip(one[:simhash.CHECKED], two)) > limit
        if not far and all(sum(after[:n]) <= (n + 1) * distance // 4 for n in (1, 2, 3)):
            wanted.add((2 * k, 2 * k + 1))
        rows += [(2 * k, one), (2 * k + 1, two)]
    assert 20 < len(wanted) < 280
    signed = [(n, np.array(p, np.uint64).view(np.int64).tolist()) for n, p in rows]
    found = simhash.chain_candidates(spark.createDataFrame(signed, "node long, prints array<long>"), 0.8)
    assert {(min(r.a, r.b), max(r.a, r.b)) for r in found.collect()} == wanted


def test_lines_that_share_a_passage_are_put_aside_before_they_are_verified(spark, monkeypatch):
    """Lines of one passage meet in crowded buckets; only pairs that may reach the similarity have their texts compared."""
    rng = np.random.default_rng(5)
    words = lambda n: [f"w{x}" for x in rng.integers(0, 10**6, n)]
    passage, asked = words(40), []
    rows = [" ".join([*words(8), *passage, *words(8)]) for _ in range(60)]
    whole = line_dedup.verified

    def counted(texts, pairs, similarity, scratch):
        asked.append(pairs.count())
        return whole(texts, pairs, similarity, scratch)

    monkeypatch.setattr(line_dedup, "verified", counted)
    rows.append(rows[0] + " more")
    got = dedup_lines(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).filter("n_removed > 0").collect()
    assert [r.doc_id for r in got] == [60]
    assert 1 <= sum(asked) <= 60


def test_lines_of_several_crowded_buckets_are_compared_once(spark):
    """A pair is made in one of the buckets it shares, whatever the chunks of each, and a pair of one root in none."""
    buckets = {7: range(9), -3: range(2, 9), 5: range(0, 12, 2), 9: range(20, 24)}
    members = spark.createDataFrame([(k, i) for k, ids in buckets.items() for i in ids], "key long, id long")
    signed = spark.createDataFrame([(i, 40, list(range(40))) for i in range(24)], "id long, size int, five array<int>")
    roots = spark.createDataFrame([(2, 0), (0, 0), *[(i, 20) for i in range(20, 24)]], "node long, root long")
    wanted = {(a, b) for ids in buckets.values() for a in ids for b in ids if a < b < 20} - {(0, 2)}
    for lines in (2, 256):
        got = line_dedup.crowded_pairs(members, signed, roots, 0.8, lines, line_dedup.Scratch(spark)).collect()
        assert Counter(map(tuple, got)) == Counter(wanted)


def test_shuffle_files_of_a_written_table_go(spark):
    """Steps that exchange rows leave the tables they write and no shuffle files, also when the driver collects no garbage."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {f.getPath() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(disk.getAllFiles()) if "shuffle_" in f.getName()}
    setting, before, scratch = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", shuffled(), line_dedup.Scratch(spark)
    parts = [spark.range(5000).filter(f"id % 2 = {k}").groupBy((F.col("id") % 100).alias("k")).count() for k in (0, 1)]
    spark.conf.set(setting, "false")
    try:
        out = scratch.cut(*parts)
        assert spark.conf.get(setting) == "false"
    finally:
        spark.conf.unset(setting)
    deadline = time.time() + 20
    while (left := shuffled() - before) and time.time() < deadline:
        time.sleep(0.2)
    assert not left
    assert sorted(map(tuple, out.collect())) == [(k, 50) for k in range(100)]


def test_lines_are_the_same_in_parts_and_their_tables_go(spark, monkeypatch):
    """Large joins written part after part give what one part gives, with null ids and repeated rows; tables that no step reads any more go."""
    rng = np.random.default_rng(3)
    words = lambda n: [f"w{x}" for x in rng.integers(0, 10**6, n)]
    passage, line = words(40), words(30)
    near = lambda i: " ".join([*line[:i % 30], f"x{i}", *line[i % 30 + 1:]])
    texts = ["\n".join([" ".join([*words(8), *passage, *words(8)]), near(i), f"short {i % 5}"]) for i in range(40)]
    rows = [(None if i % 7 == 0 else i, t) for i, t in enumerate(texts)] + [(None, texts[1]), (2, texts[2]), (2, texts[2]), (0, texts[3])]
    df, found, left = spark.createDataFrame(rows, "doc_id long, text string"), [], []
    folder = Path(shared_folder(spark).removeprefix("file:"))
    monkeypatch.setattr(line_dedup, "PARTS", 2)
    for size in (1 << 28, 1):
        monkeypatch.setattr(line_dedup, "PART_BYTES", size)
        before = set(folder.glob("cut-*"))
        found.append(Counter(map(tuple, dedup_lines(df).collect())))
        left.append(len(set(folder.glob("cut-*")) - before))
    assert found[0] == found[1] and sum(r[3] * n for r, n in found[0].items()) > 70
    assert max(left) <= 3  # the lines to be removed, and two tables of components


def test_three_lines_of_one_bucket_meet_in_all_pairs(spark):
    line = " ".join(f"word{i}" for i in range(30))
    rows = [line.replace("word7 ", "other7 "), line, line.replace("word21 ", "other21 "), "something else"]
    got = dedup_lines(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).filter("n_removed = 0").collect()
    assert sorted(r.doc_id for r in got) == [0, 3]


def test_a_worker_keeps_what_one_operator_needs():
    kept("one")["vocabulary"] = 1
    assert kept("one") == {"vocabulary": 1}
    assert kept("two") == {} and kept("one") == {}


def test_windows_are_marked_by_their_grams():
    """Equal windows have equal marks wherever they stand, and neighbours share most of theirs."""
    rng = np.random.default_rng(4)
    words = lambda n: [b"w%d" % x for x in rng.integers(0, 10**6, n)]
    passage = words(13)
    for before in (0, 1, 9):
        assert substrings.window_marks(words(before) + passage + words(5), 13)[before] == substrings.window_marks(passage, 13)[0]
    text = words(4000)
    assert len(substrings.window_marks(text, 13)) == 3988 and len(substrings.window_marks(text[:12], 13)) == 0
    assert substrings.distinct_marks(text, 13).shape[1] < 0.3 * 3988


def test_repeats_are_removed_when_the_sketch_is_full(spark):
    """A full sketch tells nothing, so marks are grouped; windows of one document alone are still not grouped."""
    rng = np.random.default_rng(6)
    words = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 10**6, n))
    passage = words(13)
    rows = [(i, " ".join([words(3000), passage, words(3000)])) for i in range(40)]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), cell_bits=22).collect()
    assert {r.doc_id: r.n_removed for r in got} == {i: 13 if i else 0 for i in range(40)}
