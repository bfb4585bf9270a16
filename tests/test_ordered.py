"""Blocked and iterative operators against plain walks over small random data."""

import math
import random

import pytest
from pyspark.sql import functions as F

from stepforge.operators import closure, spatial, state
from stepforge.operators.ordered import blocked_window
from stepforge.plans import battle, resample, steps

HOT = 0.5


def rows_for(spark, n, keys, seed):
    """Random rows in which one key holds about half of everything."""
    draw = random.Random(seed)
    rows = [(0 if draw.random() < HOT else draw.randrange(keys), i * 7 % 1009, i, draw.choice([None, 1.0, 2.5, 9.0]))
            for i in range(n)]
    return rows, spark.createDataFrame(rows, "k bigint, us bigint, event_id bigint, v double")


def test_blocked_window(spark):
    rows, df = rows_for(spark, 400, 5, 1)
    out = blocked_window(df, ["k"], ["us", "event_id"], F.floor(F.col("us") / 50), number="n", sums={"s": F.col("v")},
                         maxima={"hi": F.col("v")}, minima={"lo": F.col("v")}, lags={"was": F.col("v")},
                         leads={"next": F.col("v")}, last_known={"known": F.col("v")})
    got = {r.event_id: r for r in out.collect()}
    for key in {r[0] for r in rows}:
        ordered = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        for i, row in enumerate(ordered):
            seen = [r[3] for r in ordered[:i + 1] if r[3] is not None]
            g = got[row[2]]
            assert g.n == i
            assert g.s == (sum(seen) if seen else None)
            assert g.hi == (max(seen) if seen else None) and g.lo == (min(seen) if seen else None)
            assert g.known == (seen[-1] if seen else None)
            assert g.was == (ordered[i - 1][3] if i else None)
            assert g.next == (ordered[i + 1][3] if i + 1 < len(ordered) else None)


def greedy(scores):
    cuts, at, n = [], 0, len(scores)
    while at < n:
        if n - at <= 18:
            cuts.append((at, n - 1))
            break
        best = max(range(at + 10, at + 16), key=lambda p: (scores[p], -p))
        cuts.append((at, best - 1))
        at = best
    return cuts


def test_split_steps_over_many_blocks(spark):
    draw = random.Random(3)
    lengths = [1, 15, 18, 19, 29, 64, 65, 700, 1531]
    scores = {t: [draw.choice([-0.5, 0.2, 0.8, 1.0]) for _ in range(n)] for t, n in enumerate(lengths)}
    df = spark.createDataFrame([(t, i, s) for t, all_ in scores.items() for i, s in enumerate(all_)],
                               "traj_id bigint, seq bigint, score double")
    for size in (32, 4096):
        got = {}
        for r in steps.split_steps(df, size=size).collect():
            got.setdefault(r.traj_id, []).append((r.step_id, r.start, r.end))
        for t, all_ in scores.items():
            assert sorted(got[t]) == [(i, a, b) for i, (a, b) in enumerate(greedy(all_))]


@pytest.mark.parametrize("fold", [4, 1024])
def test_clamp_fold(spark, monkeypatch, fold):
    monkeypatch.setattr(state, "FOLD", fold)
    draw = random.Random(5)
    rows = [(draw.randrange(3), i, draw.uniform(0.2, 1.1), draw.uniform(-1, 1)) for i in range(300)]
    df = spark.createDataFrame(rows, "k bigint, at bigint, a double, b double")
    out = state.clamp_fold(df, ["k"], ["at"], 100, F.col("a"), F.col("b"), F.lit(0.0), F.lit(2.0), most=16)
    for r in out.collect():
        heat = 0.0
        for _, _, a, b in [x for x in rows if x[0] == r.k]:
            heat = min(2.0, max(0.0, a * heat + b))
        assert math.isclose(heat, r.value, abs_tol=1e-9)


@pytest.mark.parametrize("most", [8, 1 << 20])
def test_trailing_count(spark, most):
    rows, df = rows_for(spark, 300, 4, 7)
    seconds = df.withColumn("us", F.col("us") * 1_000_000)
    got = {r.event_id: r.recent for r in state.trailing_count(seconds, ["k"], 60, most=most).collect()}
    for key, us, event, _ in rows:
        assert got[event] == sum(1 for r in rows if r[0] == key and us - 60 <= r[1] <= us)


def test_accepted_issues(spark):
    draw = random.Random(11)
    events = sorted((draw.randrange(0, 400) * 1_000_000 + i, i, draw.randrange(2), draw.random() < 0.3) for i in range(300))
    schema = "us bigint, event_id bigint, unit bigint"
    issued = spark.createDataFrame([(t, i, u) for t, i, u, seen in events if not seen], schema)
    seen = spark.createDataFrame([(t, i, u) for t, i, u, s in events if s], schema).drop("event_id")
    rows = state.commits(issued, seen, ["unit"], 8.0)
    kept = state.accepted_issues(rows, ["unit"], ["us", "event_id"], F.floor(F.col("us") / 50_000_000), 8.0)
    got = sorted((r.unit, r.event_id, r.committed) for r in kept.collect())
    expected = []
    for unit in (0, 1):
        until = None
        for t, i, _, s in [e for e in events if e[2] == unit and not e[3]]:
            if until is None or t > until:
                hits = [e[0] for e in events if e[2] == unit and e[3] and t <= e[0] <= t + 8_000_000]
                committed = min(hits) if hits else None
                expected.append((unit, i, committed))
                until = committed if committed is not None else t + 8_000_000
    assert got == sorted(expected)


def test_eps_groups(spark):
    draw = random.Random(13)
    points = [(draw.uniform(0, 120), draw.uniform(0, 120)) for _ in range(220)] + [(5.0, 5.0)] * 50
    df = spark.createDataFrame(points, "x double, y double")
    got = {(r.x, r.y): r.group for r in spatial.eps_groups(df, 7.0).collect()}
    spots = sorted(set(points))
    parent = {p: p for p in spots}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a in spots:
        for b in spots:
            if (a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2 <= 49:
                parent[root(a)] = root(b)
    assert len(set(got.values())) == len({root(p) for p in spots})
    for a in spots:
        for b in spots:
            assert (got[a] == got[b]) == (root(a) == root(b))


def test_components_of_a_chain(spark):
    nodes = spark.range(1, 200).withColumnRenamed("id", "node")
    links = nodes.filter("node % 50 != 0").select(F.col("node").alias("a"), (F.col("node") + 1).alias("b"))
    links = links.filter("b < 200")
    sizes = sorted(r["count"] for r in closure.connected_components(nodes, links).groupBy("component").count().collect())
    assert sizes == [49, 50, 50, 50]


def test_closure_ends_on_a_mutual_pair(spark):
    pairs = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "c")], "entity string, implied string")
    got = {(r.entity, r.implied) for r in closure.implication_closure(pairs).collect()}
    assert got == {("a", "b"), ("a", "a"), ("a", "c"), ("b", "a"), ("b", "b"), ("b", "c")}


def test_geometric_median_of_a_cross(spark):
    points = [(0, 1.0, 0.0), (0, -1.0, 0.0), (0, 0.0, 1.0), (0, 0.0, -1.0), (1, 4.0, 4.0)]
    rows = spatial.geometric_median(spark.createDataFrame(points, "g int, x double, y double"), ["g"]).collect()
    assert {r.g: (round(r.x, 3), round(r.y, 3)) for r in rows} == {0: (0.0, 0.0), 1: (4.0, 4.0)}


def take_back(floats, total):
    units = {s: int(v) for s, v in floats.items()}
    while sum(units.values()) > total:
        step = min(units, key=lambda s: (units[s] - floats[s], s))
        if units[step] <= 1:
            break
        units[step] -= 1
    return units


def test_largest_remainder_takes_back(spark):
    floats = {1: 5.0, 2: 3.0, 3: 2.0, 4: 1.0}
    df = spark.createDataFrame(list(floats.items()), "step bigint, target double")
    for total in (6, 8, 10):
        got = {r.step: r.units for r in resample.largest_remainder(df, total).collect()}
        assert got == take_back(floats, total)


def test_largest_remainder_adds(spark):
    df = spark.createDataFrame([(1, 1.2), (2, 1.7), (3, 1.7)], "step bigint, target double")
    assert {r.step: r.units for r in resample.largest_remainder(df, 5).collect()} == {1: 1, 2: 2, 3: 2}
    assert {r.step: r.units for r in resample.largest_remainder(df, 9).collect()} == {1: 3, 2: 3, 3: 3}


def test_resample_invariants(spark):
    draw = random.Random(17)
    rows = [(i, draw.randrange(1, 8), f"s{draw.randrange(40)}", f"m{min(draw.randrange(30), draw.randrange(30))}") for i in range(900)]
    df = spark.createDataFrame(rows, "index bigint, step bigint, summary string, multiset string")
    targets = resample.largest_remainder(resample.step_targets(df, 200, 0.65), 200)
    kept = resample.multiset_resample(df, targets, 3).collect()
    assert {r.multiset for r in kept} == {r[3] for r in rows}
    assert len({r["index"] for r in kept}) == len(kept)
    assert len({(r.multiset, r.summary) for r in kept}) == len(kept)
    again = resample.multiset_resample(df.repartition(7), targets, 3).collect()
    assert sorted(r["index"] for r in again) == sorted(r["index"] for r in kept)


def test_army_buckets(spark):
    fields = battle.POWER_FIELDS
    struct = "struct<" + ",".join(f"{f}:double" for f in fields) + ">"

    def side(power):
        return tuple(power if f in ("power", "ground_power", "ground_presence") else 0.0 for f in fields)

    df = spark.createDataFrame([(i, side(a), side(b)) for i, (a, b) in enumerate(
        [(30.0, 9.0), (30.0, 29.0), (3.0, 2.0), (9.0, 30.0), (0.5, 0.1)])], f"i int, own {struct}, enemy {struct}")
    got = [r.b for r in df.select("i", battle.army_bucket().alias("b")).orderBy("i").collect()]
    assert got == ["OverwhelmingAdvantage", "Even", "SlightAdvantage", "OverwhelmingDisadvantage", "Even"]


def test_every_add_on_sticks(spark):
    """Hand-made order: the first action, an add-on of each kind, a first and a later boundary, a plain one."""
    from stepforge.functions.vocabulary import STICKY_ACTIONS

    add_ons = {f"BUILD_{kind}_{host}" for kind in ("TECHLAB", "REACTOR") for host in ("BARRACKS", "FACTORY", "STARPORT")}
    assert set(STICKY_ACTIONS) == add_ons


def test_a_burrowed_unit_is_a_ghost_until_searched(spark):
    from stepforge.operators.state import ghosts

    second = 1_000_000
    rows = [(tag, t * second, kind, False, burrowed, detected) for tag, burrowed, events in [
        (1, True, [(1, "seen", False), (10, "empty", True), (20, "empty", False)]),
        (2, True, [(1, "seen", False), (20, "empty", False)]),
        (3, False, [(1, "seen", False), (20, "empty", False)]),
        (4, True, [(1, "empty", True), (5, "seen", False)])] for t, kind, detected in events]
    frame = spark.createDataFrame(rows, "tag long, us long, kind string, flying boolean, burrowed boolean, detected boolean")
    assert {r.tag for r in ghosts(frame, ["tag"], 30 * second, 100, 100).collect()} == {2, 4}


def test_answers_read_numbers_like_int(spark):
    from pyspark.sql import functions as F

    from stepforge.functions.text import parse_items, parse_tags

    answers = ['{"items": [{"name": "A", "count": "2"}]}', '{"items": [{"name": "A", "count": 2.0}]}', '{"items": [{"name": "A", "count": 0}]}',
               '{"items": [{"name": "A", "count": 2}]} tail', '{"items": [{"name": "A", "count": "x"}]}']
    frame = spark.createDataFrame([(a,) for a in answers], "a string")
    assert [r[0] and r[0][0]["count"] for r in frame.select(parse_items(F.col("a"))).collect()] == [2, 2, None, None, None]
    tags = spark.createDataFrame([('["5"]',), ("[5.0]",), ("[5]",), ("7",), ("[1, 2]",), ("[5] x",)], "a string")
    assert [r[0] for r in tags.select(parse_tags(F.col("a"))).collect()] == [5, 5, 5, 7, None, None]
