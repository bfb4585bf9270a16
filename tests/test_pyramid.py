"""Range and nearest joins on a pyramid of cells against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from stepforge.operators import pyramid, spatial

SCHEMA = "tag long, x double, y double, type string"


def crowd(seed, n=600):
    """Points spread thinly, crowded in one place, repeated on one spot, and far away on their own."""
    draw = random.Random(seed)
    spots = [(draw.uniform(-90, 90), draw.uniform(-90, 90)) for _ in range(n // 2)]
    spots += [(20 + draw.random(), 30 + draw.random()) for _ in range(n // 3)] + [(5.0, 5.0)] * (n // 6) + [(4000.0, -3000.0)]
    return [(i, x, y, "ab"[i % 7 == 0]) for i, (x, y) in enumerate(spots)]


def d2(a, b):
    return (a[0] - b[0]) * (a[0] - b[0]) + (a[1] - b[1]) * (a[1] - b[1])


@pytest.mark.parametrize("leaf", [2, 64])
def test_range_counts(spark, monkeypatch, leaf):
    monkeypatch.setattr(spatial, "build", lambda *a, **k: pyramid.build(*a, **k, leaf=leaf))
    points = crowd(1)
    centres = [(0, 0.0, 0.0), (1, 20.5, 30.5), (2, 5.0, 5.0), (3, 500.0, 500.0), (4, 4000.0, -3000.0), (5, -60.0, 45.0)]
    got = spatial.range_counts(spark.createDataFrame(points, SCHEMA), spark.createDataFrame(centres, "zone long, cx double, cy double"), ["zone"], 25.0, 5.0)
    found = {r.zone: (r.closer, r.in_ball, r.between) for r in got.collect()}
    for zone, cx, cy in centres:
        d = [d2((x, y), (cx, cy)) for _, x, y, _ in points]
        assert found[zone] == (sum(v < 625 for v in d), sum(v <= 625 for v in d), sum(25 < v < 625 for v in d))


def test_crowds_in_range_are_summed_not_joined(spark):
    """160,000 positions, of which 50 centres have 45,000 each in range: the border's positions alone are compared."""
    points = spark.range(160_000).select(F.col("id").alias("tag"), (F.col("id") % 400 / 20).alias("x"), (F.floor(F.col("id") / 400) / 20).alias("y"))
    centres = spark.range(50).select(F.col("id").alias("zone"), (8 + F.col("id") / 25).alias("cx"), F.lit(10.0).alias("cy"))
    tree = pyramid.build(points, 6.0, {"n": F.lit(1)}, leaf=16)
    seen = []
    kept = pyramid.cut_lineage
    try:
        pyramid.cut_lineage = lambda df: seen.append(kept(df)) or seen[-1]
        out = pyramid.range_sums(tree, centres, ["zone"], {"n": ("n", pyramid.Between(high=36.0))}).collect()
    finally:
        pyramid.cut_lineage = kept
    pairs = sum(df.count() for df in seen)
    border = seen[-1].filter("not open and _low < 36 and _high >= 36").join(tree.leaves.filter(F.col("level") == len(tree.levels) - 1), ["gx", "gy"]).count()
    inside = sum(r.n for r in out)
    assert inside > 2_000_000 and pairs + border < inside / 4
    where = {(i % 400 / 20, i // 400 / 20) for i in range(160_000)}
    for r in out[:3]:
        assert r.n == sum(d2(p, (8 + r.zone / 25, 10.0)) < 36 for p in where)


@pytest.mark.parametrize("leaf", [2, 64])
def test_nearest(spark, leaf):
    points = crowd(2)
    centres = [(0, 0.0, 0.0, "a"), (1, 20.5, 30.5, "a"), (2, 5.0, 5.0, "b"), (3, 500.0, 500.0, "a"), (4, 4000.0, -3000.0, "b"), (5, -9999.0, 45.0, "a"),
               (6, 1.0, 1.0, "c")]
    for k, on in ((1, []), (7, []), (7, ["type"]), (2000, ["type"])):
        rows = spark.createDataFrame(points, SCHEMA)
        asked = spark.createDataFrame(centres, "zone long, cx double, cy double, type string").select("zone", "cx", "cy", *on)
        got = {}
        for r in pyramid.nearest(rows, asked, ["zone"], k, "tag", on, leaf).collect():
            got.setdefault(r.zone, []).append((r.rank, r.tag, r.d2))
        for zone, cx, cy, kind in centres:
            near = sorted((d2((x, y), (cx, cy)), tag) for tag, x, y, t in points if not on or t == kind)[:k]
            assert sorted(got.get(zone, [])) == [(i + 1, tag, d) for i, (d, tag) in enumerate(near)]


def test_centres_on_one_position_are_searched_once(spark, monkeypatch):
    """The search sees positions, however many centres stand on them; every centre gets the points."""
    rows = spark.createDataFrame([(i, float(i % 7), float(i // 7)) for i in range(49)], "tag long, x double, y double")
    asked = spark.range(400).select(F.col("id").alias("zone"), (F.col("id") % 2).cast("double").alias("cx"), F.lit(3.0).alias("cy"))
    seen, cut = [], pyramid.cut_lineage

    def counted(df):
        out = cut(df)
        if "_bound" not in df.columns and "cx" in df.columns:
            seen.append(out.select("cx", "cy").distinct().count() * 49 >= out.count())
        return out

    monkeypatch.setattr(pyramid, "cut_lineage", counted)
    found = pyramid.nearest(rows, asked, ["zone"], 3, "tag").collect()
    assert seen and all(seen)
    by = {}
    for r in found:
        by.setdefault(r.zone, []).append((r["rank"], r.tag, r.d2))
    assert len(by) == 400
    for zone, got in by.items():
        plain = sorted(((i % 7 - zone % 2) ** 2 + (i // 7 - 3) ** 2, i) for i in range(49))[:3]
        assert sorted(got) == [(n, i, float(d)) for n, (d, i) in enumerate(plain, 1)]


def test_nearest_of_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    asked = spark.createDataFrame([(0, 0.0, 0.0)], "zone long, cx double, cy double")
    assert pyramid.nearest(none, asked, ["zone"], 3, "tag").collect() == []


def test_without_match(spark):
    started, orders = crowd(3), [(i, x + 0.3, y, t) for i, x, y, t in crowd(4)[::5] + crowd(3)[::9]]
    left = spatial.without_match(spark.createDataFrame(orders, SCHEMA), spark.createDataFrame(started, SCHEMA), 1.0)
    expected = [o[0] for o in orders if not any(s[3] == o[3] and d2(s[1:3], o[1:3]) < 1 for s in started)]
    assert sorted(r.tag for r in left.collect()) == sorted(expected)


def test_danger(spark):
    draw = random.Random(9)
    enemies = [(draw.uniform(0, 60), draw.uniform(0, 60), draw.choice([0.5, 1.0, 3.0, 7.5, 12.0]), draw.uniform(1, 9), draw.random() < 0.5) for _ in range(300)]
    points = [(i, draw.uniform(0, 60), draw.uniform(0, 60)) for i in range(12)]
    got = spatial.danger(spark.createDataFrame(points, "point long, cx double, cy double"),
                         spark.createDataFrame(enemies, "x double, y double, range double, dps double, slower boolean"), 12.0)
    found = {r.point: r.danger for r in got.collect()}
    for point, cx, cy in points:
        total = 0.0
        for x, y, reach, dps, slower in enemies:
            share = d2((x, y), (cx, cy)) ** 0.5 / reach
            if reach >= 1:
                total += dps + (1 - share) * dps if share < 1 else max(0.0, ((1.5 if slower else 2.0) - share) * dps)
        assert abs(found[point] - total) < 1e-6


def test_merge_groups(spark):
    """Chains longer than the reach, spots that repeat, levels that keep groups apart, against a plain loop of the same rounds."""
    draw = random.Random(12)
    rows = [(i, 4.0 * i, 0.0, 0) for i in range(12)] + [(100 + i, draw.uniform(0, 60), draw.uniform(20, 50), draw.choice([0, 8, 16])) for i in range(20)]
    rows += [(200 + i, 8.0, 0.0, 0) for i in range(5)]
    groups = {}
    for i, x, y, h in rows:
        n, sx, sy, low, high, least = groups.get((x, y, h), (0, 0.0, 0.0, h, h, i))
        groups[x, y, h] = (n + 1, sx + x, sy + y, low, high, min(least, i))
    groups = {g[5]: g[:5] for g in groups.values()}
    while True:
        near = {}
        for a, (n, sx, sy, low, high) in groups.items():
            found = [(d2((sx / n, sy / n), (tx / m, ty / m)), b) for b, (m, tx, ty, lo, hi) in groups.items() if b != a and max(high, hi) - min(low, lo) <= 10]
            found = [f for f in found if f[0] <= 110.25]
            if found:
                near[a] = min(found)[1]
        pairs = [(a, b) for a, b in near.items() if near.get(b) == a and a < b]
        if not pairs:
            break
        for a, b in pairs:
            (n, sx, sy, low, high), (m, tx, ty, lo, hi) = groups[a], groups.pop(b)
            groups[a] = (n + m, sx + tx, sy + ty, min(low, lo), max(high, hi))
    got = spatial.merge_groups(spark.createDataFrame(rows, "id long, x double, y double, height int"), 10.5)
    assert sorted((r.group, r.n, round(r.x, 6), round(r.y, 6)) for r in got.collect()) == sorted(
        (a, n, round(sx / n, 6), round(sy / n, 6)) for a, (n, sx, sy, _, _) in groups.items())
    assert 1 < sum(a < 100 for a in groups) < 12


def test_zone_cells(spark):
    """A flood from several seeds around walls, against a plain search in rings."""
    draw = random.Random(3)
    cells = {(x, y) for x in range(14) for y in range(14) if draw.random() < 0.6}
    seeds = [(5, 0, 0), (2, 13, 13), (9, 6, 6), (1, 6, 6)]
    expected, ring, steps = {}, {}, 7
    for zone, x, y in seeds:
        ring[x, y] = min(zone, ring.get((x, y), zone))
    for _ in range(steps + 1):
        expected |= ring
        ahead = {}
        for (x, y), zone in ring.items():
            for at in ((x + i, y + j) for i in (-1, 0, 1) for j in (-1, 0, 1)):
                if at in cells and at not in expected:
                    ahead[at] = min(zone, ahead.get(at, zone))
        ring = ahead
    got = spatial.zone_cells(spark.createDataFrame(sorted(cells), "gx long, gy long"), spark.createDataFrame(seeds, "zone long, gx long, gy long"), steps)
    assert {(r.gx, r.gy): r.zone for r in got.collect()} == expected
    assert len(set(expected.values())) == 3
