"""Jump chains, even blocks and what is built on them, against plain walks."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stepforge.operators import state
from stepforge.operators.chains import follow, later_positions
from stepforge.operators.ordered import even_blocks, numbered
from stepforge.plans import steps

SECOND = 1_000_000


def walked(jumps):
    """Positions from 0 on, with their jumps, of one key's list of jumps."""
    at, out = 0, []
    while at is not None and at < len(jumps):
        out.append((len(out), at, jumps[at]))
        at = jumps[at]
    return out


@pytest.mark.parametrize("size", [4, 16, 4096])
def test_follow(spark, size):
    draw = random.Random(size)
    keys = {}
    for key, (n, reach) in enumerate([(1, 3), (5, 2), (200, 1), (300, 6), (301, 40), (500, 500), (64, 9), (257, 3)]):
        keys[key] = [draw.choice([i + 1 + draw.randrange(reach)] * 30 + [None]) for i in range(n)]
    keys[20] = [i + 37 for i in range(400)]
    rows = [(k, i, to) for k, jumps in keys.items() for i, to in enumerate(jumps)]
    draw.shuffle(rows)
    got = {}
    for r in follow(spark.createDataFrame(rows, "k long, seq long, to long"), ["k"], size).collect():
        got.setdefault(r.k, []).append((r.hop, r.seq, r.to))
    assert {k: sorted(v) for k, v in got.items()} == {k: walked(jumps) for k, jumps in keys.items()}


def test_follow_nothing(spark):
    assert follow(spark.createDataFrame([], "k long, seq long, to long"), ["k"]).collect() == []


def test_even_blocks_of_a_hot_hour(spark):
    """A key with all its rows in one cell is cut into blocks of a stated size, in order."""
    draw = random.Random(2)
    rows = [(0, draw.randrange(3600 * SECOND), i) for i in range(20_000)] + [(1, i * 3600 * SECOND, i) for i in range(50)]
    df = spark.createDataFrame(rows, "k long, us long, event_id long")
    placed = even_blocks(df, ["k"], "us", 3600 * SECOND, 500)
    sizes = placed.groupBy("k", "_even").agg(F.count("*").alias("n"), F.min("us").alias("a"), F.max("us").alias("b")).collect()
    hot = sorted((tuple(r._even), r.n, r.a, r.b) for r in sizes if r.k == 0)
    assert max(n for _, n, _, _ in hot) <= 1000 and len(hot) >= 20
    assert all(x[3] < y[2] for x, y in zip(hot, hot[1:]))
    assert [r.n for r in sizes if r.k == 1] == [1] * 50
    got = {(r.k, r.event_id): r.seq for r in numbered(placed, ["k"], ["us", "event_id"], F.col("_even")).collect()}
    for key in (0, 1):
        ordered = sorted((us, e) for k, us, e in rows if k == key)
        assert all(got[key, e] == i for i, (_, e) in enumerate(ordered))


def test_even_blocks_keep_an_instant_together(spark):
    df = spark.createDataFrame([(0, 5, i) for i in range(1000)], "k long, us long, event_id long")
    assert even_blocks(df, ["k"], "us", 100, 10).select("_even").distinct().count() == 1


@pytest.mark.parametrize("same", [True, False])
def test_later_positions(spark, same):
    draw = random.Random(4)
    times = {k: sorted(draw.randrange(200) for _ in range(n)) for k, n in ((0, 400), (1, 7))}
    rows = [(k, t, i) for k, ts in times.items() for i, t in enumerate(ts)]
    df = spark.createDataFrame(rows, "k long, us long, seq long")
    found = later_positions(df, ["k"], "us", F.col("us") + 13, 13, same=same, most=20).collect()
    assert len(found) == len(rows)
    for r in found:
        ts = times[r.k]
        later = [i for i, t in enumerate(ts) if (t >= ts[r.seq] + 13 if same else t > ts[r.seq] + 13)]
        assert r.to == (min(later) if later else None)


def test_sample_interval(spark):
    draw = random.Random(6)
    rows = [(k, draw.randrange(3000) * SECOND, i, f"p{i}") for i in range(3000) for k in (0,)] + [(1, i * SECOND, i, "q") for i in range(0, 90, 7)]
    df = spark.createDataFrame(rows, "k long, us long, event_id long, text string")
    kept = state.sample_interval(df, ["k"], ["us", "event_id"], F.floor(F.col("us") / (60 * SECOND)), 12)
    assert kept.columns == df.columns
    expected = []
    for key in (0, 1):
        last = None
        for row in sorted(r for r in rows if r[0] == key):
            if last is None or row[1] - last >= 12 * SECOND:
                expected.append(row)
                last = row[1]
    assert Counter(map(tuple, kept.collect())) == Counter(expected)


def test_long_bursts_of_one_order(spark):
    """A burst without a pause is no list: thousands of issues, each pending when the next ones come."""
    rows = [(0, i * SECOND // 10, i) for i in range(9000)]
    issued = spark.createDataFrame(rows, "unit long, us long, event_id long")
    seen = spark.createDataFrame([(0, 100 * SECOND), (0, 700 * SECOND)], "unit long, us long")
    asked = state.commits(issued, seen, ["unit"], 8.0)
    kept = state.accepted_issues(asked, ["unit"], ["us", "event_id"], F.floor(F.col("us") / (50 * SECOND)), 8.0)
    until, expected = None, []
    for _, us, event in rows:
        if until is None or us > until:
            hit = [t for t in (100 * SECOND, 700 * SECOND) if us <= t <= us + 8 * SECOND]
            until = min(hit) if hit else us + 8 * SECOND
            expected.append(event)
    assert sorted(r.event_id for r in kept.collect()) == expected


def test_step_plan_reads_its_tables_few_times(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(9000).selectExpr("id % 2 AS traj_id", "id div 2 AS seq", "if(id % 17 = 0, 0.8, 0.2) AS score").write.parquet(path)
    cut = steps.split_steps(spark.read.parquet(path), size=64)
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 4
    assert cut.count() > 600
