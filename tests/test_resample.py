"""Passes of the resampler, confirmations, change events and the gate's earlier counts."""

import pytest
from pyspark.sql import functions as F

from stepforge.operators import state
from stepforge.plans import curate, resample
from stepforge.streaming import sinks
from stepforge.streaming import state as streams


def selected(spark, rows, targets, **kwargs):
    frame = spark.createDataFrame(rows, "index bigint, step bigint, summary string, multiset string")
    wanted = spark.createDataFrame(targets, "step bigint, units bigint")
    return resample.multiset_resample(frame, wanted, 7, **kwargs).collect()


def test_first_pass_spreads_over_steps_with_room(spark):
    rows = [(2 * i + s - 1, s, f"s{s}", f"m{i}") for i in range(20) for s in (1, 2)]
    kept = selected(spark, rows, [(1, 11), (2, 9)])
    assert len(kept) == len({r["multiset"] for r in kept}) == 20
    assert [sum(r["step"] == s for r in kept) for s in (1, 2)] == [11, 9]


def test_second_pass_fills_a_step_up_to_its_target(spark):
    rows = [(i, 2 if i < 12 else 1, f"s{i}", "m") for i in range(60)]
    kept = selected(spark, rows, [(1, 1), (2, 12)])
    assert [sum(r["step"] == s for r in kept) for s in (1, 2)] == [1, 12]


def test_second_pass_stops_at_caps_and_soft_max(spark):
    rows = [(i, i % 3, f"s{i}", "m") for i in range(60)]
    targets = [(s, 20) for s in range(3)]
    assert len(selected(spark, rows, targets)) == 25
    assert len(selected(spark, rows, targets, soft_max=10)) == 10


def test_resample_without_rows_or_targets(spark):
    assert selected(spark, [], [(1, 3)]) == []
    assert len(selected(spark, [(1, 1, "a", "m"), (2, 1, "b", "m")], [])) == 1


def test_equal_issues_stay_apart_and_wait_ends(spark):
    issued = spark.createDataFrame([("u", 0), ("u", 0), ("u", 9_000_000)], "unit string, us bigint")
    seen = spark.createDataFrame([("u", 8_000_000), ("u", 30_000_000), ("v", 9_000_000)], "unit string, us bigint")
    got = state.commits(issued, seen, ["unit"], 8.0).collect()
    assert sorted((r["us"], r["committed"]) for r in got if r["committed"]) == [(0, 8_000_000)] * 2
    assert [r["us"] for r in got if r["committed"] is None] == [9_000_000]


def test_change_events_of_shield_completion_and_end(spark):
    frames = spark.createDataFrame(
        [(1, 0, "A", 5.0, 4.0, 1.0, False), (1, 1, "A", 5.0, 1.0, 1.0, False), (1, 2, "A", 5.0, 1.0, 1.0, True)],
        "unit bigint, us bigint, kind string, health double, shield double, progress double, destroyed boolean")
    got = state.frame_changes(frames, ["unit"], ["us"], F.lit(0), 60).collect()
    assert {(r["us"], r["change"], r["amount"]) for r in got} == {
        (0, "created", 0.0), (0, "construction_completed", 0.0), (1, "damaged", 3.0), (2, "destroyed", 0.0), (2, "last_seen", 0.0)}


@pytest.mark.parametrize("start, rows", [(None, [1, 2, 3]), (2, [1, 3])])
def test_rejects_by_whole_reasoning_or_its_start(spark, start, rows):
    rejects = spark.createDataFrame([("k", "abX", 1), ("k", "abY", 2), ("k", "c", 3), ("k", "c", 4)], "key string, said string, row int")
    got = curate.one_per_reasoning(rejects, "key", "said", "row", start)
    assert sorted(r["row"] for r in got.collect()) == rows


def test_gate_counts_what_an_earlier_run_admitted(spark, tmp_path):
    spark.createDataFrame([("a", i) for i in range(5)] + [("b", 9)], "class string, index bigint").write.parquet(str(tmp_path / "in"))
    rows = spark.readStream.schema("class string, index bigint").parquet(str(tmp_path / "in"))
    existing = spark.createDataFrame([("a", 2)], "class string, existing bigint")
    found = sinks.run_available(streams.class_gate(rows, 3, existing), str(tmp_path / "out"))
    assert sorted(r["class"] for r in found.collect()) == ["a", "b"]
