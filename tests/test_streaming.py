"""State that lives on between micro-batches and runs."""

import pandas as pd
from pyspark.sql import functions as F

from stepforge.streaming import sinks
from stepforge.streaming import state as S

SCHEMA = "traj_id bigint, tag bigint, kind string, flying boolean, us bigint, event_id bigint"


def feed(spark, folder, rows, name):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(str(folder / name))


def stream(spark, folder):
    rows = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(folder))
    return rows.withColumn("ts", F.timestamp_micros("us"))


def second(n):
    return n * S.SECOND


def test_sample_interval_goes_on_after_a_restart(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    feed(spark, source, [(1, 0, "seen", False, second(100 + t), t) for t in (0, 3, 5, 9)], "a")
    query = lambda: S.sample_interval(stream(spark, source).select("traj_id", "us", "event_id", "ts"), 5)
    sinks.run_available(query(), out)
    feed(spark, source, [(1, 0, "seen", False, second(100 + t), t) for t in (11, 14, 16)], "b")
    rows = sinks.run_available(query(), out)
    assert sorted(r.event_id for r in rows.collect()) == [0, 5, 11, 16]


def test_units_expire_by_event_time(spark, tmp_path):
    source = tmp_path / "in"
    feed(spark, source, [(1, 1, "seen", True, second(1000), 1), (1, 2, "seen", False, second(1000), 2),
                         (1, 3, "seen", True, second(1000), 3), (1, 3, "destroyed", True, second(1005), 4)], "a")
    feed(spark, source, [(2, 9, "seen", False, second(1200), 5)], "b")
    feed(spark, source, [(2, 9, "seen", False, second(1201), 6)], "c")
    rows = sinks.run_available(S.expired_units(stream(spark, source), 60, 360), str(tmp_path / "out"))
    assert [(r.traj_id, r.tag, r.us) for r in rows.collect()] == [(1, 1, second(1000))]


def test_class_gate_counts_over_batches(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    feed(spark, source, [(1, 0, "a", False, 0, i) for i in range(3)], "a")
    gate = lambda: S.class_gate(stream(spark, source).select(
        F.col("kind").alias("class"), F.col("event_id").alias("index")), 4)
    sinks.run_available(gate(), out)
    feed(spark, source, [(1, 0, "a", False, 0, i) for i in range(3, 9)] + [(1, 0, "b", False, 0, 20)], "b")
    counts = {r["class"]: r["count"] for r in sinks.run_available(gate(), out).groupBy("class").count().collect()}
    assert counts == {"a": 4, "b": 1}


def test_interval_join(spark, tmp_path):
    source = tmp_path / "in"
    feed(spark, source, [(1, 0, "issue", False, second(100), 1), (1, 0, "issue", False, second(120), 2),
                         (1, 0, "seen", False, second(106), 3), (1, 0, "seen", False, second(140), 4)], "a")
    rows = stream(spark, source).withColumn("unit", F.col("traj_id"))
    issued = rows.filter("kind = 'issue'").select("unit", "ts", "event_id")
    seen = rows.filter("kind = 'seen'").select("unit", "ts")
    found = sinks.run_available(S.first_commits(issued, seen), str(tmp_path / "out"))
    assert [r.event_id for r in found.collect()] == [1]


def test_trailing_windows(spark, tmp_path):
    source = tmp_path / "in"
    feed(spark, source, [(1, 0, "a", False, second(t), t) for t in (0, 30, 65)], "a")
    feed(spark, source, [(1, 0, "a", False, second(500), 9)], "b")
    feed(spark, source, [(1, 0, "a", False, second(501), 10)], "c")
    rows = sinks.run_available(S.trailing_counts(stream(spark, source), "traj_id"), str(tmp_path / "out"))
    # The window (10 s, 70 s] style slide that starts at 10 holds 30 and 65.
    starts = {int(r.window.start.timestamp()): r.recent for r in rows.collect()}
    assert starts[10] == 2 and starts[0] == 2 and starts[60] == 1


def test_logs_and_upserts_resume(spark, tmp_path):
    source, logs, table = tmp_path / "in", str(tmp_path / "logs"), str(tmp_path / "table")
    feed(spark, source, [(1, 7, "a", False, second(1), 1), (1, 8, "b", False, second(2), 2)], "a")
    rows = stream(spark, source).drop("ts")
    sinks.append_log(rows, logs, {"audit": F.col("kind") == "a", "rejected": F.col("kind") != "a"})
    feed(spark, source, [(1, 7, "b", False, second(3), 3)], "b")
    sinks.append_log(rows, logs, {"audit": F.col("kind") == "a", "rejected": F.col("kind") != "a"})
    assert sinks.read_log(spark, logs, "audit").count() == 1
    assert sinks.read_log(spark, logs, "rejected").count() == 2
    found = lambda: {r.tag: r.event_id for r in sinks.read_upserted(spark, table, "tag", ["us"]).collect()}
    sinks.upsert(rows, table)
    assert found() == {7: 3, 8: 2}
    # A later run on the same checkpoint keeps what was there; an older row replaces nothing.
    feed(spark, source, [(1, 9, "a", False, second(4), 4), (1, 7, "a", False, second(2), 5)], "c")
    sinks.upsert(rows, table)
    assert found() == {7: 3, 8: 2, 9: 4}
    sinks.upsert(rows, table)
    assert found() == {7: 3, 8: 2, 9: 4}
    whole = sinks.compacted(spark, table, "tag", ["us"], str(tmp_path / "whole"))
    assert {r.tag: r.event_id for r in whole.collect()} == found()


def states_left(spark, folder):
    """Keys whose state a finished stream still holds."""
    reader = spark.read.format("statestore").option("stateVarName", "state")
    return sorted(r.key[0] for r in reader.load(f"{folder}/checkpoint").collect())


def test_state_of_silent_keys_is_gone(spark, tmp_path):
    """Two keys are seen, one falls silent while the other goes on: the first one's state goes, its rows stay."""
    source = tmp_path / "in"
    feed(spark, source, [(1, 0, "issue", False, second(100), 1), (2, 0, "issue", False, second(100), 2)], "a")
    feed(spark, source, [(2, 0, "issue", False, second(500), 3)], "b")
    feed(spark, source, [(2, 0, "issue", False, second(501), 4)], "c")
    sampled = sinks.run_available(S.sample_interval(stream(spark, source), 20), str(tmp_path / "sample"))
    assert sorted(r.event_id for r in sampled.collect()) == [1, 2, 3]
    assert states_left(spark, tmp_path / "sample") == [2]
    orders = stream(spark, source).withColumn("unit", F.col("traj_id"))
    assert sinks.run_available(S.pending_commit(orders, 20), str(tmp_path / "orders")).collect() == []
    assert states_left(spark, tmp_path / "orders") == [2]


def test_frame_changes_over_batches(spark, tmp_path):
    source, schema = tmp_path / "in", "traj_id bigint, us bigint, event_id bigint, kind string, health double, shield double, progress double, destroyed boolean"

    def put(name, *rows):
        spark.createDataFrame([(1, second(100 + t), e, k, h, s, p, d) for t, e, k, h, s, p, d in rows], schema).coalesce(1).write.parquet(str(source / name))

    put("a", (0, 1, "x", 10.0, 5.0, 0.5, False), (1, 2, "x", 8.0, 5.0, 0.7, False))
    put("b", (2, 3, "y", 8.0, 1.0, 1.0, False), (30, 4, "y", 8.0, 1.0, 1.0, True))
    spark.createDataFrame([(2, second(900), 5, "z", 1.0, 1.0, 1.0, False)], schema).coalesce(1).write.parquet(str(source / "c"))
    spark.createDataFrame([(2, second(901), 6, "z", 1.0, 1.0, 1.0, False)], schema).coalesce(1).write.parquet(str(source / "d"))
    rows = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(source))
    found = sinks.run_available(S.frame_changes(rows.withColumn("ts", F.timestamp_micros("us")), 10, 60), str(tmp_path / "out"))
    assert sorted((r.event_id, r.change, r.amount) for r in found.collect() if r.traj_id == 1) == [
        (1, "construction_started", 0.0), (1, "created", 0.0), (2, "damaged", 2.0), (3, "construction_completed", 0.0), (3, "damaged", 4.0),
        (3, "left_view", 0.0), (3, "type_changed", 0.0), (4, "destroyed", 0.0), (4, "entered_view", 0.0), (4, "last_seen", 0.0)]
    assert states_left(spark, tmp_path / "out") == [2]


class Remembered:
    """A key's state and timers in place of the state store; timers are never listed, which costs a round trip a key."""

    def __init__(self):
        self.value, self.timers = None, set()

    def getValueState(self, name, schema):
        return self

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def test_one_timer_follows_the_state_without_listing():
    names = ["us", "event_id", "kind", "health", "shield", "progress", "destroyed"]
    units, handle = S.FrameChanges(10, 60), Remembered()
    units.init(handle)
    rows = [(3_000_000, 3, "b", 1.0, 0.0, 1.0, False), (1_000_000, 1, "a", 5.0, 0.0, 0.5, False)]
    batches = [[pd.DataFrame(rows[:1], columns=names), pd.DataFrame(rows[1:], columns=names)],
               [pd.DataFrame([(9_000_500, 4, "b", 1.0, 0.0, 1.0, False)], columns=names)],
               [pd.DataFrame([(9_000_500, 4, "b", 1.0, 0.0, 1.0, False)], columns=names)]]
    told = []
    for batch, timer in zip(batches, (63_000, 69_001, 69_001)):
        told += [tuple(r)[1:3] for f in units.handleInputRows((7,), iter(batch), None) for r in f.itertuples(index=False)]
        assert handle.timers == {timer}
    assert told == [(1, "created"), (1, "construction_started"), (3, "damaged"), (3, "type_changed"), (3, "construction_completed")]
    orders, handle = S.PendingCommit(5), Remembered()
    orders.init(handle)
    columns = ["us", "event_id", "kind"]
    list(orders.handleInputRows((7,), iter([pd.DataFrame([(0, 1, "issue")], columns=columns)]), None))
    assert handle.timers == {5_001}
    done = list(orders.handleInputRows((7,), iter([pd.DataFrame([(2, 2, "seen")], columns=columns)]), None))
    assert handle.timers == set() and handle.value is None and done[0].iloc[0].tolist() == [7, 1, 2]
