"""Structured Streaming forms of the operators whose state is per key."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SECOND = 1_000_000

# Executors get the small state handlers themselves, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def in_order(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    """A key's rows of one micro-batch by time; the size of a batch is set at the source."""
    frames = list(rows)
    return pd.concat(frames).sort_values(["us", "event_id"]) if frames else pd.DataFrame()


def values_in_order(rows: Iterator[pd.DataFrame], names: Sequence[str]) -> Iterator[tuple]:
    """The named values of a key's rows by time, as plain ones: a frame for each key costs more than its rows."""
    frames = list(rows)
    if not frames:
        return iter(())

    def column(name):
        return np.concatenate([f[name].to_numpy() for f in frames])

    order = np.lexsort((column("event_id"), column("us")))
    return zip(*[column(n)[order].tolist() for n in names])


class Forgetting(StatefulProcessor):
    """State with one timer per key: when event time passes it, the state is dropped.

    ``expired`` may emit rows when that happens. ``until`` tells when a state
    goes, so the timer to replace follows from the state before. Timers are in
    milliseconds and round up, so state never goes early.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", self.schema)

    def held(self):
        state = self.state.get()
        return None if state is None else tuple(state)

    def until(self, state) -> int:
        raise NotImplementedError

    def hold(self, state, was) -> None:
        """Remember ``state``, or nothing, in the place of ``was``."""
        old, new = (None if s is None else -(-self.until(s) // 1000) for s in (was, state))
        if old is not None and old != new:
            self.handle.deleteTimer(old)
        if state is not None:
            self.state.update(state)
            if old != new:
                self.handle.registerTimer(new)
        elif was is not None:
            self.state.clear()

    def expired(self, key, state):
        return None

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        state = self.held()
        self.state.clear()
        out = self.expired(key, state) if state is not None else None
        return iter(() if out is None else (out,))

    def close(self) -> None:
        pass


class SampleInterval(Forgetting):
    """Keeps a row when at least ``seconds`` passed since the last kept one; after that time nothing is remembered."""

    schema = "us bigint"

    def __init__(self, seconds: float) -> None:
        self.width = int(seconds * SECOND)

    def until(self, state):
        return state[0] + self.width

    def handleInputRows(self, key, rows, timerValues):
        was = self.held()
        last, kept = was and was[0], []
        frame = in_order(rows)
        for us, event in zip(frame["us"], frame["event_id"]):
            if last is None or us - last >= self.width:
                last = int(us)
                kept.append((key[0], last, int(event)))
        if kept:
            self.hold((last,), was)
            yield pd.DataFrame(kept, columns=["traj_id", "us", "event_id"])


class PendingCommit(Forgetting):
    """Issued orders that are confirmed in time; repeats of a pending order are ignored, an order not confirmed in time is forgotten."""

    schema = "us bigint, event_id bigint"

    def __init__(self, wait: float) -> None:
        self.width = int(wait * SECOND)

    def until(self, state):
        return state[0] + self.width + 1000

    def handleInputRows(self, key, rows, timerValues):
        was = pending = self.held()
        frame, done = in_order(rows), []
        for us, event, kind in zip(frame["us"], frame["event_id"], frame["kind"]):
            us = int(us)
            if pending and us > pending[0] + self.width:
                pending = None
            if kind == "issue" and pending is None:
                pending = (us, int(event))
            elif kind == "seen" and pending:
                done.append((key[0], pending[1], us))
                pending = None
        self.hold(pending, was)
        if done:
            yield pd.DataFrame(done, columns=["unit", "event_id", "committed"])


class LastSeenUnits(StatefulProcessor):
    """Emits a unit's last sighting once it expired unseen; seen or destroyed units are dropped."""

    def __init__(self, air_age: float, ground_age: float) -> None:
        self.ages = {True: int(air_age * 1000), False: int(ground_age * 1000)}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "us bigint, flying boolean")

    def handleInputRows(self, key, rows, timerValues):
        for us, kind, flying in in_order(rows)[["us", "kind", "flying"]].itertuples(index=False):
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if kind == "destroyed":
                self.last.clear()
            elif kind == "seen":
                self.last.update((int(us), bool(flying)))
                self.handle.registerTimer(int(us) // 1000 + self.ages[bool(flying)])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.last.exists():
            us, flying = self.last.get()
            self.last.clear()
            yield pd.DataFrame([(key[0], key[1], us, flying)], columns=["traj_id", "tag", "us", "flying"])

    def close(self) -> None:
        pass


class ClassGate(StatefulProcessor):
    """Admits rows of a class until its target is reached."""

    def __init__(self, target: int) -> None:
        self.target = target

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("kept", "n bigint")

    def handleInitialState(self, key, initialState, timerValues):
        self.kept.update((int(initialState["existing"].sum()),))

    def handleInputRows(self, key, rows, timerValues):
        kept = self.kept.get()[0] if self.kept.exists() else 0
        for frame in rows:
            few = frame.head(max(0, self.target - kept))
            kept += len(few)
            if len(few):
                yield pd.DataFrame({"class": [key[0]] * len(few), "index": few["index"].to_numpy()})
        self.kept.update((kept,))

    def close(self) -> None:
        pass


class FrameChanges(Forgetting):
    """Change events of a unit from its successive sightings, as ``operators.state.frame_changes`` has them.

    A pause above ``gap`` means that the unit left view with its last sighting.
    A unit not seen for ``forget`` is forgotten with the event ``last_seen``, and
    is created anew if it comes back.
    """

    schema = "us bigint, event_id bigint, kind string, health double, shield double, progress double"

    def __init__(self, gap: float, forget: float) -> None:
        self.gap, self.forget = int(gap * SECOND), int(forget * SECOND)

    def until(self, state):
        return state[0] + self.forget

    def handleInputRows(self, key, rows, timerValues):
        before = was = self.held()
        out = []
        names = ["us", "event_id", "kind", "health", "shield", "progress", "destroyed"]
        for us, event, kind, health, shield, progress, destroyed in values_in_order(rows, names):
            us, event = int(us), int(event)

            def tell(change, amount=0.0, at=event):
                out.append((key[0], at, change, amount))

            if was is None:
                tell("created")
                if progress < 1:
                    tell("construction_started")
            else:
                if us - was[0] > self.gap:
                    tell("left_view", at=was[1])
                    tell("entered_view")
                if health < was[3] or shield < was[4]:
                    tell("damaged", was[3] - health + was[4] - shield)
                if kind != was[2]:
                    tell("type_changed")
                if destroyed:
                    tell("destroyed")
            if progress >= 1 and (was is None or was[5] < 1):
                tell("construction_completed")
            was = (us, event, kind, float(health), float(shield), float(progress))
        if was is not None:
            self.hold(was, before)
        if out:
            yield pd.DataFrame(out, columns=["traj_id", "event_id", "change", "amount"])

    def expired(self, key, state):
        return pd.DataFrame([(key[0], state[1], "last_seen", 0.0)], columns=["traj_id", "event_id", "change", "amount"])


def sample_interval(rows: DataFrame, seconds: float, late: str = "8 seconds") -> DataFrame:
    """``rows`` has traj_id, us, event_id and the event time ``ts``; rows later than ``late`` are dropped."""
    return rows.withWatermark("ts", late).groupBy("traj_id").transformWithStateInPandas(
        SampleInterval(seconds), "traj_id bigint, us bigint, event_id bigint", "Append", "EventTime")


def pending_commit(rows: DataFrame, wait: float, late: str = "8 seconds") -> DataFrame:
    """``rows`` has unit, kind (issue or seen), us, event_id and the event time ``ts``."""
    return rows.withWatermark("ts", late).groupBy("unit").transformWithStateInPandas(
        PendingCommit(wait), "unit bigint, event_id bigint, committed bigint", "Append", "EventTime")


def expired_units(rows: DataFrame, air_age: float, ground_age: float, late: str = "8 seconds") -> DataFrame:
    """``rows`` has traj_id, tag, kind, flying, us, event_id and the event time ``ts``."""
    return rows.withWatermark("ts", late).groupBy("traj_id", "tag").transformWithStateInPandas(
        LastSeenUnits(air_age, ground_age), "traj_id bigint, tag bigint, us bigint, flying boolean", "Append", "EventTime")


def class_gate(rows: DataFrame, target: int, existing: DataFrame | None = None) -> DataFrame:
    """``existing`` has class and existing: what an earlier run admitted."""
    begin = existing.groupBy("class") if existing is not None else None
    return rows.groupBy("class").transformWithStateInPandas(
        ClassGate(target), "class string, index bigint", "Append", "None", begin)


def frame_changes(rows: DataFrame, gap: float, forget: float, late: str = "8 seconds") -> DataFrame:
    """``rows`` has traj_id, us, event_id, kind, health, shield, progress, destroyed and the event time ``ts``."""
    return rows.withWatermark("ts", late).groupBy("traj_id").transformWithStateInPandas(
        FrameChanges(gap, forget), "traj_id bigint, event_id bigint, change string, amount double", "Append", "EventTime")


def first_commits(issued: DataFrame, seen: DataFrame, wait: str = "8 seconds") -> DataFrame:
    """Issued orders that a confirmation followed inside the interval, once each.

    Both sides have unit and ``ts`` and a watermark; rows later than it are
    dropped. ``committed`` is the confirmation met first by the stream.
    """
    left = issued.withWatermark("ts", wait)
    right = seen.withWatermark("ts", wait).select(F.col("unit").alias("seen_unit"), F.col("ts").alias("seen_at"))
    inside = F.expr(f"unit = seen_unit AND seen_at BETWEEN ts AND ts + INTERVAL {wait}")
    joined = left.join(right, inside, "inner").withColumn("committed", F.unix_micros("seen_at")).drop("seen_unit", "seen_at")
    return joined.dropDuplicatesWithinWatermark(["event_id"])


def trailing_counts(rows: DataFrame, key: str, window: str = "60 seconds", slide: str = "10 seconds",
                    late: str = "8 seconds") -> DataFrame:
    """Rows per key in sliding windows of event time."""
    return rows.withWatermark("ts", late).groupBy(F.window("ts", window, slide), key).agg(F.count(F.lit(1)).alias("recent"))
