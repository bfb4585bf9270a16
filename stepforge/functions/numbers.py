"""Time and angle arithmetic as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Game ticks per second at the old and the new speed.
OLD_TICKS, NEW_TICKS = 16.0, 22.4


def to_new_ticks(time: Column) -> Column:
    return time / OLD_TICKS * NEW_TICKS


def to_old_ticks(time: Column) -> Column:
    return time / NEW_TICKS * OLD_TICKS


def frame_seconds(frames: Column) -> Column:
    return frames / NEW_TICKS


def started_at(now: Column, progress: Column, build_time: Column) -> Column:
    return now - progress * build_time


def finished_at(now: Column, progress: Column, build_time: Column) -> Column:
    return now + (1 - progress) * build_time


def wrap_angle(angle: Column) -> Column:
    """The angle moved into -pi..pi."""
    turned = F.pmod(angle, F.lit(2 * math.pi))
    return F.when(turned > math.pi, turned - 2 * math.pi).otherwise(turned)


def angle_distance(one: Column, two: Column) -> Column:
    gap = F.abs(wrap_angle(two) - wrap_angle(one))
    return F.when(gap <= math.pi, gap).otherwise(F.lit(2 * math.pi) - gap)


def normalised(x: Column, y: Column) -> Column:
    """Unit vector struct; the zero vector stays."""
    length = F.sqrt(x * x + y * y)
    part = lambda v: F.when(length == 0, v).otherwise(v / F.nullif(length, F.lit(0.0)))
    return F.struct(part(x).alias("x"), part(y).alias("y"))
