"""One row or a few rows per key, with the choice made before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                  latest: bool = False) -> DataFrame:
    """The row with the least (or greatest) order per key.

    An aggregate, not a window: each task sends one row per key it saw, so a
    key with a third of all rows costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if latest else F.min_by
    at = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    return (
        df.groupBy(*keys)
        .agg(pick(F.struct(*rest), at).alias("_row"))
        .select(*keys, *[F.col("_row")[c].alias(c) for c in rest])
        .select(*df.columns)
    )


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows per key; Spark cuts each task's input to ``n`` per key first."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")
