"""Positions and running totals over a whole ordered table, without a one-partition window.

A global sort leaves each partition holding one range of the order. Running totals inside the
ranges, plus the totals of the ranges before them, give the global result; the only table that
meets one task has one row per partition. The sorted rows are materialised first, because both
steps must see the same ranges even if executors are lost in between.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, UserDefinedType

from verbatide.session import materialise

_SLOT, _RANGE = "_slot", "_range"


def _ranged(df: DataFrame, order_by: Sequence[Column]) -> DataFrame:
    # monotonically_increasing_id is (partition << 33) + row within partition.
    slotted = df.orderBy(*order_by).withColumn(_SLOT, F.monotonically_increasing_id())
    return materialise(slotted).withColumn(_RANGE, F.shiftright(_SLOT, 33))


def dense_index(df: DataFrame, order_by: Sequence[Column], name: str = "index", start: int = 0) -> DataFrame:
    """Number the rows ``start, start + 1, …`` in the given order.

    Ties are ordered by a hash of the row. Without it all rows of one common key would be one range
    of the sort, and so one task.
    """
    hashed = [f.name for f in df.schema if not isinstance(f.dataType, (MapType, UserDefinedType))]
    ranged = _ranged(df, [*order_by, F.xxhash64(*hashed)])
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy(_RANGE).agg(F.count("*").alias("_rows"))
    offsets = offsets.select(_RANGE, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    within = F.col(_SLOT) - F.shiftleft(F.col(_RANGE), 33)
    return (
        ranged.join(F.broadcast(offsets), _RANGE)  # one row per partition of the sort
        .withColumn(name, (F.col("_before") + within + start).cast("long"))
        .drop(_SLOT, _RANGE, "_before")
    )


def running_totals(
    df: DataFrame, order_by: Sequence[Column], totals: Mapping[str, str]
) -> DataFrame:
    """Add, for each ``{column: name}``, the running total ``name`` and the grand total ``name_all``."""
    ranged = _ranged(df, order_by)
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = ranged.groupBy(_RANGE).agg(*[F.sum(c).alias(f"_{n}") for c, n in totals.items()])
    offsets = offsets.select(
        _RANGE,
        *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}_before") for n in totals.values()],
        *[F.sum(f"_{n}").over(everything).alias(f"{n}_all") for n in totals.values()],
    )
    upto = Window.partitionBy(_RANGE).orderBy(_SLOT).rowsBetween(Window.unboundedPreceding, 0)
    running = ranged.select("*", *[F.sum(c).over(upto).alias(n) for c, n in totals.items()])
    joined = running.join(F.broadcast(offsets), _RANGE)  # one row per partition of the sort
    for n in totals.values():
        joined = joined.withColumn(n, F.col(n) + F.col(f"_{n}_before")).drop(f"_{n}_before")
    return joined.drop(_SLOT, _RANGE)
