"""Positions in one global order, without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowlab.llm.common import partitions, saved


def range_slices(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` range-sorted by unique ``order`` columns and written once, with
    its slice number as ``__slice``.  Slices hold about as many rows each,
    whatever the values, so that a window inside one is bounded."""
    p = partitions(df.sparkSession)
    return saved(df.repartitionByRange(p, *order).withColumn("__slice", F.spark_partition_id()), name)


def running_start(sliced: DataFrame, order: list[str], amount: str) -> Column | DataFrame:
    """``sliced`` with ``__start``: the sum of ``amount`` over all rows before.
    Only one sum per slice meets in the carry step."""
    sums = sliced.groupBy("__slice").agg(F.sum(amount).alias("__sum"))
    before = W.orderBy("__slice").rowsBetween(W.unboundedPreceding, -1)
    carry = sums.select("__slice", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__carry"))
    inside = W.partitionBy("__slice").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    own = F.coalesce(F.sum(amount).over(inside), F.lit(0))
    return (sliced.withColumn("__own", own).join(F.broadcast(carry), "__slice")
            .withColumn("__start", F.col("__own") + F.col("__carry")).drop("__own", "__carry"))


def neighbours(sliced: DataFrame, order: list[str], fields: list[str]) -> DataFrame:
    """``sliced`` with structs ``__prev`` and ``__next`` of the ``fields`` of
    the rows next to it in the order, also across slices."""
    own = F.struct(*fields)
    w = W.partitionBy("__slice").orderBy(*order)
    inside = sliced.withColumns({"__prev": F.lag(own).over(w), "__next": F.lead(own).over(w)})
    key = F.struct(*order)
    ends = sliced.groupBy("__slice").agg(F.min_by(own, key).alias("first"), F.max_by(own, key).alias("last"))
    across = W.orderBy("__slice")  # one row per slice
    ends = ends.select("__slice", F.lag("last").over(across).alias("__before"), F.lead("first").over(across).alias("__after"))
    return (inside.join(F.broadcast(ends), "__slice")
            .withColumns({"__prev": F.coalesce("__prev", "__before"), "__next": F.coalesce("__next", "__after")})
            .drop("__before", "__after"))
