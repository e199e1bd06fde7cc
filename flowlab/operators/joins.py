"""Equi-joins with explicit fills (J1-J4) and the exclusion join.

Join strategy is left to Catalyst/AQE (broadcast when a side is measured
small at runtime, sort-merge otherwise, skew-split by AQE).  The only forced
broadcast is ``checked_broadcast``: it measures the side first and falls
back to a shuffle join when the side is larger than the stated bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.functions.exprs import fill_missing

_HOW = {"inner": "inner", "left": "left", "right": "right", "full": "full", "full_outer": "full"}


def checked_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """``F.broadcast(df)`` only if ``df`` has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows; beyond the bound the side
    is returned unchanged and the planner picks a shuffle join."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def equi_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner",
              fill: str | None = "NULL") -> DataFrame:
    """Join on one key column, keeping a single key column (the one
    present: USING-join semantics).

    For outer joins every non-key payload column of the side that is
    *missing* is replaced by ``fill`` (payloads become strings).  A null
    inside a matched row is not a fill case, so presence is tracked with a
    marker column rather than by testing the payload.
    """
    how = _HOW[how]
    lp = [c for c in left.columns if c != key]
    rp = [c for c in right.columns if c != key]
    if how == "inner" or fill is None:
        return left.join(right, on=key, how=how).select(key, *lp, *rp)
    lm = left.withColumn("_fl_l", F.lit(True))
    rm = right.withColumn("_fl_r", F.lit(True))
    j = lm.join(rm, on=key, how=how)
    cols = [F.col(key)]
    for c in lp:
        cols.append(fill_missing(c, "_fl_l", fill).alias(c) if how in ("right", "full") else F.col(c))
    for c in rp:
        cols.append(fill_missing(c, "_fl_r", fill).alias(c) if how in ("left", "full") else F.col(c))
    return j.select(*cols)


def exclude(df: DataFrame, excluded: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not in ``excluded``.

    The exclusion list is a map keyed by id (last write wins), so only its
    distinct ids matter (partially aggregated).  AQE decides from their
    measured bytes whether they are broadcast or the anti-join shuffles.  The
    list is read as complete at the start of the job, the deterministic form
    of "ids that arrived before the row"."""
    ids = excluded.select(key)
    return df.join(ids.distinct(), on=key, how="left_anti")
