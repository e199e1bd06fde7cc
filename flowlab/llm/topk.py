"""Exact top-k search by distributed histogram selection.

Every pass scores all (query, candidate) pairs block by block.  The first
passes keep only histograms of the scores, each narrowing every query's range
to the bin that holds its k-th best score until that bin is one value wide.
The last pass keeps the scores at or above it; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowlab.llm.common import partitions, saved, ship_package

BLOCK = 1024           # vectors of a block
BINS = 1024
EXACT_DOUBLE = 2 ** 52
INT64 = 2 ** 63
LARGEST = 2 ** 62 - 1  # scores beyond it, either way, are given as it
PASSES = 64


def integer_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id, v`` with ``v = floor(scale * x)`` per component; rows whose
    vector (or id) is null, or holds a null or non-finite component, are left
    out.  An empty vector stays (every score with it is 0).  A component that
    does not fit 64 bits becomes the nearest value that does."""
    x = F.col("embedding")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != F.lit(float("inf"))))
    return (vectors.filter(F.col("vec_id").isNotNull() & x.isNotNull()).filter(F.coalesce(finite, F.lit(False)))
            .select(F.col("vec_id").cast("bigint"),
                    F.transform(x, lambda e: F.floor(F.lit(scale) * e.cast("double"))).alias("v")))


def _pack(rows: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Rows packed to blocks: ids, vectors as one matrix (shorter vectors are
    filled with zeros) of the smallest integers that hold it and the extra
    columns, all as bytes."""
    ship_package(rows.sparkSession)
    names = ["vec_id", *extra]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                vectors = part.column("v").to_pylist()
                width = max(1, max(map(len, vectors)))
                m = np.zeros((len(vectors), width), np.int64)
                for i, v in enumerate(vectors):
                    m[i, :len(v)] = v
                cols = [part.column(c).to_numpy(zero_copy_only=False).astype(np.int64).tobytes() for c in names]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], t) for x, t in [*zip(cols, [pa.binary()] * len(cols)), (_narrow(m).tobytes(), pa.binary()),
                                                   (width, pa.int32())]], names=[*names, "m", "width"])
    return rows.select(*names, "v").mapInArrow(run, ", ".join(f"{c} binary" for c in names) + ", m binary, width int")


def _narrow(m: np.ndarray) -> np.ndarray:
    kinds = (np.int8, np.int16, np.int32)
    return next((m.astype(t) for t in kinds if np.iinfo(t).min <= m.min() and m.max() <= np.iinfo(t).max), m)


def _matrix(m: bytes, rows: int, width: int) -> np.ndarray:
    return np.frombuffer(m, f"i{len(m) // (rows * width)}").astype(np.int64).reshape(rows, width)


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products, exact: by doubles while no partial sum can pass their
    integers, else by 64-bit integers, else by Python's; held to ``LARGEST``."""
    width = max(q.shape[1], c.shape[1])
    q, c = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (q, c))
    bound = width * _reach(q) * _reach(c)
    if bound < EXACT_DOUBLE:
        return (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    if bound < INT64:
        return np.clip(q @ c.T, -LARGEST, LARGEST)
    return np.clip(q.astype(object) @ c.T.astype(object), -LARGEST, LARGEST).astype(np.int64)


def _reach(m: np.ndarray) -> int:
    return max(-int(m.min(initial=0)), int(m.max(initial=0)))


def _grid(candidates: int, queries: int, cells: int) -> tuple[int, int]:
    """Groups of candidate and of query blocks: about ``cells`` pairs of groups
    at the least number of copies (a block has one for each group of the other
    side)."""
    cells = min(cells, candidates * queries)
    groups = min(candidates, max(1, round(sqrt(cells * candidates / queries))))
    return groups, min(queries, ceil(cells / groups))


def _pairs(queries: DataFrame, candidates: DataFrame, grid: tuple[int, int]) -> DataFrame:
    """Each block of queries with each block of candidates: either side's
    blocks fall into groups and are copied to every group of the other, a join
    on both groups brings them together.  It is a merge join: Spark takes the
    copies for as small as the table that they are made of, and would send
    them through the driver."""
    def dealt(df: DataFrame, side: str, own: str, groups: int, other: str, copies: int) -> DataFrame:
        return df.select(*[F.col(c).alias(f"{side}_{c}") for c in df.columns],
                         F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int").alias(own),
                         F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias(other))
    left, right = dealt(queries, "q", "h", grid[1], "g", grid[0]), dealt(candidates, "c", "g", grid[0], "h", grid[1])
    return left.hint("merge").join(right, ["g", "h"]).drop("g", "h")


def _each_pair(pairs: DataFrame, fn, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                arr = {k: np.frombuffer(v, np.int64) for k, v in row.items() if isinstance(v, bytes) and k not in ("q_m", "c_m")}
                s = _scores(*(_matrix(row[f"{x}_m"], len(arr[f"{x}_vec_id"]), row[f"{x}_width"]) for x in "qc"))
                out = fn(arr, s, arr["q_vec_id"][:, None] != arr["c_vec_id"][None, :])
                if out is not None and len(out[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out],
                                                     names=[f.split()[0] for f in schema.split(", ")])
    return pairs.mapInArrow(run, schema)


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: per row of ``queries`` (vec_id, v)
    its ``k`` highest inner products with rows of ``candidates`` of another id;
    all of them if fewer.  Equal scores go by smaller id.  Repeated candidate
    rows each take a place; repeated queries count once.  Vectors of unequal
    length are filled with zeros.  Empty tables give no rows.  A score beyond
    ``LARGEST`` (about 4.6e18), either way, is given as ``LARGEST``; among
    such scores the smaller id goes first.

    A block pair gives at most ``k`` histogram bins per query (bins under its
    own k-th best cannot hold the global one) and at most ``k`` rows per query
    and tie, so hot vectors add no rows; nothing else is kept.
    """
    cand = saved(_pack(candidates), "topk-candidates")
    state = saved(queries.groupBy("vec_id").agg(F.first("v").alias("v"))
                  .withColumns({"need": F.lit(k).cast("bigint"), "open": F.lit(1).cast("bigint")}), "topk-queries")
    grid = _grid(max(1, cand.count()), max(1, ceil(state.count() / BLOCK)), 2 * partitions(cand.sparkSession))

    # the first bins span the scores that the vectors' lengths allow
    def longest(df):
        square = F.aggregate("v", F.lit(0.0), lambda a, e: a + e.cast("double") * e.cast("double"))
        return df.agg(F.max(F.sqrt(square))).first()[0] or 0.0
    bound = min(int(longest(queries) * longest(candidates) * (1 + 1e-9)) + 2, LARGEST + 1)
    width = -(-(2 * bound + 1) // BINS)
    state = state.withColumns({"lo": F.lit(-bound).cast("bigint"), "hi": F.lit(bound + 1).cast("bigint"),
                               "width": F.lit(width).cast("bigint")})

    def histogram(a: dict, s: np.ndarray, other: np.ndarray):
        lo, width, need = a["q_lo"][:, None], a["q_width_"][:, None], a["q_need"]
        bins = (s - lo) // width
        inside = other & (s >= lo) & (s < a["q_hi"][:, None])
        n = len(need)
        flat = (np.arange(n)[:, None] * BINS + bins)[inside]
        h = np.bincount(flat, minlength=n * BINS).reshape(n, BINS)
        above = h[:, ::-1].cumsum(axis=1)[:, ::-1] - h  # of higher bins
        keep = (h > 0) & (above < need[:, None])
        rows, cols = np.nonzero(keep)
        return a["q_vec_id"][rows], cols, h[rows, cols]

    for _ in range(PASSES):
        packed = _pack(state.filter("open = 1").withColumnRenamed("width", "width_"), ("lo", "hi", "width_", "need"))
        counts = (_each_pair(_pairs(packed, cand, grid), histogram, "vec_id bigint, bin bigint, n bigint")
                  .groupBy("vec_id", "bin").agg(F.sum("n").alias("n")))
        down = W.partitionBy("vec_id").orderBy(F.col("bin").desc())
        before = F.coalesce(F.sum("n").over(down.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        ranked = counts.withColumn("before", before).join(state.select("vec_id", "need"), "vec_id")
        # the bin of the k-th best; the lowest bin where a query has fewer rows
        at = (ranked.filter("before < need").groupBy("vec_id")
              .agg(F.min_by(F.struct("bin", "before", "n"), "bin").alias("b")))
        found = state.join(at, "vec_id", "left")
        step = F.greatest(F.lit(1), F.ceil(F.col("width") / F.lit(BINS)).cast("bigint"))
        moved = F.col("b").isNotNull()
        low = F.col("lo") + F.col("b.bin") * F.col("width")
        state = saved(found.select(
            "vec_id", "v",
            F.when(moved, low).otherwise(F.col("lo")).alias("lo"),
            F.when(moved, F.least(low + F.col("width"), F.col("hi"))).otherwise(F.col("hi")).alias("hi"),
            F.when(moved & (F.col("width") > 1), step).otherwise(F.col("width")).alias("width"),
            F.when(moved, F.col("need") - F.col("b.before")).otherwise(F.col("need")).alias("need"),
            F.when(moved & (F.col("width") > 1), F.lit(1)).otherwise(0).cast("bigint").alias("open")), "topk-state")
        if state.filter("open = 1").isEmpty():
            break
    else:
        raise RuntimeError("the histograms did not narrow to single values")

    def finalists(a: dict, s: np.ndarray, other: np.ndarray):
        ids, found, scores = [], [], []
        order = np.argsort(a["c_vec_id"], kind="stable")
        cid, s, other = a["c_vec_id"][order], s[:, order], other[:, order]
        lo = a["q_lo"]
        passing = other & (s >= lo[:, None])
        for i in np.flatnonzero(passing.any(axis=1)):
            at = np.flatnonzero(passing[i])
            tie = s[i, at] == lo[i]
            at = np.concatenate([at[~tie], at[tie][:k]])
            ids.append(np.full(len(at), a["q_vec_id"][i]))
            found.append(cid[at])
            scores.append(s[i, at])
        return (np.concatenate(ids), np.concatenate(found), np.concatenate(scores)) if ids else None

    rows = _each_pair(_pairs(_pack(state, ("lo",)), cand, grid), finalists, "query_id bigint, vec_id bigint, score bigint")
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
