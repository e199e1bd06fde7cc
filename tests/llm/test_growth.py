"""What steps write and send as tables grow."""

import numpy as np
import pytest

from flowlab.llm import jaccard_join, topk
from flowlab.llm.common import BATCH_ROWS


@pytest.fixture
def written(monkeypatch):
    """The tables that the Jaccard join writes, as (name, rows)."""
    out, save = [], jaccard_join.saved

    def spy(df, name, *args):
        table = save(df, name, *args)
        out.append((name, table.count()))
        return table
    monkeypatch.setattr(jaccard_join, "saved", spy)
    return out


def test_sets_are_built_only_for_pairs_that_may_link(spark, written):
    """Large texts that share half of their words meet in buckets, which 1,024
    bits do not tell; their sets are neither written nor joined."""
    rng = np.random.default_rng(7)
    words = [f"w{x}" for x in rng.integers(0, 10 ** 6, 18000)]
    shared, near = words[:3000], words[9000:12000]
    rows = [(i, " ".join(shared + words[3000 * (i + 1):3000 * (i + 2)])) for i in range(2)]
    rows += [(5, " ".join(near)), (6, " ".join(near[:2990] + words[12000:12010])), (7, " ".join(words[15000:15040]))]
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string"), words=5, percent=80).collect()
    assert {r.doc_id: r.component_id for r in got} == {0: 0, 1: 1, 5: 5, 6: 5, 7: 7}
    assert sum(n for name, n in written if name == "jac-met") >= 2  # the unlike ones did meet
    assert [n for name, n in written if name == "jac-sets"] == [2, 0]


@pytest.mark.parametrize("other, differences", [(1100, 200), (1500, 300), (2100, 421), (2100, 463), (5000, 900)])
def test_wide_sketches_never_tell_linked_sets_apart(spark, other, differences):
    rng = np.random.default_rng(other)
    pool = np.unique(rng.integers(0, 2 ** 63, 3 * other, dtype=np.int64).astype(np.uint64) * np.uint64(2))
    rng.shuffle(pool)
    a = np.sort(pool[:other])
    sets = {1: a, 2: np.sort(np.concatenate([a[differences // 2:], pool[other:other + differences - differences // 2]])),
            3: np.sort(a[:other - differences]), 4: np.sort(pool[other:2 * other]), 5: np.sort(pool[:40])}
    bits = spark.createDataFrame([(i, len(h), None if (w := jaccard_join.wide_sketch(h)) is None else bytearray(w)) for i, h in sets.items()],
                                 "node bigint, n bigint, wide binary")
    pairs = spark.createDataFrame([(i, j) for i in sets for j in sets if i < j], "a bigint, b bigint")
    kept = {tuple(r) for r in jaccard_join._not_told_apart(pairs, bits, 80).collect()}
    for i in sets:
        for j in sets:
            if i < j:
                common = len(np.intersect1d(sets[i], sets[j]))
                if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                    assert (i, j) in kept
    assert (1, 4) not in kept and (1, 5) in kept  # a small set has no wide sketch


def _best(rows, queries, k):
    out = []
    for q in queries:
        best = sorted((-sum(a * b for a, b in zip(rows[q], v)), j) for j, v in rows.items() if j != q)[:k]
        out += [(q, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    return sorted(out)


def test_copies_of_query_blocks_do_not_pass_through_the_driver(spark, monkeypatch):
    """Query blocks are copied to groups of candidate blocks.  Spark takes the
    copies for small; a broadcast of them grows with the square of the table."""
    pairs, plans, copies = topk._pairs, [], []

    def spy(queries, candidates, *grid):
        out = pairs(queries, candidates, *grid)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        copies.append(out.select("q_vec_id", "c_vec_id").distinct().count() == queries.count() * candidates.count())
        return out
    monkeypatch.setattr(topk, "_pairs", spy)
    rng = np.random.default_rng(1)
    rows = {i: [int(x) for x in rng.integers(-200, 200, 8)] for i in range(400)}
    rows |= {401: [2 ** 40, -3] + [0] * 6, 402: [-2 ** 20] * 8, 403: [127] * 8}  # of other widths than their neighbours
    was = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, "16")
    try:
        v = spark.createDataFrame(list(rows.items()), "vec_id bigint, v array<bigint>").repartition(3, "vec_id")
        got = topk.top_k(v.filter("vec_id % 5 = 0 or vec_id > 400"), v, 5).collect()
    finally:
        spark.conf.set(BATCH_ROWS, was)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == _best(rows, [i for i in rows if i % 5 == 0 or i > 400], 5)
    assert plans and all(copies) and not any("Broadcast" in p for p in plans)


def test_the_grid_of_blocks_makes_few_copies():
    for candidates, queries, cells in [(1, 1, 50), (624, 14, 50), (624, 14, 1200), (15600, 312, 1200), (10, 10, 8), (3, 40, 24)]:
        groups, query_groups = topk._grid(candidates, queries, cells)
        assert 1 <= groups <= candidates and 1 <= query_groups <= queries
        assert groups * query_groups >= min(cells, candidates * queries) * 0.9
        least = min(g * queries + -(-min(cells, candidates * queries) // g) * candidates for g in range(1, candidates + 1))
        assert groups * queries + query_groups * candidates <= 1.5 * least + candidates
