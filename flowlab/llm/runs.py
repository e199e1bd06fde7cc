"""Periodic runs of words, by maximal pairs.

A run of period ``q`` that starts at word ``s`` and has ``L`` words is the
maximal pair ``(s, s + q)`` with ``L - q`` equal words: the words in front of
the two places differ, and so do those behind.  Maximal pairs are read off the
tree of LCP intervals of a document's suffix array, bottom up: where intervals
meet at a common prefix of ``l`` words, places from different ones share ``l``
words and no more, and their left words tell whether the pair is maximal.
A pair whose distance is short against ``l`` is a run as it stands.

Places of one interval that lie within ``l / 3`` of each other stand in
arithmetic progression, so a run's own pair always lies next to each other in
the interval's sorted places: only neighbours are compared.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from flowlab.llm.common import ship_package, strings
from flowlab.llm.jaccard_join import word_hashes

MIN_LENGTH, MIN_EXPONENT = 6, 4
#: Texts are handled together up to this size; one text is never cut.
GROUP_BYTES = 2 << 20
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def suffix_levels(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix order and ranks of several documents' words by doubling.

    ``words`` holds all documents' word numbers, each document's number space
    its own and ascending with the document, ``ends[i]`` the end of the
    document of place ``i``.  ``levels[k][i]`` is the rank of the ``2**k``
    words from ``i``: equal ranks mean equal words.  Only places that are not
    alone yet are sorted again.
    """
    n = len(words)
    order = np.argsort(words, kind="stable")
    first = np.ones(n, bool)
    first[1:] = words[order[1:]] != words[order[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    levels, reach = [rank], 1
    while True:
        size = np.bincount(rank, minlength=n)
        slots = np.flatnonzero(size[rank[order]] > 1)   # their places in the order stay the group's own
        if not len(slots):
            return order, levels
        at = order[slots]
        behind = at + reach
        second = np.where(behind < ends[at], rank[np.minimum(behind, n - 1)], -1)
        by = np.lexsort((second, rank[at]))
        at, second = at[by], second[by]
        order = order.copy()
        order[slots] = at
        new = np.ones(len(at), bool)
        new[1:] = (rank[at[1:]] != rank[at[:-1]]) | (second[1:] != second[:-1])
        rank = rank.copy()
        rank[at] = slots[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        levels.append(rank)
        reach *= 2


def common_prefixes(a: np.ndarray, b: np.ndarray, ends: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """How many words from the places ``a`` equal those from ``b``, of one document each."""
    out = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + out, b + out
        inside = np.maximum(x, y) + (1 << k) <= ends[a]
        last = len(ends) - 1
        same = inside & (levels[k][np.minimum(x, last)] == levels[k][np.minimum(y, last)])
        out += np.where(same, 1 << k, 0)
    return out


def _join(one: list[int], two: list[int], common: int, left: np.ndarray, found: dict) -> list[int]:
    """The places of two intervals that meet at a prefix of ``common`` words;
    notes the maximal pairs that are runs."""
    if len(one) < len(two):
        one, two = two, one
    for x in two:
        k = bisect_left(one, x)
        for y in one[max(0, k - 1):k + 1]:
            gap = abs(x - y)
            if common + gap >= MIN_EXPONENT * gap and common + gap >= MIN_LENGTH and left[x] != left[y]:
                key = (min(x, y), common + gap)
                found[key] = min(gap, found.get(key, gap))
    if len(two) < 8:
        for x in two:
            insort(one, x)
    else:
        one.extend(two)
        one.sort()
    return one


def _runs_of(order: list[int], lcp: list[int], left: np.ndarray) -> dict[tuple[int, int], int]:
    """``(start, length) -> period`` from suffixes in order; ``lcp[i]`` is the
    common prefix with the suffix before, 0 where a new tree begins."""
    found: dict[tuple[int, int], int] = {}
    open_: list[tuple[int, list[int]]] = []
    for i in range(len(order)):
        after = lcp[i + 1] if i + 1 < len(order) else 0
        node = [order[i]]
        while open_ and open_[-1][0] > after:
            common, places = open_.pop()
            node = _join(places, node, common, left, found)
        if after:
            if open_ and open_[-1][0] == after:
                common, places = open_.pop()
                node = _join(places, node, common, left, found)
            open_.append((after, node))
    return found


def find_runs(documents: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """``(start, length, period)`` of every run of each document (64-bit word
    hashes), by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    sizes = np.array([len(d) for d in documents], np.int64)
    n = int(sizes.sum())
    if not n:
        return out
    whole, of = np.concatenate(documents), np.repeat(np.arange(len(documents)), sizes)
    begins = np.cumsum(sizes) - sizes
    # a run holds its first words again: words met once in a document split it and start nothing
    by = np.lexsort((whole, of))
    new = np.ones(n, bool)
    new[1:] = (whole[by[1:]] != whole[by[:-1]]) | (of[by[1:]] != of[by[:-1]])
    words = np.empty(n, np.int64)
    words[by] = np.cumsum(new)
    ends = (begins + sizes)[of]
    order, levels = suffix_levels(words, ends)
    lcp = np.zeros(n, np.int64)
    pairs = np.flatnonzero((of[order[1:]] == of[order[:-1]]) & (words[order[1:]] == words[order[:-1]])) + 1
    lcp[pairs] = common_prefixes(order[pairs - 1], order[pairs], ends, levels)
    lcp[lcp < MIN_LENGTH - 1] = 0     # the shortest run that counts shares so many words with itself
    left = np.concatenate([[0], words[:-1]])
    left[begins[sizes > 0]] = -1
    keep = (lcp > 0) | np.concatenate([lcp[1:] > 0, [False]])
    order, lcp = order[keep], lcp[keep]
    for (start, length), period in _runs_of(order.tolist(), lcp.tolist(), left).items():
        out[of[start]].append((start - int(begins[of[start]]), length, period))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay: those behind a run's first period go."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def _groups(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    at = size = 0
    for i, t in enumerate(texts):
        if i > at and size + len(t) > GROUP_BYTES:
            yield at, i
            at, size = i, 0
        size += len(t)
    if at < len(texts):
        yield at, len(texts)


def periodic_runs(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns of ``docs`` (with ``text``) and ``n_words``,
    ``runs`` (start, length, period in words, by start, then period) and
    ``collapsed``: the words joined by single spaces, without those behind any
    run's first period.

    Words are what lies between ASCII white space.  A run is a stretch with
    smallest period ``q`` of at least ``max(6, 4 q)`` words that cannot be
    extended.  Every row is judged alone and returned; a null, empty or blank
    text has no words, no runs and the empty collapsed text.  Nothing is
    shuffled.
    """
    schema = docs.select(*carry).schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode("utf-8", "surrogatepass") for t in strings(batch, "__text")]
            counts, found, collapsed = [], [], []
            for a, b in _groups(texts):
                hashes = [word_hashes(t) for t in texts[a:b]]
                for text, h, runs in zip(texts[a:b], hashes, find_runs(hashes)):
                    words = text.split()
                    if runs:
                        words = [w for w, k in zip(words, kept_words(len(words), runs).tolist()) if k]
                    counts.append(len(h))
                    found.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                    collapsed.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in carry], pa.array(counts, pa.int64()), pa.array(found, kind), pa.array(collapsed, pa.string())],
                names=[*carry, "n_words", "runs", "collapsed"])
    ship_package(docs.sparkSession)
    return docs.select(*carry, docs["text"].alias("__text")).mapInArrow(run, f"{fields}, n_words bigint, runs array<{RUN}>, collapsed string")
