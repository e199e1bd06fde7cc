"""Periodic runs against brute force."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowlab.llm import runs
from flowlab.llm.jaccard_join import word_hashes

SF = "/root/testdata/sf0.001"


def _brute(words):
    """Every maximal stretch of each period; the smallest period of a stretch."""
    n, best = len(words), {}
    for q in range(1, n // 4 + 1):
        s = 0
        for i in range(q, n + 1):
            if i == n or words[i] != words[i - q]:
                if i - s >= max(6, 4 * q):
                    best.setdefault((s, i - s), q)
                s = i - q + 1
    return sorted(((s, n, q) for (s, n), q in best.items()), key=lambda r: (r[0], r[2]))


def _collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


words_ = st.lists(st.sampled_from("ab"), max_size=60)


@given(st.lists(st.tuples(st.lists(st.sampled_from("abc"), max_size=8), st.integers(1, 9)), max_size=5), words_)
@settings(max_examples=300, deadline=None)
def test_runs_against_brute_force(parts, tail):
    words = [w for unit, times in parts for w in unit * times] + tail
    docs = [words, tail, [], words[::-1]]
    got = runs.find_runs([word_hashes(" ".join(d).encode()) for d in docs])
    assert got == [_brute(d) for d in docs]


@pytest.mark.parametrize("unit, times", [("a", 5000), ("a b", 2000), ("a b a a b", 900), ("a a b a a c", 500)])
def test_long_runs(unit, times):
    words = ("x " + f"{unit} " * times + "y").split()
    assert runs.find_runs([word_hashes(" ".join(words).encode())])[0][0] == (1, len(words) - 2, len(unit.split()))
    if times <= 500:
        assert runs.find_runs([word_hashes(" ".join(words).encode())])[0] == _brute(words)


def test_a_long_text_of_common_phrases_is_quick():
    rng = np.random.default_rng(5)
    words = " ".join(f"u{i} " + "the cat sat on the mat" * int(rng.integers(1, 3)) for i in range(30_000)).split()
    assert runs.find_runs([word_hashes(" ".join(words).encode())])[0] == []


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "go go go go go go"), (4, "go go go go go go"), (None, "a b\xa0c " * 9), (5, "x " * 5),
            (6, "lone " + "p q r " * 5 + "\r\n")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").select(
        "*", *[F.lit(1).alias(c) for c in ("runs", "n_words", "collapsed", "start", "length", "period", "__h")])
    got = runs.periodic_runs(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: ([tuple(x) for x in r.runs], r.collapsed, r.n_words) for r in got}
    assert by == {1: ([], "", 0), 2: ([], "", 0), 3: ([], "", 0), 4: ([(0, 6, 1)], "go", 6), 5: ([], "x x x x x", 5),
                  None: ([(0, 18, 2)], "a b\xa0c", 18), 6: ([(1, 15, 3)], "lone p q r", 16)}
    assert runs.periodic_runs(docs.filter("doc_id > 99")).collect() == []


def test_query_against_brute_force(spark):
    import __spark_entry__
    got = {r.doc_id: r for r in __spark_entry__.queries()["op12_periodic_runs"](spark, SF).collect()}
    source = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(source)
    for doc_id, text in source:
        words = re.findall("[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if n > 3000:
            continue
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found, r = _brute(words), got[doc_id]
        top = min(found, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r.n_runs, r.start, r.length, r.period) == (len(found), *top)
        assert r.exponent_milli == (1000 * top[1] // top[2] if found else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(_collapsed(words, found).encode()).hexdigest()
    assert sum(r.n_runs > 0 for r in got.values()) > 3
