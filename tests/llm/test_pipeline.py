"""The pipeline's stages against brute force over a whole small table, and on
edge rows."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
from flowlab.llm import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SENTENCE = re.compile(r"[^.!?,;:\n]*[.!?,;:\n]+|[^.!?,;:\n]+$")


def _line_fails(line):
    words = WORD.findall(line)
    chars, low = sum(map(len, words)), line.lower()
    upper, lower = len(re.findall("[A-Z]", line)), len(re.findall("[a-z]", line))
    return bool(words) and (
        len(words) >= quality_rules.LONG_LINE and not re.search(quality_rules.END_MARK, line)
        or 10 * len(re.findall(r"[#*$%&|<>]", line)) > chars or len(re.findall("[|»›•·]", line)) > 1
        or upper >= 20 and upper > 2 * lower or any(p in low for p in quality_rules.BOILERPLATE))


def _rules(text):
    words = WORD.findall(text)
    count = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    again = {j for i in range(len(words) - 7) if count[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = text.split("\n")
    bad = [line for line in lines if _line_fails(line)]
    lost, total = (sum(len(w) for line in part for w in WORD.findall(line)) for part in (bad, lines))
    keep = len(words) >= 20 and 100 * len(again) <= 30 * len(words) and 100 * lost <= quality_rules.MAX_LOST_PCT * total
    return "\n".join(line for line in lines if not _line_fails(line)) if keep else None


GOOD = " ".join(f"This is plain sentence number {i} of an ordinary text about things." for i in range(12))
EDGES = [(1, GOOD), (2, GOOD), (2, GOOD), (2, GOOD[::-1].replace("\n", " ")), (None, GOOD + " End."), (None, "one two three"), (3, None),
         (4, ""), (5, "one two three")]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame([(i, t, None, None, len(t or "")) for i, t in EDGES],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint").withColumn("leader", F.lit("x"))


def test_stages_of_edge_rows(spark, edges):
    rules, _, jaccard, spans, _ = [fn for _, fn in corpus_pipeline.STAGES]
    kept = rules(spark, edges, SF_SMALL)
    assert kept.columns == edges.columns and {3, 4, 5}.isdisjoint(r.doc_id for r in kept.collect())
    one = jaccard(spark, edges, SF_SMALL)
    assert one.columns == edges.columns
    # of the copies the smallest id stays; a second text of a repeated id is another document
    assert sorted((r.doc_id or 0, r.text or "") for r in one.collect()) == sorted(
        [(1, GOOD), (2, EDGES[3][1]), (3, ""), (4, ""), (5, "one two three")])
    assert spans(spark, one, SF_SMALL).count() == 5


def test_stages_of_an_empty_table(spark, edges):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, edges.limit(0), SF_SMALL).collect() == [], name
