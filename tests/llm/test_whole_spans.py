"""Span dedup against brute force over every run of several sentences."""

import random

from flowlab.llm import span_dedup
from test_pipeline import SENTENCE


def _covered(docs):
    """``(doc, sentence)`` in any run of two sentences and 20 words or more that stands earlier too."""
    places = {}
    for i, text in docs:
        kept = [(n, s.strip()) for n, s in enumerate(SENTENCE.findall(text)) if s.strip()]
        for a in range(len(kept)):
            for b in range(a + 2, len(kept) + 1):
                if sum(len(s.split()) for _, s in kept[a:b]) >= 20:
                    places.setdefault(tuple(s for _, s in kept[a:b]), []).append((i, kept[a][0], kept[b - 1][0]))
    return {(i, n) for found in places.values() for i, a, b in sorted(found)[1:] for n in range(a, b + 1)}


def _clause(name, words):
    return " ".join(f"{name}{i}" for i in range(words))


TAIL = f"{_clause('a', 1)}, {_clause('b', 10)}, {_clause('c', 12)}, {_clause('d', 3)}."


def _docs():
    rng = random.Random(5)
    clauses = [_clause(f"c{j}w", rng.choice([1, 2, 3, 5, 8, 10, 12, 25])) for j in range(6)]
    docs = [(0, TAIL), (1, "Other text. " + TAIL), (2, f"{_clause('b', 10)}, {_clause('c', 12)}, {_clause('d', 3)}.")]
    return docs + [(i, "".join(rng.choice(clauses) + ", " for _ in range(rng.randint(0, 14)))) for i in range(3, 60)]


def test_spans_cover_all_of_every_repeated_run(spark):
    docs = _docs()
    gone = _covered(docs)
    got = {r.doc_id: r for r in span_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert got[1].text == "Other text." and got[2].text == "" and len(gone) > 50
    for i, text in docs:
        pieces = SENTENCE.findall(text)
        assert got[i].text == "".join(s for n, s in enumerate(pieces) if (i, n) not in gone), i
        assert got[i].n_removed == sum((i, n) in gone for n in range(len(pieces)))
