"""Nulls in any column, empty and very long texts, ties, repeated rows, empty
tables and extra columns whose names the operators use themselves."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlab.llm import (chat_format, html_extract, jaccard_join, packing, quality_rank, quality_rules,
                         sentencepiece_codec, span_dedup, topk, url_filter)

PASSAGE = " ".join(f"word{i}" + ("," if i % 6 == 5 else "") for i in range(30)) + "."
LONG = " ".join(f"term{i % 997}" for i in range(60_000))
ROWS = [(None, PASSAGE), (1, PASSAGE + " More of it."), (2, None), (3, ""), (4, " \n\t \n"), (5, LONG), (6, PASSAGE), (6, PASSAGE),
        (7, "one"), (8, "   ü 😀\r\n")]
#: Names that the operators use for their own columns, in and out.
CLASHES = ["row", "n", "sigs", "node", "part", "ids", "n_pieces", "word", "h1", "start", "last", "ranges", "first", "n_sentences",
           "n_removed", "score", "kept", "clean_text", "n_words", "text_key", "curve", "at", "component_id", "leader", "q_m", "g"]
MODEL = quality_rank.RankModel(np.zeros(quality_rank.WIDTH), 0.0, 1.0)
BY_DOCUMENT = {
    "spans": span_dedup.remove_repeats,
    "jaccard": jaccard_join.jaccard_components,
    "rules": quality_rules.quality_rules,
    "rank": lambda d: quality_rank.score_quality(d, MODEL),
    "pieces": sentencepiece_codec.encode,
    "pack": packing.pack,
}


def _clashing(df):
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def docs(spark):
    return _clashing(spark.createDataFrame(ROWS, "doc_id bigint, text string"))


@pytest.mark.parametrize("name", sorted(BY_DOCUMENT))
def test_empty_tables_give_no_rows(docs, name):
    assert BY_DOCUMENT[name](docs.filter("doc_id < -1")).collect() == []


def test_spans_of_edge_rows(docs):
    got = span_dedup.remove_repeats(docs).collect()
    assert len(got) == len(ROWS) and set(CLASHES) <= set(got[0].asDict())
    by = {r.doc_id: r for r in got}
    assert by[None].text == PASSAGE and by[1].text == " More of it." and by[6].text == ""  # null ids come first
    assert by[2].text is None and by[3].text == "" and by[4].text == " \n\t \n" and by[5].text == LONG


def test_jaccard_of_edge_rows(docs):
    got = jaccard_join.jaccard_components(docs).collect()
    # 27 shingles against 30 with the same 27: 90 % of the union
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.leader) for r in got if r.doc_id in (None, 1, 6)) == \
        sorted([(0, 27, 1, False), (1, 30, 1, True), (6, 27, 1, False), (6, 27, 1, False)])
    rest = {r.doc_id: (r.n_shingles, r.component_id, r.leader) for r in got if r.doc_id not in (None, 1, 6)}
    assert rest[2] == (0, 2, True) and rest[3] == (0, 3, True) and rest[4] == (0, 4, True) and rest[7] == (1, 7, True)
    assert rest[5] == (997, 5, True)


def test_rules_and_scores_of_edge_rows(docs):
    got = {r.doc_id: r for r in quality_rules.quality_rules(docs).collect()}
    assert got[2].n_words == 0 and got[2].base_failed and not got[2].kept and got[2].clean_text == ""
    assert got[4].word_chars == 0 and got[5].n_words == 60_000 and got[5].n_repeat_words == 60_000 and got[8].n_words == 3
    scores = quality_rank.score_quality(docs, MODEL).collect()
    assert len(scores) == len(ROWS) and all(r.score == 0.5 and r.predicted == 1 for r in scores)


def test_packing_of_edge_rows(docs):
    pieces = packing.pack(docs).collect()
    assert sum(p.doc_id == 6 and p.start == 0 for p in pieces) == 2 and sum(p.doc_id is None for p in pieces) == 1
    for i in (2, 3):
        assert [(p.length, np.frombuffer(bytes(p.ids), "<u4").tolist()) for p in pieces if p.doc_id == i] == [(1, [1])]
    long = sorted((p.start, p.length) for p in pieces if p.doc_id == 5)
    assert all(a + n == b for (a, n), (b, _) in zip(long, long[1:])) and all(p.offset + p.length <= 2048 for p in pieces)


def test_pieces_round_trip_of_edge_rows(docs):
    back = sentencepiece_codec.decode(sentencepiece_codec.encode(docs)).collect()
    assert sorted(((r.doc_id or 0), r.text) for r in back) == sorted((i or 0, t or "") for i, t in ROWS)


def test_pages_of_edge_rows(spark):
    schema = "page_id bigint, url string, html string"
    rows = [(None, None, "<p>x</p>"), (1, "no scheme", ""), (2, "http://h/a", None), (3, "http://h/b", "<p>" + LONG + "</p>"),
            (3, "http://h/b", "<p>" + LONG + "</p>")]
    pages = spark.createDataFrame(rows, schema).select("*", *[F.lit("x").alias(c) for c in ("row", "host", "path", "rule", "verdict", "lines")])
    got = html_extract.extract_main_text(pages).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == \
        [(0, "x", 1), (1, "", 0), (2, "", 0), (3, LONG, len(LONG)), (3, LONG, len(LONG))]
    assert html_extract.extract_main_text(pages.limit(0)).collect() == []
    none = pages.limit(0).select("url")
    judged = url_filter.filter_urls(pages, none).collect()
    assert len(judged) == 5 and {r.verdict for r in judged} == {"allow"} and {r.rule for r in judged} == {None}
    assert sorted((r.host, r.path) for r in judged) == [("", ""), ("", ""), ("h", "/a"), ("h", "/b"), ("h", "/b")]
    listed = pages.select(url_filter.canonical_url(F.col("url")))
    assert sorted(r.verdict for r in url_filter.filter_urls(pages, listed).collect()) == ["allow"] * 2 + ["block"] * 3
    assert url_filter.filter_urls(pages.limit(0), listed).collect() == []


def test_turns_of_edge_rows(spark):
    rows = [(None, None, None, None), (1, 1, "user", "b"), (1, 1, "user", "a"), (1, 1, "user", "a"), (2, 0, "assistant", LONG)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string").withColumn("position", F.lit("x"))
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_turns(turns)).collect()}
    assert got[None].n_turns == 1 and got[None].loss_chars == 0 and not got[None].in_order
    assert got[1].n_turns == 3 and got[2].loss_chars == len(LONG)
    assert chat_format.read_back(chat_format.format_turns(turns.limit(0))).collect() == []


def test_vectors_of_edge_rows(spark):
    rows = [(None, [1.0]), (0, [1.0, None]), (50, []), (100, [1.0, 2.0]), (7, [1.0, 2.0]), (8, [1.0, 2.0]), (8, [1.0, 2.0]),
            (9, [float("inf"), 0.0])]
    v = topk.integer_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("score", F.lit("x")), scale=1)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(v.filter("vec_id % 50 = 0"), v, 3).collect())
    assert got == [(50, 1, 7, 0), (50, 2, 8, 0), (50, 3, 8, 0), (100, 1, 7, 5), (100, 2, 8, 5), (100, 3, 8, 5)]
    assert topk.top_k(v.limit(0), v.limit(0), 3).collect() == []


@pytest.mark.parametrize("page, text", [
    ('<main class="site-main has-sidebar"><p>Main text.</p></main>', ["Main text."]),
    ('<article class="post comment-open"><p>A</p><p class="share-price">B</p><div class="share">c</div><p class="advert">d</p></article>', ["A", "B"]),
    ('<article><p>A</p></article><section class="comments"><article class="comment">no</article></section>', ["A"]),
    ('<article><p>A</p></article><article class="comment"><p>no</p></article>', ["A"]),
    ('<body><div class="search-page"><p>Only text.</p></div><nav>menu</nav></body>', ["Only text."]),
    ('<div class="ad">x</div><p>y</p>', ["y"])])
def test_marks_never_take_the_main_text(page, text):
    assert [t for t, kind in html_extract.page_lines(page) if kind != html_extract.DROPPED] == text


def test_large_finite_vectors_are_searched(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [1e9, 1.0]), (4, [2.0 ** 22, 3.0]), (5, [0.5, -1e9]), (6, [1.0, 1.0])]
    vectors = topk.integer_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    got = topk.top_k(vectors, vectors, k=5).collect()
    held = {i: [min(max(int(np.floor(256 * x)), -2 ** 63), 2 ** 63 - 1) for x in v] for i, v in rows}
    for i in held:
        want = sorted((-min(max(sum(a * b for a, b in zip(held[i], held[j])), -topk.LARGEST), topk.LARGEST), j) for j in held if j != i)
        assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == i] == [(j, -s) for s, j in want]


def test_spans_of_texts_that_share_an_id_or_have_none(spark):
    rows = [(None, PASSAGE + " A."), (None, PASSAGE + " B."), (7, PASSAGE + " C."), (7, PASSAGE + " D."), (8, "Head. " + PASSAGE)]
    for part in (rows, rows[2:], rows[:2]):
        got = span_dedup.remove_repeats(spark.createDataFrame(part, "doc_id bigint, text string")).collect()
        assert sum(PASSAGE in r.text for r in got) == 1 and len(got) == len(part)
        assert all(r.doc_id == min((x[0] for x in part), key=lambda d: (d is not None, d or 0)) for r in got if PASSAGE in r.text)
