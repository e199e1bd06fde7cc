"""The llm operators against brute force on a small fixture with nulls, empty
texts, repeated rows and extra columns."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlab.llm import (chat_format, html_extract, jaccard_join, packing, quality_rank, quality_rules,
                         sentencepiece_codec, span_dedup, topk, url_filter)

A = "One two three four five, six seven eight nine ten. Eleven twelve thirteen fourteen fifteen sixteen, seventeen eighteen nineteen twenty twentyone."
TEXTS = [(1, A + " Tail one."), (2, "Head. " + A), (3, None), (4, ""), (5, "Héllo  wörld\n <s> 😀"), (6, A + " Tail one."),
         (7, "a b c"), (7, "a b c"), (8, "w " * 30)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(TEXTS, "doc_id bigint, text string").withColumn("kept", F.lit("clash"))


def test_spans_keep_the_first_place(docs):
    got = {r.doc_id: r for r in span_dedup.remove_repeats(docs).collect()}
    assert got[1].n_removed == 0 and got[1].text == TEXTS[0][1] and got[1].kept == "clash"
    assert got[2].text == "Head." and got[6].n_removed > 0 and got[3].text is None and got[4].text == ""


def test_html_blocks_and_differencing(spark):
    page = "<nav>Menu</nav><article><h1>T &amp; x</h1><p>a\n b<div class='ad'>buy</div><p>c</article><footer>f</footer>"
    assert [t for t, k in html_extract.page_lines(page) if k == 0] == ["T & x", "a b", "c"]
    rows = [(1, "http://h/a/1", "<p>shared</p><p>one</p>"), (2, "http://h/a/2", "<p>shared</p><p>two</p>"),
            (3, None, None), (4, "http://o/x", page)]
    got = {r.page_id: r.text for r in html_extract.extract_main_text(
        spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {1: "one", 2: "two", 3: "", 4: "T & x\na b\nc"}


def test_lcs_positions():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = rng.integers(0, 4, rng.integers(0, 9)).tolist(), rng.integers(0, 4, rng.integers(0, 9)).tolist()
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        got = html_extract.shared_positions(a, b)
        it = iter(b)
        assert len(got) == t[-1][-1] and all(a[i] in it for i in got)


def test_packing_reads_added_tokens_as_the_library_does(spark):
    from tokenizers import Tokenizer
    tk = Tokenizer.from_file(packing.default_vocabulary())
    texts = ["a<|endoftext|>b <|startoftext|>", "<|endoftext|>"]
    got = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    assert {p.doc_id: np.frombuffer(p.ids, "<u4").tolist() for p in got} == \
        {i: tk.encode(t, add_special_tokens=False).ids + [1] for i, t in enumerate(texts)}


def test_packing_is_gapless_and_whole(docs):
    from tokenizers import Tokenizer
    tk = Tokenizer.from_file(packing.default_vocabulary())
    pieces = packing.pack(docs, length=16).collect()
    by_seq = {}
    for p in pieces:
        by_seq.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for s, parts in by_seq.items():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at == 16 or s == max(by_seq)
    for i, text in {i: t for i, t in TEXTS if i != 7}.items():
        own = sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.start)
        want = np.array(tk.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        assert b"".join(bytes(p.ids) for p in own) == want.tobytes()


def test_hilbert_neighbours_touch():
    cells = np.array([[x, y, z] for x in range(8) for y in range(8) for z in range(8)])
    key = packing.hilbert_key(cells, 3)
    assert sorted(key.tolist()) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def test_chat_round_trip(spark):
    rows = [(1, 0, "user", "</s>[INST] \\n <\\ x"), (1, 1, "assistant", "[/INST]\\"), (2, 0, "assistant", None), (2, 1, None, "<")]
    out = chat_format.format_turns(spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string"))
    t = chat_format.Template()
    parsed = sorted((r.conv_id, *t.parse("".join(s.text for s in r.segments)), r.in_order) for r in out.collect())
    assert parsed == [(1, "assistant", "[/INST]\\", True), (1, "user", "</s>[INST] \\n <\\ x", True),
                      (2, "", "<", False), (2, "assistant", "", False)]
    back = {r.conv_id: r for r in chat_format.read_back(out).collect()}
    assert back[1].loss_chars == 8 and back[1].in_order and not back[2].in_order


def test_top_k_with_ties(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(120)] + [(200, None), (201, [float("nan")] * 4)]
    v = topk.integer_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), scale=1)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(v.filter("vec_id % 20 = 0"), v, 5).collect())
    m, want = np.array([x for _, x in rows[:120]]), []
    for q in range(0, 120, 20):
        best = sorted((-int(m[q] @ m[j]), j) for j in range(120) if j != q)[:5]
        want += [(q, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    assert got == sorted(want)


def test_jaccard_components(spark):
    rng = np.random.default_rng(5)
    base = [" ".join(f"w{x}" for x in rng.integers(0, 500, 80)) for _ in range(4)]
    rows = []
    for i in range(60):
        words = base[i % 4].split()
        for _ in range(i % 5):
            words[rng.integers(0, 80)] = "edit"
        rows.append((i, " ".join(words)))
    rows += [(100, None), (101, "")]
    sets = {i: {tuple((t or "").split()[a:a + 4]) for a in range(max(0, len((t or "").split()) - 3))} for i, t in rows}
    own = {i: i for i in sets}
    for _ in range(len(sets)):
        for i, a in sets.items():
            for j, b in sets.items():
                if a and b and 100 * len(a & b) >= 85 * len(a | b):
                    own[i] = own[j] = min(own[i], own[j])
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(s), own[i]) for i, s in sets.items()}


def test_rules(docs):
    got = {r.doc_id: r for r in quality_rules.quality_rules(docs).collect()}
    assert got[1].kept and not got[8].kept and got[8].n_repeat_words == 30 and not got[3].kept
    words = "a b c d e f g h x a b c d e f g h".split()
    assert quality_rules.repeated_window_words(words) == 16


def test_rank_learns_held_out(spark):
    rows = [(i, ("Good prose, here. " if i % 2 else "junk ### | $$ ") * (3 + i % 7)) for i in range(200)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = d.filter("doc_id < 120").select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    scored = quality_rank.score_quality(d.filter("doc_id >= 120"), quality_rank.fit_quality(d, labels)).collect()
    assert all(r.predicted == r.doc_id % 2 for r in scored)
    assert quality_rank.fit_quality(d, labels.limit(0)).score(np.zeros((1, quality_rank.WIDTH)))[0] == 0.5


def test_url_rules_and_list(spark):
    pages = spark.createDataFrame([(1, "http://WWW.a.net/x/?utm_a=1#f"), (2, None), (3, "http://b.org/q"), (4, "https://c.net/"),
                                   (5, "noscheme")], "page_id int, url string")
    listed = spark.createDataFrame([("a.net/x",), (None,)], "u string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.filter_urls(pages, listed, [url_filter.Rule("org", "/", "block")]).collect()}
    assert got == {1: (None, "block"), 2: (None, "allow"), 3: ("org/", "block"), 4: (None, "allow"), 5: (None, "allow")}


@pytest.mark.parametrize("limit", [0, 1000])
def test_pieces_equal_the_library(docs, limit):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.default_model())
    enc = sentencepiece_codec.encode(docs, limit=limit)
    got = {r.doc_id: np.frombuffer(bytes(r.ids), "<u4").tolist() for r in enc.collect()}
    assert got == {i: sp.encode(t or "") for i, t in TEXTS}
    back = {r.doc_id: r.text for r in sentencepiece_codec.decode(enc).collect()}
    assert back == {i: t or "" for i, t in TEXTS}


def test_long_words_merge_alike():
    pieces, byte_ids, _ = sentencepiece_codec.piece_table(sentencepiece_codec.default_model())
    word = "▁" + re.sub(r"\W", "", A) * 2
    assert sentencepiece_codec.merge_long(word, pieces, byte_ids) == sentencepiece_codec.merge_word(word, pieces, byte_ids)


@pytest.mark.parametrize("percent", [80, 85])
def test_similar_sets_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    bands = jaccard_join.Bands(percent)
    for size in [2, 3, 5, 7, 9, 12, 20, 33, 60, 100, 250, 600, 2000] * 8:
        base = rng.integers(0, 2 ** 63, size * 2, dtype=np.int64).astype(np.uint64) * np.uint64(2)
        most = size * (100 - percent) // 100                        # elements left out of a set of this size
        out = int(rng.integers(0, most + 1))
        more = (size - out) * 100 // percent - size if out < most else 0
        a, b = base[:size], np.concatenate([base[out:size], base[size:size + max(0, more)]])
        common = size - out
        assert 100 * common >= percent * (len(a) + len(b) - common)
        sa, sb = (jaccard_join.signatures(np.sort(x), bands) for x in (a, b))
        assert out == more == 0 or set(sa.tolist()) & set(sb.tolist()), (size, out, more)


def test_schemes_hold_few_signatures_and_many_elements():
    for low in (5, 20, 100, 700, 5000):
        k = low * 25 // 100
        s = jaccard_join.Scheme(k, low)
        assert s.n1 - s.spare >= k // (s.k2 + 1) + 1 and len(s.subsets) == math.comb(s.n2, s.k2)
        assert s.n1 * len(s.subsets) <= 1.5 * max(jaccard_join.Scheme.LEAST, jaccard_join.Scheme.GROWTH * (k + 1))
        assert (s.n2 - s.k2) / (s.n1 * s.n2) > 0.9 / (k + 1)


def test_words_cut_where_no_piece_reaches_over():
    """The ids of a word's parts, one behind the other, are the library's."""
    import sentencepiece
    model = sentencepiece_codec.default_model()
    pieces, byte_ids, _ = sentencepiece_codec.piece_table(model)
    pattern = sentencepiece_codec.part_pattern(model)
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    texts = ["One, two.\nThree(four)x2y", "a²b m².c x³", "  two  blanks ", "▁mark", "\n\n\t.", "5 000€ été Größe", "日本a語 жук1жук", "e\u0301e\u0301.", "_a_b__c", "ªº ǅ ʰ ⅷ ½ ٣ ²"]
    for text in texts:
        parts = [p for w in sentencepiece_codec.split_words(text) for p in sentencepiece_codec.word_parts(w, pattern)]
        assert parts == [p for w in sentencepiece_codec.split_words(text) for p in pattern.findall(w)]
        assert "".join(parts) == "▁" + text.replace(" ", "▁")
        assert [i for p in parts for i in sentencepiece_codec.merge_word(p, pieces, byte_ids)] == sp.encode(text)
    for a in pieces:
        if len(pattern.findall(a)) > 1:       # pieces of the cut vocabulary are never cut but before marks
            assert "▁" in a[1:]


@pytest.mark.parametrize("text", ["", " ", "  ", "a b", " a", "a ", "a  b", "a\nb c,", "a▁b c", "▁", "▁ a", "a   ▁ b  "])
def test_bare_words_are_the_words_less_a_mark(text):
    assert ["▁" + w for w in sentencepiece_codec.bare_words(text)] == sentencepiece_codec.split_words(text)


def test_forgotten_words_are_merged_again(monkeypatch):
    import sentencepiece
    model = sentencepiece_codec.default_model()
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    monkeypatch.setattr(sentencepiece_codec, "MAX_CACHED", 2)
    frequent = {"▁the": np.array(sp.encode("the"), "<u4").tobytes()}
    words = sentencepiece_codec.WordIds(model, frequent)
    for w in "the quick, brown the (fox) quick, the 12 dögs 😀 quick,".split():
        assert np.frombuffer(words[w], "<u4").tolist() == sp.encode(w)
        assert "the" in words and len(words) <= 3


def test_buckets_of_the_same_members_meet_once(spark):
    """A pair that shares many signatures meets in every bucket it shares;
    buckets of the same members are one."""
    rows = [(sig, node, 1 if node in (1, 2) else node) for sig, members in
            [(1, (1, 2, 3)), (2, (1, 2, 3)), (3, (3, 2, 1)), (4, (1, 2)), (5, (2, 3)), (6, (3, 4)), (7, (4, 3))] for node in members]
    mixed = jaccard_join._mixed_buckets(spark.createDataFrame(rows, "sig bigint, node bigint, own bigint"))
    assert sorted((r.sig, r.main) for r in mixed.collect()) == [(1, 1), (5, 3), (6, 4)]


def test_sets_just_under_the_threshold_do_not_leave_the_join(spark):
    """124 differences of 800 elements: too many for 80 %, which 256 bits of
    the sketch do not show; with 40 the pair stays."""
    rng = np.random.default_rng(3)
    pool = np.unique(rng.integers(0, 2 ** 63, 2000, dtype=np.int64).astype(np.uint64))
    near = {1: pool[:400], 2: np.sort(np.concatenate([pool[:338], pool[500:562]])), 3: np.sort(np.concatenate([pool[:380], pool[600:620]])),
            0: pool[1000:1400]}
    rows = [(7, 0, i, i, i != 0, len(h), *jaccard_join.sketch(h).tolist()) for i, h in near.items()]
    held = spark.createDataFrame(rows, "sig bigint, lead bigint, node bigint, own bigint, open boolean, n bigint, "
                                 + ", ".join(f"{w} bigint" for w in jaccard_join._WORDS))
    assert sorted(map(tuple, jaccard_join._meetings(held, 80).collect())) == [(1, 3)]
