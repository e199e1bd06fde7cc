"""The pipeline against brute force with near copies by five-word shingles and
every repeated run of sentences."""

import numpy as np

import corpus_pipeline
from conftest import SF_SMALL
from flowlab.llm import packing, quality_rank
from flowlab.llm.queries import fitted_quality
from test_pipeline import SENTENCE, WORD, _rules
from test_whole_spans import _covered


def _one_of_each(docs):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = {i: WORD.findall(t.translate(low)) for i, t in docs.items()}
    sets = {i: {tuple(w[a:a + 5]) for a in range(max(1, len(w) - 4))} if w else set() for i, w in words.items()}
    own = {i: i for i in docs}
    links = [(i, j) for i in docs for j in docs if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    for _ in docs:
        for i, j in links:
            own[i] = own[j] = min(own[i], own[j])
    return {i: t for i, t in docs.items() if own[i] == i}


def test_near_copies_between_the_thresholds_go(spark):
    base = " ".join(f"word{i}" for i in range(40))
    # with 8 words more: 36 of 44 five-word shingles shared (0.82), 37 of 45 four-word ones (0.82 < 0.85)
    rows = [(1, base), (2, base + "".join(f" more{i}" for i in range(8))), (3, base + "".join(f" else{i}" for i in range(12)))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [r.doc_id for r in corpus_pipeline.jaccard_stage(spark, docs, SF_SMALL).collect()]
    assert sorted(got) == sorted(_one_of_each(dict(rows))) == [1, 3]


def test_pipeline_keeps_no_repeat(spark):
    from tokenizers import Tokenizer
    source = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    docs = {r.doc_id: c for r in source if (c := _rules(r.text or "")) is not None}
    model = fitted_quality(spark, SF_SMALL)
    docs = _one_of_each({i: t for i, t in docs.items() if model.score(quality_rank.features(t)) >= 0.5})
    gone = _covered(sorted(docs.items()))
    docs = {i: "".join(s for n, s in enumerate(SENTENCE.findall(t)) if (i, n) not in gone) for i, t in docs.items()}
    tokenizer = Tokenizer.from_file(packing.default_vocabulary())
    got, places = {}, {}
    for p in sorted(corpus_pipeline.run(spark, SF_SMALL).collect(), key=lambda p: (p.doc_id, p.start)):
        got.setdefault(p.doc_id, []).append(bytes(p.ids))
        places.setdefault(p.sequence_id, []).append((p.offset, p.length))
    want = {i: np.array(tokenizer.encode(t, add_special_tokens=False).ids + [1], "<u4").tobytes() for i, t in docs.items()}
    for s, parts in places.items():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
        assert sum(parts[-1]) == 2048 or s == max(places)
    assert len(source) > len(docs) > 20
    assert gone and {i: b"".join(x) for i, x in got.items()} == want
