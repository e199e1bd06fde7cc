"""Substring dedup on sentence spans.

Every run of consecutive sentences is hashed, equal runs meet in one global
join, and sentences covered by any occurrence but the first are removed.

A sentence ends at a full stop, comma, colon or line break, so that a passage
put into the middle of other text still holds whole sentences.  A run is two
consecutive sentences at least with ``MIN_WORDS`` words or more.  Hashed are
the shortest run from every sentence and the shortest run up to every sentence:
whether one is the shortest hangs on its own sentences alone, and together
those inside a longer run cover all of it, so that a longer repeated run loses
nothing.  Short common phrases give none.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlab.llm.common import map_batches, release, saved, strings

MIN_WORDS = 20
MIN_RUN = 2
#: A sentence with its end marks; the pieces of a text concatenate to it.  Java and Python read it alike.
SENTENCE = r"[^.!?,;:\n]*[.!?,;:\n]+|[^.!?,;:\n]+$"
_SENTENCE = re.compile(SENTENCE)


def sentences(text: Column) -> Column:
    """The text cut into sentences, without loss; null is the empty text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(SENTENCE), F.lit(0))


def runs(text: str, min_words: int = MIN_WORDS, min_run: int = MIN_RUN) -> list[tuple[int, int, bytes]]:
    """``(first, last, 128-bit hash)`` of the shortest runs from and up to every
    sentence, each run once, as positions in the cut text.  White space around
    sentences is left out, and sentences that are nothing else."""
    kept = [(i, w) for i, s in enumerate(_SENTENCE.findall(text)) if (w := s.strip())]
    reach = [0, *accumulate(len(w.split()) for _, w in kept)]
    found = {}
    for a in range(len(kept)):
        b = max(bisect_left(reach, reach[a] + min_words), a + min_run)
        if b > len(kept):
            break
        found[a, b] = None
    for b in range(min_run, len(kept) + 1):
        a = min(bisect_right(reach, reach[b] - min_words) - 1, b - min_run)
        if a >= 0:
            found[a, b] = None
    out = []
    for a, b in found:
        joined = "\n".join(w for _, w in kept[a:b])
        out.append((kept[a][0], kept[b - 1][0], hashlib.blake2b(joined.encode("utf-8", "surrogatepass"), digest_size=16).digest()))
    return out


def span_rows(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, text_key, start, last, h1, h2``, one row per run."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        of, start, last, digests = [], [], [], []
        for i, text in enumerate(strings(batch, "text")):
            for a, b, h in runs(text, min_words):
                of.append(i)
                start.append(a)
                last.append(b)
                digests.append(h)
        both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        of = pa.array(of, pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(of), batch.column("text_key").take(of), pa.array(start, pa.int32()),
             pa.array(last, pa.int32()), pa.array(both[:, 0]), pa.array(both[:, 1])],
            names=["doc_id", "text_key", "start", "last", "h1", "h2"])
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text"), run,
                       f"doc_id {id_type}, text_key bigint, start int, last int, h1 bigint, h2 bigint")


def covered_sentences(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, text_key, ranges``: the ranges ``[start, last]`` of runs whose
    first occurrence (smallest document id, then position) is elsewhere.

    A passage in very many documents is pre-aggregated before the shuffle; the
    join back reads two plain shuffles, which AQE splits where one run is hot.
    """
    spans = saved(span_rows(docs, min_words), "spans")
    shared = saved(docs.filter("doc_id is not null").groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("low"), F.max(F.xxhash64("text")).alias("high"))
                   .filter("low <> high").select("doc_id", F.lit(True).alias("shared")), "span-shared-ids")
    # an occurrence is known by id and position; by its text too where several texts have one id, or none
    whole = spans.withColumn("shared", F.lit(False)) if shared.isEmpty() else spans.join(shared, "doc_id", "left")
    several = F.col("doc_id").isNull() | F.coalesce("shared", F.lit(False))
    spans_of = whole.withColumn("which", F.when(several, F.col("text_key")).otherwise(0)).drop("shared")
    place = F.struct("doc_id", "which", "start")
    repeated = saved(spans_of.groupBy("h1", "h2")
                      .agg(F.min(place).alias("first"), F.max(place).alias("last_one"))
                      .filter("first <> last_one").select("h1", "h2", "first"), "span-firsts")
    ranges = saved(spans_of.join(repeated, ["h1", "h2"])
                    .filter(~F.col("first").eqNullSafe(place))
                    .groupBy("doc_id", "text_key")
                    .agg(F.sort_array(F.collect_set(F.struct(F.col("start"), F.col("last")))).alias("ranges")), "span-ranges")
    release(docs.sparkSession, spans, repeated, shared)
    return ranges


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with ``text`` cleaned and ``n_sentences``, ``n_removed`` added
    (columns of these names are replaced).

    Every row is returned.  A null text stays null with no sentences, an empty
    one stays empty.  A passage keeps its place in the document with the
    smallest id (null ids come first), at its first position; all other places
    lose every sentence a repeated run covers, also inside one document.  Rows
    that repeat id and text are one document and are treated alike; of texts
    that share an id, or have none, the one with the smallest hash comes first.  Only the
    ranges (a document's own sentences at most) meet the texts again, by id
    and text hash.
    """
    ranges = covered_sentences(docs, min_words).withColumnsRenamed({"doc_id": "__id", "text_key": "__key", "ranges": "__ranges"})
    base = docs.withColumn("__text_key", F.xxhash64("text"))
    on = base["doc_id"].eqNullSafe(ranges["__id"]) & (base["__text_key"] == ranges["__key"])
    pieces = sentences(F.col("text"))
    joined = base.join(ranges, on, "left").withColumn("__s", pieces)
    # one fold over the sorted ranges: kept pieces lie between the furthest end so far and the next start
    done = F.aggregate(
        F.coalesce("__ranges", F.array().cast("array<struct<start:int,last:int>>")),
        F.struct(F.lit(-1).alias("end"), F.array().cast("array<string>").alias("kept"), F.lit(0).alias("cut")),
        lambda a, r: F.struct(
            F.greatest(a["end"], r["last"]).alias("end"),
            F.when(r["start"] > a["end"] + 1,
                   F.concat(a["kept"], F.array(F.array_join(F.slice("__s", a["end"] + 2, r["start"] - a["end"] - 1), ""))))
            .otherwise(a["kept"]).alias("kept"),
            (a["cut"] + F.greatest(F.lit(0), r["last"] - F.greatest(a["end"], r["start"] - 1))).alias("cut")),
        lambda a: F.struct(
            F.concat(F.array_join(a["kept"], ""),
                     F.array_join(F.slice("__s", a["end"] + 2, F.greatest(F.lit(0), F.size("__s") - a["end"] - 1)), "")).alias("text"),
            a["cut"].alias("cut")))
    out = joined.withColumn("__done", F.when(F.col("__ranges").isNotNull(), done))
    cleaned = F.when(F.col("__ranges").isNull(), F.col("text")).otherwise(F.col("__done.text"))
    names = [c for c in docs.columns if c not in ("n_sentences", "n_removed")]
    return out.select(*[cleaned.alias("text") if c == "text" else base[c] for c in names],
                      F.size("__s").cast("bigint").alias("n_sentences"),
                      F.coalesce("__done.cut", F.lit(0)).cast("bigint").alias("n_removed"))
