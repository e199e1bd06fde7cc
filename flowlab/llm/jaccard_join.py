"""N-gram Jaccard join by PartEnum signatures.

Sets fall into size bands.  Two sets with a similarity of at least the
threshold lie in the same or in neighbouring bands and differ in at most ``k``
elements.  The element domain is cut into partitions and those into parts;
some partition holds so few of the differences that both sets agree on all but
a few of its parts.  The hash of what a set holds of such a subset of parts is
a signature; every subset is enumerated, so both sets share one.  Sets that
share a signature are verified exactly.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import lru_cache
from itertools import combinations
from math import ceil, comb, exp, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.llm.common import map_batches, release, saved, strings
from flowlab.llm.components import components

WORDS = 4
PERCENT = 85
SIG_BITS = 48          # a chance collision of signatures only adds a candidate
SKETCH = 16            # 64-bit words of a set's parity sketch

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_BYTE = np.random.default_rng(11).integers(1, 2 ** 63, 256, dtype=np.int64).astype(_U) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text, without cutting it to strings: a
    word's hash is its share of a running polynomial over the bytes."""
    b = np.frombuffer(data, np.uint8)
    inside = ~_SPACE[b]
    edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(first):
        return np.zeros(0, _U)
    with np.errstate(over="ignore"):
        begin = np.zeros(len(b), np.int64)
        begin[first] = first
        place = np.arange(len(b)) - np.maximum.accumulate(begin)
        terms = np.where(inside, _BYTE[b] * _powers(int(place.max()) + 1)[place], _U(0))
        total = np.concatenate([np.zeros(1, _U), np.cumsum(terms, dtype=_U)])
        return _mix(total[end] - total[first] + (end - first).astype(_U))


def _powers(n: int) -> np.ndarray:
    size = 1 << max(6, (n - 1).bit_length())
    return _power_table(size)


@lru_cache(maxsize=8)
def _power_table(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.full(n, _BASE, _U)
        out[0] = 1
        return np.cumprod(out, dtype=_U)


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the text's ``words``-word
    shingles, A-Z in lower case; the whole sequence if it is shorter; none
    without words."""
    w = word_hashes(text.encode("utf-8", "surrogatepass").lower())  # bytes: lower-cases A-Z only
    if not len(w):
        return w
    size = min(words, len(w))
    with np.errstate(over="ignore"):
        h = np.full(len(w) - size + 1, size, _U)
        for i in range(size):
            h = _mix(h * _U(_BASE) + w[i:len(w) - size + 1 + i])
    return np.unique(h)


class Scheme:
    """PartEnum for sets of at least ``low`` elements that differ in at most
    ``k``.  The hash range is cut into ``n1`` partitions, each into ``n2``
    parts.  Of any ``k`` differences at most ``k2`` fall into some partition,
    so the sets agree on ``n2 - k2`` of its parts: every such subset of parts
    gives a signature.  ``spare`` partitions more than that needs leave as
    many out of the count.

    Among the schemes of at most ``max(LEAST, GROWTH * (k + 1))`` signatures
    the one whose signatures cover the most elements is taken: unlike sets
    seldom agree on many."""

    LEAST, GROWTH = 40, 1.5

    def __init__(self, k: int, low: int):
        best = None
        for k2 in range(min(k, 4) + 1):
            for n2 in range(k2 + 1, k2 + 5 if k2 else 2):
                ways, need = comb(n2, k2), k // (k2 + 1) + 1
                if need * ways > max(self.LEAST, self.GROWTH * (k + 1)):
                    continue
                spare = 0
                for _ in range(4):   # so many partitions have an empty subset, three deviations above the mean
                    n1 = need + spare
                    empty = n1 * min(1.0, ways * exp(-low * (n2 - k2) / (n1 * n2)))
                    spare = min(need // 3, ceil(empty + 3 * sqrt(empty)))
                covered = (n2 - k2) / ((need + spare) * n2)
                if best is None or covered > best[0]:
                    best = (covered, need + spare, n2, k2, spare)
        _, self.n1, self.n2, self.k2, self.spare = best
        self.subsets = np.array(list(combinations(range(self.n2), self.n2 - self.k2)))
        parts = self.n1 * self.n2
        self.edges = np.array([i * 2 ** 64 // parts for i in range(1, parts)], _U)


class Bands:
    """Size bands ``[low, high]`` with ``high = low / threshold^2``.  Of a pair
    the smaller set's band gives the signature scheme."""

    def __init__(self, percent: int = PERCENT):
        self.percent, self.lows, self.schemes, self.largest = percent, [1], [], []

    def _grow(self, size: int) -> None:
        while self.lows[-1] <= size:
            low, p = self.lows[-1], self.percent
            high = max(low, low * 10000 // (p * p))
            largest = high * 100 // p
            k = (high + largest) * (100 - p) // (100 + p)
            self.schemes.append(Scheme(k, low) if k else None)   # without differences sets are equal, and one node
            self.largest.append(largest)
            self.lows.append(high + 1)

    def of(self, size: int) -> list[tuple[int, Scheme]]:
        """The bands, with schemes, in which a set of this size may meet a
        different one."""
        self._grow(size)
        own = bisect_right(self.lows, size) - 1
        return [(b, self.schemes[b]) for b in (own - 1, own) if b >= 0 and self.schemes[b] and size <= self.largest[b]]


@lru_cache(maxsize=4)
def bands_of(percent: int) -> Bands:
    return Bands(percent)


def signatures(h: np.ndarray, bands: Bands) -> np.ndarray:
    """The signatures of a sorted set of 64-bit hashes.  A subset of parts
    that the set does not touch gives none, unless more partitions have such a
    subset than the scheme can spare: then two sets might agree on untouched
    parts alone."""
    out = []
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, _U), np.cumsum(_mix(h + _U(77)), dtype=_U)])
        for band, s in bands.of(len(h)):
            cut = np.concatenate([[0], np.searchsorted(h, s.edges), [len(h)]]).astype(np.int64)
            held = np.diff(cut).reshape(s.n1, s.n2)[:, s.subsets].sum(axis=2) > 0
            content = (total[cut[1:]] - total[cut[:-1]]).reshape(s.n1, s.n2)[:, s.subsets].sum(axis=2, dtype=_U)
            tag = np.arange(held.size).reshape(held.shape).astype(_U) + _U((band * 2 + 1) << 32)
            sig = _mix(content ^ _mix(tag))
            out.append(sig.ravel() if (~held).any(axis=1).sum() > s.spare else sig[held])
    return (np.concatenate(out) >> _U(64 - SIG_BITS)).astype(np.int64) if out else np.zeros(0, np.int64)


def sketch(h: np.ndarray, bits: int = 64 * SKETCH) -> np.ndarray:
    """One bit per hash bucket (``bits``, a power of two): the parity of the
    elements in it.  Two sets differ in at least as many elements as their
    sketches differ in bits.  A half of as many bits is the other half's XOR."""
    with np.errstate(over="ignore"):
        place = (_mix(h + _U(99)) & _U(bits - 1)).astype(np.int64)
    odd = (np.bincount(place, minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def wide_sketch(h: np.ndarray) -> bytes | None:
    """The sketch of at least as many bits as elements, of a set too large for
    ``SKETCH`` words."""
    return sketch(h, 1 << (len(h) - 1).bit_length()).tobytes() if len(h) > 64 * SKETCH else None


_WORDS = [f"w{i}" for i in range(SKETCH)]


def _features(docs: DataFrame, words: int, percent: int) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bands, n, f1, f2, short, wide, sigs = bands_of(percent), [], [], [], [], [], []
        with np.errstate(over="ignore"):
            for text in strings(batch, "text"):
                h = shingles(text, words)
                n.append(len(h))
                f1.append(int(_mix(h + _U(1)).sum(dtype=_U).astype(np.int64)))
                f2.append(int(_mix(h + _U(2)).sum(dtype=_U).astype(np.int64)))
                short.append(sketch(h))
                wide.append(wide_sketch(h))
                sigs.append(signatures(h, bands))
        short = np.array(short, np.int64).reshape(-1, SKETCH)
        values, at = np.concatenate([*sigs, np.zeros(0, np.int64)]), np.cumsum([0, *map(len, sigs)])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("row"), batch.column("text_key"), pa.array(n, pa.int64()),
             pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), *[pa.array(short[:, i]) for i in range(SKETCH)], pa.array(wide, pa.binary()),
             pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, pa.int64()))],
            names=["doc_id", "row", "text_key", "n", "f1", "f2", *_WORDS, "wide", "sigs"])
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), F.xxhash64("text").alias("text_key"), "text")
    return map_batches(rows, run, f"doc_id {id_type}, row bigint, text_key bigint, n bigint, f1 bigint, f2 bigint, "
                       + ", ".join(f"{w} bigint" for w in _WORDS) + ", wide binary, sigs array<bigint>")


def _shingle_sets(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """``node, h`` (hashes as bytes) for ``nodes`` (node, doc_id, text_key)."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(t, words).tobytes() for t in strings(batch, "text")]
        return pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], names=["node", "h"])
    keyed = docs.select(F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__key"), "text")
    on = F.col("__id").eqNullSafe(F.col("doc_id")) & (F.col("__key") == F.col("text_key"))
    # rows that repeat id and text give the same set
    return map_batches(keyed.join(nodes, on).select("node", "text"), run, "node bigint, h binary").dropDuplicates(["node"])


def _side(df: DataFrame, side: str, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(side if c == "node" else f"{side}_{c}") for c in columns])


def _may_link(percent: int):
    """No sketch and no size rules the pair ``a, b`` out."""
    first, *rest = (F.bit_count(F.col(f"a_{w}").bitwiseXOR(F.col(f"b_{w}"))) for w in _WORDS)
    differ = sum(rest, first)
    return ((100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n"))
            & (differ * (100 + percent) <= (F.col("a_n") + F.col("b_n")) * (100 - percent)))


def _mixed_buckets(member: DataFrame) -> DataFrame:
    """``sig, main`` of the buckets of ``member`` (sig, node, own) that hold
    more than one component ``own``; ``main`` is the largest.  Buckets of the
    same members would give the same pairs: one of them stands for all.  They
    are told by their size and four sums over 32-bit hashes of the members."""
    prints = [f"p{i}" for i in range(4)]
    hashes = [F.xxhash64("node", F.lit(i)).bitwiseAND(F.lit(2 ** 32 - 1)) for i in range(4)]
    sizes = member.groupBy("sig", "own").agg(F.count("*").alias("size"), *[F.sum(h).alias(p) for h, p in zip(hashes, prints)])
    whole = sizes.groupBy("sig").agg(F.max_by("own", F.struct("size", "own")).alias("main"), F.count("*").alias("parts"),
                                     F.sum("size").alias("members"), *[F.sum(p).alias(p) for p in prints])
    return whole.filter("parts > 1").groupBy("main", "members", *prints).agg(F.min("sig").alias("sig")).select("sig", "main")


def _meetings(held: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` of members of a bucket in different components, one
    of them open, that sizes and sketches leave possible; ``held`` is ``sig,
    lead, node, own, open, n`` and the sketch's words."""
    in_join = ["node", "own", "open", "n", *_WORDS]
    left = _side(held.filter("open"), "a", ["sig", "lead", *in_join]).withColumnRenamed("a_sig", "sig")
    right = _side(held, "b", ["sig", *in_join]).withColumnRenamed("b_sig", "sig")
    untested = (F.col("a") != F.col("a_lead")) & (F.col("b") != F.col("a_lead"))
    return (left.join(right, "sig")
            .filter((F.col("a_own") != F.col("b_own")) & untested & (~F.col("b_open") | (F.col("a") < F.col("b"))))
            .filter(_may_link(percent)).select("a", "b"))


def _fold(bits: np.ndarray, size: int) -> np.ndarray:
    while len(bits) > size:
        bits = bits[:len(bits) // 2] ^ bits[len(bits) // 2:]
    return bits


def _not_told_apart(pairs: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` that wide sketches (of two large sets) leave possible."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for x, y, n in zip(*(batch.column(c).to_pylist() for c in ("a_wide", "b_wide", "n"))):
            if x is not None and y is not None:
                x, y = np.frombuffer(x, _U), np.frombuffer(y, _U)
                size = min(len(x), len(y))
                differ = int(np.bitwise_count(_fold(x, size) ^ _fold(y, size)).sum())
                keep.append(differ * (100 + percent) <= n * (100 - percent))
            else:
                keep.append(True)
        return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    large = bits.filter("wide is not null")
    whole = (pairs.join(_side(large, "a", ["node", "n", "wide"]), "a", "left")
             .join(_side(large, "b", ["node", "n", "wide"]), "b", "left"))
    return map_batches(whole.select("a", "b", "a_wide", "b_wide", (F.col("a_n") + F.col("b_n")).alias("n")), run, "a bigint, b bigint")


def _verified(docs: DataFrame, known: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose sets reach the threshold, by exact counts.  Only
    the sets of these pairs are built; ``known`` is ``node, doc_id, text_key``."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for x, y in zip(batch.column("a_h").to_pylist(), batch.column("b_h").to_pylist()):
            x, y = np.frombuffer(x, _U), np.frombuffer(y, _U)
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * common >= percent * (len(x) + len(y) - common))
        return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = saved(_shingle_sets(docs, known.join(ends, "node"), words), "jac-sets")
    whole = pairs.join(_side(sets, "a", ["node", "h"]), "a").join(_side(sets, "b", ["node", "h"]), "b")
    links = saved(map_batches(whole.select("a", "b", "a_h", "b_h"), run, "a bigint, b bigint"), "jac-links")
    release(docs.sparkSession, sets)
    return links


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, text_key, leader`` per row: the set
    size, the smallest id reachable over links (similarity at least
    ``percent`` / 100), a hash of the text, and whether the row is the one of
    its component with the smallest id (of rows that repeat it, the first).

    A null or empty text has the empty set and no links: its component is its
    own id and it leads.  Rows of equal sets are one node from the start, so a
    large group of copies is never compared.  Null ids are carried and come
    last; a component of null ids only has a null id.

    1. Signatures that at least two different sets share form buckets.
    2. Each bucket's members are compared with its smallest member only; most
       of a group of near copies is one component after that.
    3. In every bucket, members outside its largest component are compared
       with the members of other components.  Of buckets with the same
       members only one is kept.
    Pairs whose sizes or parity sketches (1,024 bits) prove too many
    differences are left out inside that join, those of larger sets by wider
    sketches after it.  Sets are built for the other pairs only, anew from the
    texts.  No group is collected and no bucket gives all its pairs; no link
    between sets of different components is left out.
    """
    spark = docs.sparkSession
    features = saved(_features(docs, words, percent), "jac-features", "zstd")
    nodes = saved(features.filter("n > 0").groupBy("f1", "f2", "n").agg(F.min("row").alias("node")), "jac-nodes")
    own = ["n", *_WORDS, "wide"]
    kept = saved(features.select("row", *own, "sigs").join(nodes.select(F.col("node").alias("row")), "row"), "jac-sigs", "zstd")
    rows = saved(features.select("doc_id", "row", "text_key", "n", "f1", "f2"), "jac-rows")
    release(spark, features)
    sigs = kept.select(F.explode("sigs").alias("sig"), F.col("row").alias("node"))
    shared = saved(sigs.groupBy("sig").agg(F.min("node").alias("lead"), F.max("node").alias("last"))
                   .filter("lead <> last").select("sig", "lead"), "jac-shared")
    buckets = saved(sigs.join(shared, "sig"), "jac-buckets")
    bits = saved(kept.select(F.col("row").alias("node"), *own), "jac-bits")
    release(spark, kept, shared)

    known = rows.select(F.col("row").alias("node"), "doc_id", "text_key")
    short = ["node", "n", *_WORDS]
    first = buckets.filter(F.col("node") != F.col("lead")).select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
    met = saved(first.join(_side(bits, "a", short), "a").join(_side(bits, "b", short), "b")
                .filter(_may_link(percent)).select("a", "b"), "jac-met")
    pairs = saved(_not_told_apart(met, bits, percent), "jac-pairs")
    links = _verified(docs, known, pairs, words, percent)
    release(spark, met, pairs)

    labels = components(links)
    member = saved(buckets.join(labels, "node", "left")
                   .select("sig", "lead", "node", F.coalesce("component", "node").alias("own")), "jac-members")
    mixed = saved(_mixed_buckets(member), "jac-mixed")
    held = saved(member.join(mixed, "sig").withColumn("open", F.col("own") != F.col("main")).drop("main")
                 .join(bits.select(*short), "node"), "jac-held")
    release(spark, buckets, member)
    met = saved(_meetings(held, percent).distinct(), "jac-met")
    release(spark, held)
    pairs = saved(_not_told_apart(met, bits, percent), "jac-pairs")
    more = _verified(docs, known, pairs, words, percent)
    release(spark, bits, met, pairs)
    labels = saved(components(links.unionByName(more)), "jac-labels")

    of_node = nodes.join(labels, "node", "left").select("f1", "f2", "n", F.coalesce("component", "node").alias("part"))
    placed = saved(rows.select("doc_id", "row", "text_key", "n", "f1", "f2").join(of_node, ["f1", "f2", "n"], "left")
                   .select("doc_id", "row", "text_key", "n", "part"), "jac-placed")
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    least = saved(placed.filter("part is not null").groupBy("part").agg(F.min(rank).alias("first")), "jac-least")
    return placed.join(least, "part", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("part").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        "text_key", F.coalesce(F.col("row") == F.col("first.row"), F.lit(True)).alias("leader"))
