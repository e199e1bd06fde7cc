"""Packing along a space-filling curve.

Each document's hashed token vector is projected to three dimensions, its
place on a Hilbert curve orders the documents, and the tokens are cut into
sequences in that order: neighbours on the curve share sequences.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.llm.common import map_batches, saved, strings
from flowlab.llm.ordering import range_slices, running_start
from flowlab.llm.word_ids import piece_tokenizer

SEQUENCE = 2048
DIMENSIONS, BITS = 3, 10
BUCKETS = 256


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of integer points (rows; one column per
    dimension, ``bits`` bits each), by undoing the reflections and exchanges of
    each level from the top and reading the Gray code off the result."""
    x = cells.T.astype(np.int64).copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(n):
            turned = (x[i] & bit) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flips = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flips ^= np.where(x[n - 1] & (1 << level), (1 << level) - 1, 0)
    x ^= flips
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> level) & 1
    return key


def curve_keys(ids: list[np.ndarray]) -> np.ndarray:
    """Hilbert keys of documents from their hashed, length-normalised token
    vectors, by a fixed random projection."""
    project = np.random.default_rng(3).normal(size=(BUCKETS, DIMENSIONS))
    project -= project.mean(axis=0)
    m = np.zeros((len(ids), BUCKETS))
    for i, x in enumerate(ids):
        m[i] = np.bincount((x.astype(np.int64) * 40503 >> 4) % BUCKETS, minlength=BUCKETS)
    m /= np.maximum(1e-9, np.linalg.norm(m, axis=1))[:, None]
    place = 1 / (1 + np.exp(-3 * (m @ project)))
    return hilbert_key(np.minimum((place * (1 << BITS)).astype(np.int64), (1 << BITS) - 1), BITS)


def tokenized(docs: DataFrame, vocabulary: str | None = None, end_id: int = 1) -> DataFrame:
    """``doc_id, row, curve, n, ids`` per row: ids (as bytes, 16 bits each if
    the vocabulary fits) with ``end_id`` behind, and the place on the curve.
    An added token's string inside a text is that token, as in a plain call
    of the library."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokenizer = piece_tokenizer(vocabulary or default_vocabulary(), False)
        end = np.array([end_id], tokenizer.dtype).tobytes()
        ids = [np.frombuffer(b + end, tokenizer.dtype) for b in tokenizer.encode(strings(batch, "text"))]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("row"), pa.array(curve_keys(ids), pa.int64()),
             pa.array([len(x) for x in ids], pa.int64()),
             pa.array([x.tobytes() for x in ids], pa.binary())],
            names=["doc_id", "row", "curve", "n", "ids"])
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    return map_batches(rows, run, f"doc_id {id_type}, row bigint, curve bigint, n bigint, ids binary")


def pack(docs: DataFrame, vocabulary: str | None = None, length: int = SEQUENCE, end_id: int = 1) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids`` (little-endian
    unsigned 32-bit), ``doc_tokens, sequence_id, offset``.

    Documents follow each other along the curve (ties by id, then row) and are
    cut wherever a sequence is full, so only the last sequence needs padding.
    A null or empty text is its end id alone.  Rows that repeat an id are
    packed each; null ids stay null.  An empty table gives no pieces.

    Texts are tokenized once and written; the global order works on
    (curve, id, count) rows, and the ids are shuffled once, by row.
    """
    tokens = saved(tokenized(docs, vocabulary, end_id), "pack-tokens")
    order = ["curve", "doc_id", "row"]
    sliced = range_slices(tokens.select("doc_id", "row", "curve", "n"), order, "pack-order")
    placed = saved(running_start(sliced, order, "n").select("row", F.col("__start").alias("at")), "pack-places")
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        of, rows = [], []
        for i, (n, at, raw) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("n", "at", "ids")))):
            ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4")
            start = 0
            while start < n:
                offset = (at + start) % length
                size = min(length - offset, n - start)
                of.append(i)
                rows.append((start, size, ids[start:start + size].tobytes(), n, (at + start) // length, offset))
                start += size
        cols = list(zip(*rows)) or [()] * 6
        types = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(of, pa.int64())), *[pa.array(c, t) for c, t in zip(cols, types)]],
            names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
    return map_batches(tokens.drop("curve").join(placed, "row"), run,
                       f"doc_id {id_type}, start bigint, length bigint, ids binary, doc_tokens bigint, "
                       "sequence_id bigint, offset bigint")


def piece_digests(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``ids`` replaced by ``ids_crc32``."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")

