"""Token ids in binary files: range asymmetric numeral coding with one shared
frequency table, independent interleaved blocks, checkpoints and checksums.

A folder holds ``table.freq`` (the shared table) and ``<number>.rans`` files,
numbered in the order of the documents' ids.  A file is

* a header: magic, the table's checksum;
* blocks of whole documents: header, document ids and lengths, lane states,
  the word stream; the header holds checksums of the block and of its ids;
* a footer of checkpoints: place, size, ids before it in the file and ids of
  every block.

A reader takes the footers first and then decodes any block alone.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowlab.llm import range_coder
from flowlab.llm.common import partitions, release, saved, ship_package, strings
from flowlab.llm.range_coder import FrequencyTable
from flowlab.llm.word_ids import piece_tokenizer
from flowlab.session import scratch_path

BLOCK_TOKENS = 1 << 18
END_ID = 2
TABLE, SUFFIX = "table.freq", ".rans"
_FILE = struct.Struct("<8sI")           # magic, table checksum
_BLOCK = struct.Struct("<4sQQQQII")     # magic, ids, documents, lanes, words, checksum of ids, of the body
_POINT = struct.Struct("<QQQQ")         # place, size, ids before it, ids
_TAIL = struct.Struct("<QI8s")          # checkpoints, their checksum, magic
_MAGIC = b"RANSIDS1"


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def place(uri: str):
    """File system and path of a URI that driver and executors share."""
    from pyarrow import fs
    if uri.startswith("file:/"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def _put(uri: str, data: bytes) -> None:
    files, path = place(uri)
    files.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with files.open_output_stream(path) as out:
        out.write(data)


@lru_cache(maxsize=4)
def _table(folder: str) -> FrequencyTable:
    files, path = place(f"{folder}/{TABLE}")
    with files.open_input_stream(path) as src:
        return FrequencyTable.from_bytes(src.read())


def encode_block(doc_ids: list[int | None], ids: list[np.ndarray], table: FrequencyTable) -> bytes:
    tokens = np.concatenate(ids)
    states, words = range_coder.encode(tokens, table, range_coder.lanes_for(len(tokens)))
    body = b"".join([
        np.array([d is not None for d in doc_ids], np.uint8).tobytes(),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array([len(x) for x in ids], "<u8").tobytes(),
        states.astype("<u8").tobytes(), words.astype("<u4").tobytes()])
    return _BLOCK.pack(b"RBLK", len(tokens), len(ids), len(states), len(words),
                       zlib.crc32(tokens.astype("<u4").tobytes()), zlib.crc32(body)) + body


def decode_block(data: bytes, table: FrequencyTable) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """``document ids, lengths, ids`` of a block, both checksums held against it."""
    magic, n, docs, lanes, words, of_ids, of_body = _BLOCK.unpack_from(data)
    body = memoryview(data)[_BLOCK.size:]
    if magic != b"RBLK" or len(body) != 17 * docs + 8 * lanes + 4 * words or zlib.crc32(body) != of_body:
        raise ValueError("damaged block")
    at = 9 * docs
    named, names = np.frombuffer(body, np.uint8, docs), np.frombuffer(body, "<i8", docs, docs)
    lengths = np.frombuffer(body, "<u8", docs, at).astype(np.int64)
    states = np.frombuffer(body, "<u8", lanes, at + 8 * docs)
    ids = range_coder.decode(n, states, np.frombuffer(body, "<u4", words, at + 8 * docs + 8 * lanes), table)
    if zlib.crc32(ids.astype("<u4").tobytes()) != of_ids or int(lengths.sum()) != n:
        raise ValueError("damaged block")
    return [int(v) if k else None for k, v in zip(named, names)], lengths, ids


class _Writer:
    """One file under a name of its own until it is whole: a repeated or
    second attempt of a task replaces it by the same bytes."""

    def __init__(self, folder: str, number: int, table: FrequencyTable):
        self.files, base = place(folder)
        self.final, self.temporary = f"{base}/{number:08d}{SUFFIX}", f"{base}/_{number:08d}-{uuid.uuid4().hex}"
        self.out, self.table = self.files.open_output_stream(self.temporary), table
        self.at = self.size = 0
        self.points, self.docs, self.ids, self.held = [], [], [], 0
        self._write(_FILE.pack(_MAGIC, table.checksum))

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if self.ids and self.held + len(ids) > BLOCK_TOKENS:
            self._flush()
        self.docs.append(doc_id)
        self.ids.append(ids)
        self.held += len(ids)

    def _flush(self) -> None:
        if self.ids:
            block = encode_block(self.docs, self.ids, self.table)
            self.points.append((self.size, len(block), self.at, self.held))
            self._write(block)
            self.at += self.held
            self.docs, self.ids, self.held = [], [], 0

    def close(self) -> tuple[str, int, int]:
        self._flush()
        body = b"".join(_POINT.pack(*p) for p in self.points)
        self._write(body + _TAIL.pack(len(self.points), zlib.crc32(body), _MAGIC))
        self.out.close()
        self.files.move(self.temporary, self.final)
        return self.final, self.at, self.size


def checkpoints(uri: str, folder: str) -> list[tuple[int, int, int, int]]:
    """``place, size, ids before it, ids`` of each block of a file."""
    files, path = place(uri)
    with files.open_input_file(path) as src:
        size = src.size()
        magic, of_table = _FILE.unpack(src.read(_FILE.size))
        src.seek(size - _TAIL.size)
        n, crc, end = _TAIL.unpack(src.read(_TAIL.size))
        src.seek(max(0, size - _TAIL.size - n * _POINT.size))
        body = src.read(n * _POINT.size)
    if magic != _MAGIC or end != _MAGIC or zlib.crc32(body) != crc or of_table != _table(folder).checksum:
        raise ValueError(f"damaged token file {uri}")
    return list(_POINT.iter_unpack(body))


def tokenized(docs: DataFrame, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """``doc_id, row, wide, ids``: ids with ``end_id`` behind, 16 bits each
    unless ``wide``; and one row per task whose ``counts`` (ids, then counts,
    64 bits each) are those of its texts."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = piece_tokenizer(path, True)
        wide, end, total = tokenizer.dtype != "<u2", np.array([end_id], tokenizer.dtype).tobytes(), np.zeros(0, np.int64)

        def rows(doc_id: pa.Array, row: pa.Array, ids: list[bytes], counts: bytes | None) -> pa.RecordBatch:
            n = len(ids)
            return pa.RecordBatch.from_arrays(
                [doc_id, row, pa.array([wide] * n, pa.bool_()), pa.array(ids, pa.binary()), pa.array([counts] * n, pa.binary())],
                names=["doc_id", "row", "wide", "ids", "counts"])
        for batch in batches:
            ids = [b + end for b in tokenizer.encode(strings(batch, "text"))]
            part = np.bincount(np.frombuffer(b"".join(ids), tokenizer.dtype))
            if len(part) > len(total):
                total = np.concatenate([total, np.zeros(len(part) - len(total), np.int64)])
            total[:len(part)] += part
            yield rows(batch.column("doc_id"), batch.column("row"), ids, None)
        used = np.flatnonzero(total)
        yield rows(pa.array([None], pa.int64()), pa.array([None], pa.int64()), [b""], np.concatenate([used, total[used]]).astype("<i8").tobytes())
    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.monotonically_increasing_id().alias("row"), "text")
    return rows.mapInArrow(run, "doc_id bigint, row bigint, wide boolean, ids binary, counts binary")


def _ids(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(raw, "<u4" if wide else "<u2")
            for raw, wide in zip(batch.column("ids").to_pylist(), batch.column("wide").to_pylist())]


def frequency_table(tokens: DataFrame, bits: int = range_coder.BITS) -> FrequencyTable:
    """The shared table, from the counts over all ids.  At most one row per
    entry of the vocabulary reaches the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("counts").to_pylist():
                ids, n = np.frombuffer(raw, "<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n)], names=["id", "n"])
    counts = (tokens.filter("counts is not null").select("counts").mapInArrow(run, "id bigint, n bigint")
              .groupBy("id").agg(F.sum("n").alias("n")).collect())
    return FrequencyTable.from_counts(np.array([r.id for r in counts], np.int64), np.array([r.n for r in counts], np.int64), bits)


def write_token_files(docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Encode all texts and write them below ``folder`` (shared by driver and
    executors); returns ``file, n_tokens, n_bytes`` of each file.

    ``doc_id`` is a whole number; documents are written in its order, null
    ids first, rows that repeat an id one after the other.  A null or empty
    text is the end id alone.  An empty table gives a folder with an empty
    frequency table and no files.  An added token's string inside a text is
    that token, as in a plain call of the library.

    Texts are tokenized once, with their counts on the side, and written; the
    ids are range-sorted by ``(doc_id, row)``, and each range is one file.  A
    task holds one block at a time.
    """
    spark = docs.sparkSession
    tokens = saved(tokenized(docs, vocabulary, end_id), "ids-tokens", compression="zstd")
    table = frequency_table(tokens)
    _put(f"{folder}/{TABLE}", table.to_bytes())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            writer = writer or _Writer(folder, TaskContext.get().partitionId(), _table(folder))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), _ids(batch)):
                writer.add(doc_id, ids)
        if writer:
            name, n, size = writer.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64()), pa.array([size], pa.int64())],
                                             names=["file", "n_tokens", "n_bytes"])
    order = [F.col("doc_id").asc_nulls_first(), F.col("row")]
    ranges = (tokens.filter("counts is null").select("doc_id", "row", "wide", "ids")
              .repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order))
    files = saved(ranges.mapInArrow(write, "file string, n_tokens bigint, n_bytes bigint"), "ids-files")
    release(spark, tokens)
    return files


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` (little-endian unsigned 32-bit) of
    every document in a folder of token files, in parallel over blocks.

    ``start`` counts the ids of all documents before.  Damaged files raise.
    """
    ship_package(spark)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", f"*{SUFFIX}").load(folder).select("path")

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("path").to_pylist():
                points = checkpoints(uri, folder)
                cols = list(zip(*points)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array([uri] * len(points), pa.string()), *[pa.array(c, pa.int64()) for c in cols]],
                                                 names=["file", "place", "size", "before", "n"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(folder)
        for batch in batches:
            for uri, at, size, first in zip(*(batch.column(c).to_pylist() for c in ("file", "place", "size", "first"))):
                files, path = place(uri)
                with files.open_input_file(path) as src:
                    src.seek(at)
                    names, lengths, ids = decode_block(src.read(size), table)
                cut = np.concatenate([[0], np.cumsum(lengths)])
                raw = memoryview(ids.astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int64()), pa.array(first + cut[:-1], pa.int64()), pa.array(lengths, pa.int64()),
                     pa.array([raw[4 * a:4 * b] for a, b in zip(cut, cut[1:])], pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"])
    points = saved(listed.mapInArrow(footers, "file string, place bigint, size bigint, before bigint, n bigint"), "ids-points")
    number = F.substring_index("file", "/", -1)
    so_far = W.orderBy("name").rowsBetween(W.unboundedPreceding, -1)     # one row per file
    firsts = (points.groupBy(number.alias("name")).agg(F.sum("n").alias("n"))
              .select("name", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("first")))
    placed = points.withColumn("name", number).join(firsts, "name").select("file", "place", "size", (F.col("first") + F.col("before")).alias("first"))
    return placed.repartition(partitions(spark), "file", "place").mapInArrow(blocks, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def token_round_trip(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Write ``docs`` to a folder of its own and read it back."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-files")
    write_token_files(docs, folder, vocabulary)
    return read_token_files(spark, folder)
