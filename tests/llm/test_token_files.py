"""Token files against the tokenizers library, their coder and their damage."""

import os
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowlab.llm import range_coder, token_files, word_ids
from flowlab.llm.range_coder import FrequencyTable
from flowlab.session import scratch_path

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "  a", "a  b", "a   b\n\n c", "\ta\t b", "x\r\ny  z ", "foo\x1cbar !\x1c x", "caf\xe9\xa0\xa0 naïve 　 tail",
       "it's we'll 'd ' s", "12 345  !? ..  ", "a<|endoftext|>b <|endoftext|>  c", "\U0001f600 \U0001f600\U0001f600", "a  b  c\x85 d", "᠎ x ᠎"]


def _library(texts):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(token_files.default_vocabulary())
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def _expected(rows):
    """doc_id, start, n_tokens, ids_crc32 of rows in order."""
    out, at = [], 0
    for (doc, _), ids in zip(rows, _library([t or "" for _, t in rows])):
        ids = np.array([*ids, 2], "<u4")
        out.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


@given(st.lists(st.text(alphabet=" \n\t\r\xa0 \x1c\x85ab'!1\xe9\U0001f600", max_size=30), max_size=6))
@settings(max_examples=150, deadline=None)
def test_pieces_give_the_librarys_ids(texts):
    tokenizer = word_ids.piece_tokenizer(token_files.default_vocabulary(), True)
    texts = texts + ODD
    assert [np.frombuffer(b, tokenizer.dtype).tolist() for b in tokenizer.encode(texts)] == _library(texts)


def test_a_small_table_loses_nothing():
    tokenizer = word_ids.PieceTokenizer(token_files.default_vocabulary(), True, slot_bits=2)
    texts = [f"the w{i} of v{i % 7}, {'long' * 9 * (i % 3)}{'0x' * 30}{i}; the end." for i in range(60)] * 2
    assert [np.frombuffer(b, tokenizer.dtype).tolist() for b in tokenizer.encode(texts)] == _library(texts)


@pytest.mark.parametrize("name, spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_whole_table_against_the_library(spark, name, spaced):
    import public_tokenizers
    from tokenizers import Tokenizer
    texts = [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()] + ODD + ["\u00cf\u0301, \u0130x. \ufb01! \u00e9. \u00d7, \u00f7."]
    library = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer = word_ids.PieceTokenizer(public_tokenizers.path(name), spaced)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for size in (len(texts), 5):
        got = [b for a in range(0, len(texts), size) for b in tokenizer.encode(texts[a:a + size])]
        assert [np.frombuffer(b, tokenizer.dtype).tolist() for b in got] == want


@given(st.lists(st.integers(0, 40), min_size=1, max_size=400), st.integers(1, 9), st.integers(6, 20))
@settings(max_examples=60, deadline=None)
def test_coder_round_trip(values, lanes, bits):
    ids = np.array(values, np.int64) ** 3
    table = FrequencyTable.from_counts(*np.unique(ids, return_counts=True), bits)
    assert FrequencyTable.from_bytes(table.to_bytes()).slots.tolist() == table.slots.tolist()
    states, words = range_coder.encode(ids, table, lanes)
    assert range_coder.decode(len(ids), states, words, table).tolist() == ids.tolist()


def test_coder_is_near_the_entropy():
    rng = np.random.default_rng(1)
    ids = rng.geometric(0.02, 200_000) % 5000
    table = FrequencyTable.from_counts(*np.unique(ids, return_counts=True))
    states, words = range_coder.encode(ids, table, range_coder.lanes_for(len(ids)))
    p = np.unique(ids, return_counts=True)[1] / len(ids)
    assert 4 * len(words) + 8 * len(states) < 1.02 * (-(p * np.log2(p)).sum() * len(ids) / 8) + 8 * len(states) + 4096


def test_one_id_and_a_full_table():
    one = FrequencyTable.from_counts(np.array([7]), np.array([3]), 4)
    assert range_coder.decode(50, *range_coder.encode(np.full(50, 7), one, 3), one).tolist() == [7] * 50
    full = FrequencyTable.from_counts(np.arange(16), np.array([1000] + [1] * 15), 4)
    assert full.slots.tolist() == [1] * 16
    with pytest.raises(ValueError):
        FrequencyTable.from_counts(np.arange(17), np.ones(17), 4)
    with pytest.raises(ValueError):
        range_coder.encode(np.array([8]), one, 1)


def test_damage_is_found():
    ids = [np.arange(100) % 7, np.array([2])]
    table = FrequencyTable.from_counts(*np.unique(np.concatenate(ids), return_counts=True))
    block = token_files.encode_block([5, None], ids, table)
    names, lengths, got = token_files.decode_block(block, table)
    assert names == [5, None] and lengths.tolist() == [100, 1] and got.tolist() == [*ids[0], 2]
    for at in (0, 5, 50, len(block) - 1):
        with pytest.raises(ValueError):
            token_files.decode_block(block[:at] + bytes([block[at] ^ 1]) + block[at + 1:], table)
    data = table.to_bytes()
    with pytest.raises(ValueError):
        FrequencyTable.from_bytes(data[:-1] + bytes([data[-1] ^ 1]))


def _read(df):
    rows = df.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("crc")).collect()
    return sorted((tuple(r) for r in rows), key=lambda r: r[1])


def test_edge_rows_and_many_files(spark):
    long = " ".join(f"term{i % 997}" for i in range(40_000))
    rows = [(9, "tail"), (None, "unnamed"), (3, None), (4, ""), (-5, "minus"), (7, "same"), (7, "same"), (8, long),
            *[(100 + i, t) for i, t in enumerate(ODD)]]
    docs = spark.createDataFrame(rows, "doc_id int, text string").select(
        "*", *[F.lit(None).cast("string").alias(c) for c in ("row", "n", "ids", "file", "wide", "start", "counts", "first")])
    folder = scratch_path(spark, "files")
    files = token_files.write_token_files(docs, folder).collect()
    expected = _expected(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)))
    assert len(files) > 1 and sum(f.n_tokens for f in files) == sum(e[2] for e in expected)
    assert _read(token_files.read_token_files(spark, folder)) == expected
    assert sorted(f for f in os.listdir(token_files.place(folder)[1]) if f[0] not in "._") == sorted([f.file.rsplit("/")[-1] for f in files] + [token_files.TABLE])
    with open(files[0].file, "r+b") as f:
        f.seek(60)
        f.write(b"\xff\x00\xff")
    with pytest.raises(Exception, match="damaged"):
        token_files.read_token_files(spark, folder).collect()


def test_empty_table(spark):
    assert token_files.token_round_trip(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_query_against_the_library(spark):
    import __spark_entry__
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    got = __spark_entry__.queries()["op13_token_files"](spark, SF).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == _expected(rows)
