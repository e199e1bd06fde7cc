"""SentencePiece encoding and decoding over a relational lattice.

The words of the corpus, cut where no piece can reach over, are counted; for
the frequent parts all substrings of bounded length are exploded, an equi-join with the piece table leaves the
lattice's edges, and a fold over each word's edges gives its pieces.  The
vocabulary is a BPE one, whose segmentation is defined by merges, not by the
best sum of scores: the fold therefore merges the best adjacent pair of edges
at each step instead of keeping Viterbi's best path.

The word table that texts look words up in has a fixed bound; words beyond it
go through the same merges inside the task, so every text is encoded whole.
"""

from __future__ import annotations

import math
import re
import struct
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import repeat
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.llm.common import map_batches, saved, ship_package, strings

SPACE = "▁"
MAX_TABLE = 100_000    # words of the broadcast table
MAX_CACHED = 100_000   # words a task remembers beside it
MAX_LETTERS = 40       # code points of a word that may enter it
LONG_WORD = 200        # code points beyond which a word's merges go through a heap
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_LETTER = r"[^\W\d_²³¹]"    # raised digits are no letters
_PART = re.compile(f"{SPACE}*{_LETTER}+|{SPACE}*(?:(?!{_LETTER})[^{SPACE}])+|{SPACE}+")


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def piece_table(model: str) -> tuple[dict[str, tuple[int, float]], tuple[int, ...], tuple[bytes, ...]]:
    """Pieces that merges may form, the ids of the 256 byte pieces, and the
    bytes of every id (control pieces give none)."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    ordinary, byte_ids, out = {}, [0] * 256, []
    for i in range(sp.vocab_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            value = int(piece[3:5], 16)
            byte_ids[value] = i
            out.append(bytes([value]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            out.append(b"")
        else:
            ordinary[piece] = (i, sp.get_score(i))
            out.append(piece.replace(SPACE, " ").encode())
    return ordinary, tuple(byte_ids), tuple(out)


@lru_cache(maxsize=2)
def part_pattern(model: str) -> re.Pattern:
    """What a word is cut by.  Where no piece of the vocabulary holds a letter
    beside another character, no merge can join the two: a word's ids are then
    those of its letters and of what stands between, and far fewer different
    parts than words are left.  Otherwise a word is one part."""
    letter = re.compile(_LETTER)
    for piece in piece_table(model)[0]:
        for a, b in zip(piece, piece[1:]):
            if a != SPACE and bool(letter.match(a)) != bool(letter.match(b)):
                return _WORD
    return _PART


def split_words(text: str) -> list[str]:
    """The marked words of a text: blanks become marks, one is put in front;
    no piece reaches over the start of a run of marks."""
    return _WORD.findall(SPACE + text.replace(" ", SPACE)) if text else []


def bare_words(text: str) -> list[str]:
    """The words of ``split_words`` without the mark that each begins with.
    Most texts have single blanks inside only and are cut at them; others
    need the runs of marks told apart."""
    if not text:
        return []
    if "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
        return [w[1:] for w in split_words(text)]
    return text.split(" ")


def word_parts(word: str, pattern: re.Pattern) -> list[str]:
    """The parts of a marked word; one of letters alone is never cut."""
    return [word] if word.lstrip(SPACE).isalpha() else pattern.findall(word)


def merge_word(word: str, pieces: dict, byte_ids: tuple) -> list[int]:
    """Ids of one word: the best-scored adjacent pair is merged until none is
    a piece, leftmost first; a character that is no piece gives its bytes."""
    out = []
    for p in merged_parts(word, lambda pair, none: pieces.get(pair, (0, none))[1]):
        out += merge_word_piece(p, pieces, byte_ids)
    return out


def merged_parts(word: str, score: Callable[[str, float], float]) -> list[str]:
    """The strings that a word's characters are merged to; ``score`` gives a
    piece's score, its second argument for what is no piece."""
    none, parts = -math.inf, list(word)
    scores = list(map(score, map(add, parts, parts[1:]), repeat(none)))
    while scores and (best := max(scores)) > none:
        i = scores.index(best)
        parts[i] = joined = parts[i] + parts.pop(i + 1)
        del scores[i]
        if i < len(scores):
            scores[i] = score(joined + parts[i + 1], none)
        if i:
            scores[i - 1] = score(parts[i - 1] + joined, none)
    return parts


def word_counts(docs: DataFrame, model: str) -> DataFrame:
    """``word, n`` of the parts of words over all texts; counted inside each
    task, with at most ``2 * MAX_TABLE`` words and a batch's at a time, before
    the shuffle."""
    ship_package(docs.sparkSession)

    def rows(words: Counter) -> pa.RecordBatch:
        c, pattern = Counter(), part_pattern(model)
        for w, n in words.items():
            for part in word_parts(SPACE + w, pattern):
                c[part] += n
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Counter = Counter()
        for batch in batches:
            for t in strings(batch, "text"):
                c.update(bare_words(t))
            if len(c) > 2 * MAX_TABLE:
                yield rows(c)
                c.clear()
        if c:
            yield rows(c)
    return docs.select("text").mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, limit: int = MAX_TABLE) -> DataFrame:
    """The words from the smallest count on at which there are at most
    ``limit``; found on a histogram of (logarithms of) counts."""
    short = counts.filter(F.length("word") <= MAX_LETTERS)
    level = F.floor(F.log2("n") * 8)
    histogram = sorted(short.groupBy(level.alias("level")).agg(F.count("*").alias("words"), F.min("n").alias("least")).collect(),
                       key=lambda r: -r.level)
    total, least = 0, None
    for r in histogram:
        if (total := total + r.words) > limit:
            break
        least = r.least
    return short.filter(F.lit(False) if least is None else F.col("n") >= least).select("word")


def lattice_encode(words: DataFrame, model: str) -> DataFrame:
    """``word, ids`` (array) of distinct words: substrings of bounded length
    joined to the piece table, edges grouped by word, merges as a fold."""
    spark = words.sparkSession
    pieces, byte_ids, _ = piece_table(model)
    longest = max(map(len, pieces))
    # a vocabulary of fixed size: broadcast is bounded by it
    table = F.broadcast(spark.createDataFrame([(p, i, s) for p, (i, s) in pieces.items()], "piece string, id int, score double"))
    size = F.length("word")
    starts = words.select("word", F.posexplode(F.split("word", "")).alias("start", "letter")).filter(F.col("letter") != "")
    spans = starts.select("word", "start", F.explode(F.sequence(
        F.lit(1), F.least(F.lit(longest), size - F.col("start")))).alias("length"))
    edges = spans.withColumn("piece", F.col("word").substr(F.col("start") + 1, F.col("length"))).join(table, "piece", "left")
    edge = F.struct((F.col("start") * 64 + F.col("start") + F.col("length")).alias("key"), F.struct("id", "score").alias("v"))
    grouped = (edges.filter(F.col("id").isNotNull() | (F.col("length") == 1)).groupBy("word")
               .agg(F.collect_list(F.when(F.col("id").isNotNull(), edge)).alias("edges")))
    grouped = grouped.withColumn("lattice", F.map_from_entries("edges"))

    def step(cuts, _):
        pairs = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(cuts) - 3)), lambda i: F.struct(
            F.try_element_at("lattice", F.get(cuts, i) * 64 + F.get(cuts, i + 2))["score"].alias("score"), (-i).alias("i")))
        best = F.array_max(F.filter(pairs, lambda p: p["score"].isNotNull()))
        return F.when((F.size(cuts) < 3) | best.isNull(), cuts).otherwise(F.filter(cuts, lambda c, i: i != F.lit(1) - best["i"]))
    cuts = F.aggregate(F.sequence(F.lit(1), size), F.sequence(F.lit(0), size), step)
    utf8 = F.array(*[F.lit(b) for b in byte_ids])

    def ids_of(cuts):
        def piece(i):
            found = F.try_element_at("lattice", F.get(cuts, i) * 64 + F.get(cuts, i + 1))["id"]
            code = F.hex(F.encode(F.col("word").substr(F.get(cuts, i) + 1, F.get(cuts, i + 1) - F.get(cuts, i)), "UTF-8"))
            raw = F.transform(F.sequence(F.lit(1), (F.length(code) / 2).cast("int")), lambda k: F.get(
                utf8, F.conv(code.substr(2 * k - 1, F.lit(2)), 16, 10).cast("int")))
            return F.when(found.isNotNull(), F.array(found)).otherwise(raw)
        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(cuts) - 2), piece))
    folded = grouped.withColumn("cuts", cuts)
    return folded.select("word", ids_of(F.col("cuts")).alias("ids"))


def encode(docs: DataFrame, model: str | None = None, limit: int = MAX_TABLE, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns with ``n_pieces`` and ``ids`` (little-endian
    unsigned 32-bit, as bytes) per row.

    A null or empty text has no pieces.  Repeated rows are encoded each; words
    are counted over all rows.  Nothing but word counts is shuffled.
    """
    spark: SparkSession = docs.sparkSession
    model = model or default_model()
    frequent = saved(frequent_words(saved(word_counts(docs, model), "piece-words"), limit), "piece-frequent")
    rows = lattice_encode(frequent, model).collect()  # at most ``limit`` words
    known = spark.sparkContext.broadcast({r.word: np.array(r.ids, "<u4").tobytes() for r in rows})
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*carry).schema]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = _word_ids(model, known).__getitem__
        out = [b"".join(map(ids, bare_words(t))) for t in strings(batch, "text")]
        return pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in carry], pa.array([len(b) // 4 for b in out], pa.int64()), pa.array(out, pa.binary())],
            names=[*carry, "n_pieces", "ids"])
    return map_batches(docs.select(*dict.fromkeys([*carry, "text"])), run, ", ".join(fields) + ", n_pieces bigint, ids binary")


class WordIds(dict):
    """Ids (as bytes) by word without its first mark.  Words of the table are
    there from the start; another is merged when it is first met, and of those
    at most ``MAX_CACHED`` are remembered."""

    def __init__(self, model: str, table: dict[str, bytes]):
        self.pieces, self.byte_ids, _ = piece_table(model)
        self.pattern, self.table = part_pattern(model), table
        self.scores = {p: s for p, (_, s) in self.pieces.items()}
        self.packed = {p: struct.pack("<I", i) for p, (i, _) in self.pieces.items()}
        self._refill()

    def _refill(self) -> None:
        self.clear()
        self.update((w[1:], ids) for w, ids in self.table.items() if w.startswith(SPACE))
        self.most = len(self) + MAX_CACHED

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.most:
            self._refill()
        out = b""
        for part in word_parts(SPACE + word, self.pattern):
            out += self.table.get(part) or self._merged(part)
        self[word] = out
        return out

    def _merged(self, part: str) -> bytes:
        if len(part) > LONG_WORD:
            ids = merge_long(part, self.pieces, self.byte_ids)
            return struct.pack(f"<{len(ids)}I", *ids)
        packed = self.packed
        return b"".join([packed[p] if p in packed else self._utf8(p) for p in merged_parts(part, self.scores.get)])

    def _utf8(self, letter: str) -> bytes:
        return b"".join([struct.pack("<I", self.byte_ids[b]) for b in letter.encode("utf-8", "surrogatepass")])


_filled: dict = {}   # of the last broadcast table in this process


def _word_ids(model: str, known: Broadcast) -> WordIds:
    table = known.value
    if _filled.get("table") is not table or _filled["model"] != model:
        _filled.update(table=table, model=model, words=WordIds(model, table))
    return _filled["words"]


def merge_long(word: str, pieces: dict, byte_ids: tuple) -> list[int]:
    """``merge_word`` with a heap, for words of any length."""
    import heapq
    parts, n = list(word), len(word)
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    heap: list = []

    def offer(i: int) -> None:
        j = after[i]
        if i >= 0 and j >= 0 and (found := pieces.get(parts[i] + parts[j])) is not None:
            heapq.heappush(heap, (-found[1], i, len(parts[i]), len(parts[j])))
    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if j < 0 or len(parts[i]) != a or len(parts[j]) != b or not a:
            continue
        parts[i], parts[j] = parts[i] + parts[j], ""
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        after[j] = -1
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    return [x for p in parts if p for x in merge_word_piece(p, pieces, byte_ids)]


def merge_word_piece(p: str, pieces: dict, byte_ids: tuple) -> list[int]:
    found = pieces.get(p)
    return [found[0]] if found is not None else [byte_ids[b] for b in p.encode("utf-8", "surrogatepass")]


def decode(encoded: DataFrame, model: str | None = None, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns with the ``text`` of ``ids``: the pieces' bytes
    joined, without the blank put in front; bytes that are no UTF-8 give
    replacement characters.  A mark in a text comes back as a blank."""
    model = model or default_model()
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(*carry).schema]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        _, _, out = piece_table(model)
        texts = [b"".join(map(out.__getitem__, np.frombuffer(b or b"", "<u4").tolist()))[1:].decode("utf-8", "replace")
                 for b in batch.column("ids").to_pylist()]
        return pa.RecordBatch.from_arrays([*[batch.column(c) for c in carry], pa.array(texts, pa.string())], names=[*carry, "text"])
    return map_batches(encoded.select(*dict.fromkeys([*carry, "ids"])), run, ", ".join(fields) + ", text string")
