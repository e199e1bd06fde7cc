"""Line-first quality rules.

Every line is judged by itself (end punctuation, navigation, boilerplate,
symbols, shouting), failing lines are removed, and a document that loses too
much of its text is rejected.  A base rule on the whole document (too few
words, too many repeated 8-word windows) rejects as well.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from flowlab.llm.common import map_batches, strings

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
MAX_LOST_PCT = 50      # a document keeps its place while it loses at most this share of its word characters

# Line patterns, shared with the SQL form (one dialect: both engines read them alike).
END_MARK = r"[.!?:;…。！？][\"'”’»)\]]*([\x20\x09-\x0D]|$)"
BOILERPLATE = ("all rights reserved", "cookie policy", "cookie settings", "cookie consent", "accept cookies",
               "accept all cookies", "privacy policy", "terms of use", "terms of service", "enable javascript",
               "lorem ipsum", "sign in to", "sign up for", "click here", "subscribe to our", "skip to content",
               "skip to main content")
NAVIGATION = "|»›•·"
LONG_LINE = 8          # from this many words on, a line without any sentence end is no prose
_END = re.compile(END_MARK)
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))


def _count(data: bytes, chars: bytes) -> int:
    return len(data) - len(data.translate(None, chars))


def line_fails(line: str, data: bytes, n_words: int, chars: int) -> bool:
    """True if a line with at least one word is to be removed.  ``data`` is
    its UTF-8 form, ``chars`` its code points outside white space."""
    if n_words >= LONG_LINE and not _END.search(line):
        return True
    if 10 * _count(data, SYMBOLS.encode()) > chars or sum(map(line.count, NAVIGATION)) > 1:
        return True
    upper = _count(data, _UPPER)
    if upper >= 20 and upper > 2 * _count(data, _LOWER):
        return True
    low = line.lower()
    return any(phrase in low for phrase in BOILERPLATE)


def repeated_window_words(words: Sequence, window: int = WINDOW) -> int:
    """Words inside windows of ``window`` consecutive words that the text holds
    at least twice (the first one too).  ``window`` is a power of two.

    Distinct hashes of all windows prove that none repeats; otherwise windows
    are compared exactly, by doubling the ranks of shorter ones."""
    n = len(words)
    if n <= window:
        return 0
    ids: dict = {}
    rank = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    mixed = (rank.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    hashed = np.zeros(n - window + 1, np.uint64)
    for i in range(window):
        hashed = hashed * np.uint64(0xD6E8FEB86659FD93) + mixed[i:n - window + 1 + i]
    hashed.sort()
    if not (hashed[1:] == hashed[:-1]).any():
        return 0
    size = 1
    while size < window:
        pair = rank[:-size] * (int(rank.max()) + 1) + rank[size:]
        _, rank, counts = np.unique(pair, return_inverse=True, return_counts=True)
        size *= 2
    starts = np.flatnonzero(counts[rank] > 1)
    edge = np.zeros(n + 1, np.int64)
    edge[starts] += 1
    edge[starts + window] -= 1
    return int((np.cumsum(edge[:-1]) > 0).sum())


def judge(text: str) -> tuple[int, int, int, int, int, bool, bool, str, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, clean text, lost characters`` of one text."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # bytes split at exactly [\x20\x09-\x0D]
    n_words, word_chars = len(words), len(text) - _count(data, b" \t\n\r\x0b\x0c")
    dup = lost = 0
    seen, good = set(), []
    for line in text.split("\n"):
        raw = line.encode("utf-8", "surrogatepass")
        own = len(raw.split())
        if own:
            if line in seen:
                dup += 1
            seen.add(line)
            chars = len(line) - _count(raw, b" \t\r\x0b\x0c")
            if line_fails(line, raw, own, chars):
                lost += chars
                continue
        good.append(line)
    repeat = repeated_window_words(words)
    base_failed = n_words < MIN_WORDS or 100 * repeat > MAX_REPEAT_PCT * n_words
    kept = not base_failed and 100 * lost <= MAX_LOST_PCT * word_chars
    return (n_words, word_chars, _count(data, SYMBOLS.encode()), dup, repeat, base_failed, kept,
            "\n".join(good), lost)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCHEMA = (", ".join(f"{m} bigint" for m in MEASURES)
          + ", base_failed boolean, kept boolean, clean_text string, lost_chars bigint")


def quality_rules(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row of ``docs``: the carried columns, the measures,
    ``base_failed``, ``kept``, ``clean_text`` (the text without its failing
    lines) and ``lost_chars``.

    A null or empty text has no words and fails the base rule.  Repeated rows
    are judged each; columns not carried are not read.  No row depends on
    another, so nothing is shuffled; a batch of texts is held at a time.
    """
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*carry).schema]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [judge(t) for t in strings(batch, text)]
        cols = list(zip(*rows)) if rows else [()] * 9
        types = [pa.int64()] * 5 + [pa.bool_(), pa.bool_(), pa.string(), pa.int64()]
        kept = [batch.column(c) for c in carry]
        return pa.RecordBatch.from_arrays(kept + [pa.array(c, t) for c, t in zip(cols, types)],
                                          names=[*carry, *MEASURES, "base_failed", "kept", "clean_text", "lost_chars"])
    return map_batches(docs.select(*dict.fromkeys([*carry, text])), run, ", ".join(fields) + ", " + SCHEMA)
