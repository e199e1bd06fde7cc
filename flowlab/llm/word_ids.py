"""Token ids of texts through the ids of their pieces.

Tokenizers of the kinds used here never join characters across certain places:
where white space follows other text, and where a punctuation mark follows a
letter.  The pieces between them have the same ids in every text.  A worker
finds the pieces of many texts at once, looks them up by 64-bit hash in a
table of fixed size, and gives only new ones to the tokenizers library.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

SLOT_BITS = 20                # places of the table; a new piece replaces the one in its place
WIDTH = 8                     # ids kept per piece; pieces with more are not kept
GROUP_BYTES = 1 << 18         # texts handled at once; one text is never cut
JOINED = 200                  # new pieces per text given to the library

_U = np.uint64
_SPACE, _LETTER, _MARK = 1, 2, 3
_KIND = np.zeros(256, np.uint8)
_KIND[[32, *range(9, 14)]] = _SPACE
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_KIND[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = _MARK
#: White space beyond ASCII in UTF-8; a text with one is not cut.
_OTHER_SPACE = tuple(chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
_BYTE = np.random.default_rng(23).integers(1, 2 ** 63, 256, dtype=np.int64).astype(_U) * _U(2) + _U(1)


@lru_cache(maxsize=8)
def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.full(n, 0x9E3779B97F4A7C15, _U)
        out[0] = 1
        return np.cumprod(out, dtype=_U)


def _pieces(data: bytes, text_starts: np.ndarray, spaced: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, end, hash`` of the pieces of non-empty texts that lie one
    behind the other.  ``spaced``: white space belongs to the piece behind it;
    otherwise it belongs to none."""
    b = np.frombuffer(data, np.uint8)
    kind = _KIND[b]
    latin = np.flatnonzero(b[:-1] == 0xC3) + 1                 # letters of Latin-1, but for the two signs
    kind[latin[(b[latin] != 0x97) & (b[latin] != 0xB7)]] = _LETTER
    space, before = kind == _SPACE, kind[:-1]
    first = np.zeros(len(b), bool)
    first[1:] = (space[1:] & (before != _SPACE)) | ((kind[1:] == _MARK) & (before == _LETTER))
    if not spaced:
        first[1:] |= ~space[1:] & (before == _SPACE)
    first[text_starts] = True
    start = np.flatnonzero(first)
    size = np.diff(np.append(start, len(b)))
    with np.errstate(over="ignore"):
        place = np.arange(len(b)) - np.repeat(start, size)
        power = _powers(1 << max(6, int(size.max()).bit_length()))
        h = np.add.reduceat(_BYTE[b] * power[place], start) + size.astype(_U)
        h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
        h ^= h >> _U(31)
    end = start + size
    if not spaced:
        keep = ~space[start]
        start, end, h = start[keep], end[keep], h[keep]
    return start, end, np.maximum(h, _U(1))


class PieceTokenizer:
    """Encodes texts by their pieces.  ``spaced``: white space belongs to the
    pre-token behind it (byte-level BPE); otherwise the tokenizer drops it.
    Texts that hold an added token's string go to the library whole, which
    reads it as that token; so do texts with white space beyond ASCII."""

    def __init__(self, path: str, spaced: bool, slot_bits: int = SLOT_BITS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer, self.spaced, self.slot_bits = Tokenizer.from_file(path), spaced, slot_bits
        self.dtype = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.added = {t.content.encode(): i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.whole_marks = (*self.added, *_OTHER_SPACE)
        self.keys = np.zeros(1 << slot_bits, _U)
        self.sizes = np.zeros(1 << slot_bits, np.uint8)
        self.kept = np.zeros((1 << slot_bits, WIDTH), self.dtype)

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``sizes, ids`` of pieces: many in one call, an added token between
        them, which is one id and parts the text."""
        if not self.added:
            each = self._library([p.decode() for p in pieces])
            return np.array([len(x) for x in each], np.int64), np.concatenate(each)
        between, mark = next(iter(self.added.items()))
        groups = [pieces[a:a + JOINED] for a in range(0, len(pieces), JOINED)]
        sizes, ids = [], []
        for x in self._library([between.join(g).decode() for g in groups]):
            ends = np.append(np.flatnonzero(x == mark), len(x))
            sizes.append(np.diff(ends, prepend=-1) - 1)
            ids.append(x[x != mark])
        return np.concatenate(sizes), np.concatenate(ids)

    def _group(self, texts: list[bytes]) -> list[bytes]:
        """The ids of non-empty texts without marks, as bytes."""
        data = b"".join(texts)
        lengths = np.array([len(t) for t in texts])
        text_starts = np.cumsum(lengths) - lengths
        start, end, h = _pieces(data, text_starts, self.spaced)
        slot = (h >> _U(64 - self.slot_bits)).astype(np.int64)
        hit = self.keys[slot] == h
        rows, sizes = self.kept[slot], self.sizes[slot].astype(np.int64)
        long = np.zeros(0, np.int64)
        miss = np.flatnonzero(~hit)
        if len(miss):
            new, first, of = np.unique(h[miss], return_index=True, return_inverse=True)
            at = miss[first]
            n, ids = self._learn([data[a:b] for a, b in zip(start[at].tolist(), end[at].tolist())])
            filled = np.arange(WIDTH) < n[:, None]
            mine = np.zeros((len(new), WIDTH), self.dtype)
            short = n <= WIDTH
            mine[filled & short[:, None]] = ids[np.repeat(short, n)]
            rows[miss], sizes[miss] = mine[of], n[of]
            slots = slot[at[short]]
            self.keys[slots], self.sizes[slots], self.kept[slots] = new[short], n[short], mine[short]
            long = miss[~short[of]]
        total = np.concatenate([[0], np.cumsum(sizes)])
        filled = np.arange(WIDTH) < np.where(sizes > WIDTH, 0, sizes)[:, None]
        if len(long):
            out, free = np.empty(total[-1], self.dtype), np.ones(total[-1], bool)
            begin = np.cumsum(n) - n
            for j, k in zip(long.tolist(), of[~short[of]].tolist()):
                out[total[j]:total[j + 1]] = ids[begin[k]:begin[k] + n[k]]
                free[total[j]:total[j + 1]] = False
            out[free] = rows[filled]
        else:
            out = rows[filled]
        width, raw = out.itemsize, out.tobytes()
        cut = (width * total[np.append(np.searchsorted(start, text_starts), len(start))]).tolist()
        return [raw[a:b] for a, b in zip(cut, cut[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes of ``dtype``."""
        out = [b""] * len(texts)
        whole, group, size = [], [], 0

        def flush():
            for (i, _), ids in zip(group, self._group([t for _, t in group]) if group else ()):
                out[i] = ids
            group.clear()
        for i, text in enumerate(texts):
            data = text.encode()
            if any(m in data for m in self.whole_marks):
                whole.append(i)
            elif data:
                if group and size + len(data) > GROUP_BYTES:
                    flush()
                    size = 0
                group.append((i, data))
                size += len(data)
        flush()
        for i, ids in zip(whole, self._library([texts[i] for i in whole])):
            out[i] = ids.tobytes()
        return out


@lru_cache(maxsize=2)
def piece_tokenizer(path: str, spaced: bool) -> PieceTokenizer:
    return PieceTokenizer(path, spaced)
