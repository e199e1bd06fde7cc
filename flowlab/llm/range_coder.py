"""Static range asymmetric numeral system over token ids, in numpy.

One frequency table gives every id a share of ``2**bits`` slots.  A block is
coded by many interleaved states ("lanes"): token ``i`` belongs to lane
``i % lanes``, and all lanes share one stream of 32-bit words.  Each step
moves a whole row of lanes.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BITS = 20
LANES = 2048
LOW = 1 << 31                        # states lie in [LOW, LOW << 32)
_U = np.uint64
_HEAD = struct.Struct("<4sIQ")       # magic, bits, number of ids


class FrequencyTable:
    """Slots of ``ids`` by their ``counts``; every id gets at least one."""

    def __init__(self, ids: np.ndarray, slots: np.ndarray, bits: int = BITS):
        if len(ids) and int(slots.sum()) != 1 << bits:
            raise ValueError("slots do not fill the table")
        self.ids, self.slots, self.bits = np.asarray(ids, np.int64), np.asarray(slots, np.int64), bits
        self.freq = self.slots.astype(_U)
        self.start = (np.cumsum(self.slots) - self.slots).astype(_U)
        self.symbol = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.slots)

    @classmethod
    def from_counts(cls, ids: np.ndarray, counts: np.ndarray, bits: int = BITS) -> FrequencyTable:
        order = np.argsort(ids)
        ids, counts = np.asarray(ids, np.int64)[order], np.asarray(counts, np.float64)[order]
        if not len(ids):
            return cls(ids, np.zeros(0, np.int64), bits)
        if len(ids) > 1 << bits:
            raise ValueError(f"{len(ids)} ids do not fit {1 << bits} slots")
        slots = np.maximum(1, np.floor(counts / counts.sum() * (1 << bits))).astype(np.int64)
        over = int(slots.sum()) - (1 << bits)
        if over < 0:
            slots[slots.argmax()] -= over
        for i in np.argsort(-slots, kind="stable"):   # the most frequent ids give what is missing
            if over <= 0:
                break
            give = min(over, int(slots[i]) // 2)
            slots[i] -= give
            over -= give
        while over > 0:                               # only when nearly all have one slot
            i = slots.argmax()
            slots[i] -= 1
            over -= 1
        return cls(ids, slots, bits)

    def to_bytes(self) -> bytes:
        body = _HEAD.pack(b"RFRQ", self.bits, len(self.ids)) + self.ids.astype("<u4").tobytes() + self.slots.astype("<u4").tobytes()
        return body + struct.pack("<I", zlib.crc32(body))

    @classmethod
    def from_bytes(cls, data: bytes) -> FrequencyTable:
        body, (crc,) = data[:-4], struct.unpack("<I", data[-4:])
        magic, bits, n = _HEAD.unpack_from(body)
        if magic != b"RFRQ" or crc != zlib.crc32(body):
            raise ValueError("damaged frequency table")
        both = np.frombuffer(body, "<u4", offset=_HEAD.size)
        return cls(both[:n], both[n:], bits)

    @property
    def checksum(self) -> int:
        return zlib.crc32(self.to_bytes())

    def symbols(self, ids: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.ids, ids), max(0, len(self.ids) - 1)) if len(self.ids) > 1 << 22 else self._dense(ids)
        if len(ids) and (not len(self.ids) or (self.ids[at] != ids).any()):
            raise ValueError("an id is not in the frequency table")
        return at

    def _dense(self, ids: np.ndarray) -> np.ndarray:
        if not hasattr(self, "_place"):
            self._place = np.zeros(int(self.ids.max(initial=0)) + 1, np.int32)
            self._place[self.ids] = np.arange(len(self.ids))
        return self._place[np.minimum(ids, len(self._place) - 1)]


def lanes_for(n: int) -> int:
    """As many lanes as a block of ``n`` tokens can use: states cost space."""
    return int(min(LANES, max(1, n // 64)))


def encode(ids: np.ndarray, table: FrequencyTable, lanes: int) -> tuple[np.ndarray, np.ndarray]:
    """``states, words`` of a block of ids."""
    symbols = table.symbols(ids)
    freq, start = table.freq[symbols], table.start[symbols]
    bits, lift = _U(table.bits), _U(63 - table.bits)
    states = np.full(lanes, LOW, _U)
    out = []
    for a in range((max(len(ids), 1) - 1) // lanes * lanes, -1, -lanes):
        f, s = freq[a:a + lanes], start[a:a + lanes]
        x = states[:len(f)]
        full = (x >> lift) >= f
        if full.any():
            out.append((x[full] & _U(0xFFFFFFFF)).astype("<u4"))
            x = np.where(full, x >> _U(32), x)
        q = x // f
        states[:len(f)] = (q << bits) + (x - q * f) + s
    return states, np.concatenate(out[::-1]) if out else np.zeros(0, "<u4")


def decode(n: int, states: np.ndarray, words: np.ndarray, table: FrequencyTable) -> np.ndarray:
    """The ``n`` ids of a block; raises when the stream does not end as it began."""
    lanes, at = len(states), 0
    x, words = states.astype(_U), words.astype(_U)
    out = np.empty(n, np.int32)
    bits, mask, low = _U(table.bits), _U((1 << table.bits) - 1), _U(LOW)
    for a in range(0, n, lanes):
        w = min(lanes, n - a)
        y = x[:w]
        slot = y & mask
        s = table.symbol[slot.astype(np.int64)]
        out[a:a + w] = s
        y = table.freq[s] * (y >> bits) + slot - table.start[s]
        need = np.flatnonzero(y < low)
        if len(need):
            y[need] = (y[need] << _U(32)) | words[at:at + len(need)]
            at += len(need)
        x[:w] = y
    if at != len(words) or (x != low).any():
        raise ValueError("damaged block")
    return table.ids[out]
