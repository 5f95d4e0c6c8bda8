"""Words and word sequences of many texts at once, as numpy arrays over the bytes of an Arrow batch.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, that is what ``bytes.split()`` gives. Words and sequences are
compared by 64-bit hashes. A word's is the sum of random numbers, one drawn for each pair of a place and a byte (tabulation), then
mixed; two given different words of up to 64 bytes share it for one draw of the numbers in 2**64. Longer words have xxh3. A sequence's
hash is mixed each time that two parts are joined, so that no pattern of words cancels out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

SLICE = 1 << 18  # words hashed at a time; it bounds memory, not what is read

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_SEQUENCE = np.uint64(0xD6E8FEB86659FD93)
_PLACES = 64
_TABLE = np.random.Generator(np.random.PCG64(0x9E3779B97F4A7C15)).integers(0, 1 << 64, (_PLACES, 256), np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose every bit depends on all bits of the input."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    data: np.ndarray  # bytes of all texts
    start: np.ndarray  # of each word, in data
    end: np.ndarray
    first: np.ndarray  # of each text, its first word; one more entry at the end
    offset: np.ndarray  # of each text, its first byte; one more entry at the end

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A hash for each word; with ``lower``, A-Z count as a-z."""
        out = np.zeros(len(self.start), np.uint64)
        data = _LOWER[self.data] if lower else self.data
        size = self.end - self.start
        for low in range(0, len(out), SLICE):
            part = np.minimum(size[low : low + SLICE], _PLACES).astype(np.uint8)
            longest_first = np.argsort(~part, kind="stable")
            start, total = self.start[low : low + SLICE][longest_first], np.zeros(len(part), np.uint64)
            longer = len(part) - np.cumsum(np.bincount(part, minlength=_PLACES + 1))  # words of more bytes than each place
            for place, n in enumerate(longer[:_PLACES].tolist()):
                total[:n] += _TABLE[place][data[start[:n] + place]]
            out[low : low + SLICE][longest_first] = mix(total)
        for i in np.flatnonzero(size > _PLACES).tolist():
            out[i] = xxhash.xxh3_64_intdigest(data[self.start[i] : self.end[i]].tobytes())
        return out


def words_of(texts: pa.Array) -> Words:
    """Words of an Arrow string column; a null text has none."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if not len(texts):
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint8), none, none, np.zeros(1, np.int64), np.zeros(1, np.int64))
    _, offsets, data = texts.buffers()
    offset = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    low, high = offset[0], offset[-1]
    data = np.frombuffer(data, np.uint8)[low:high] if data is not None else np.zeros(0, np.uint8)
    offset = offset - low
    inside = ~_SPACE[data]
    opens, closes = inside.copy(), inside
    opens[1:] &= ~inside[:-1]
    begins = offset[:-1][offset[:-1] < offset[1:]]
    opens[begins] = inside[begins]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    ends = offset[1:][offset[:-1] < offset[1:]] - 1
    closes[ends] = inside[ends]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Words(data, start, end, np.searchsorted(start, offset), offset)


def sequences(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of ``n`` consecutive entries (len - n + 1 of them), by doubling."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out, have = None, 0
    block, length = hashes, 1
    size = len(hashes) - n + 1
    while True:
        if n & length:
            part = block[have : have + size]
            out = part if out is None else mix(out * _SEQUENCE + part)
            have += length
        if length * 2 > n:
            return mix(out)
        block = mix(block[:-length] * _SEQUENCE + block[length:])
        length *= 2


def whole(first: np.ndarray, n: int) -> np.ndarray:
    """Whether the run of ``n`` words that starts at each word ends within its text; as long as ``sequences``."""
    total = int(first[-1])
    if total < n:
        return np.zeros(0, bool)
    ends = np.repeat(first[1:], np.diff(first))
    return np.arange(total - n + 1) + n <= ends[: total - n + 1]
