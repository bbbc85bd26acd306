"""Words of many texts at once: numpy over the UTF-8 bytes of an Arrow batch, without a Python object per word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_rng = np.random.default_rng(20240611)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _rng.integers(1, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Odd multipliers for n-grams of word hashes, by place.
PLACES = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_WINDOW = 4 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of a word that white space ends: all but 0x20 and 0x09-0x0D.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of a word of letters and digits, once A-Z are lower case; all bytes of non-ASCII characters belong to it.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def pack(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and where each begins (one more entry at the end). Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def words(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte and 64-bit hash of each maximal run of ``member`` bytes; words never reach over a text's end.

    The last result has, for each text and one past the last, the index of its first word.
    """
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    starts, ends, hashes = [], [], []
    at = 0
    while at < n:
        stop = min(n, at + _WINDOW)
        inside = member[data[at:stop]]
        while stop < n and inside[-1] and not edge[stop]:  # do not cut a word
            cut = np.flatnonzero(~inside | edge[at:stop])
            cut = cut[cut > 0]
            if len(cut):
                stop = at + int(cut[-1])
                inside = inside[: stop - at]
                break
            stop = min(n, stop + _WINDOW)
            inside = member[data[at:stop]]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1] | edge[at + 1 : stop]
        s = np.flatnonzero(begin)
        if len(s):
            final = inside.copy()
            final[:-1] &= ~inside[1:] | edge[at + 1 : stop]
            e = np.flatnonzero(final) + 1
            place = np.arange(s[0], stop - at, dtype=np.int32)
            place -= np.repeat(s, np.diff(np.append(s, stop - at))).astype(np.int32)
            place &= 4095
            value = _BYTE[data[at + s[0] : stop]]
            value *= _PLACE[place]
            value[~inside[s[0] :]] = 0
            hashes.append(mix(np.add.reduceat(value, s - s[0])))
            starts.append(s + at)
            ends.append(e + at)
        at = stop
    if not starts:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    start = np.concatenate(starts)
    return start, np.concatenate(ends), np.concatenate(hashes), np.searchsorted(start, offsets)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n-grams of the word hashes; the i-th begins at word i (over text ends, too: the caller leaves those out)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        out += h[k : len(h) - n + 1 + k] * PLACES[k]
    return mix(out)
