"""Bounded blocks of normalised text, and exact corpus-wide n-gram counts brought to them.

A block holds some 10**5 words. Its n-grams are 64-bit hashes; the hash space is
dealt in ranges ("hash partitions"), as many as the text needs for one range to
fit a task. A block sends each range its ascending keys (packed, two to five
bytes a key), the range settles them over all blocks and answers each block on
its own keys. So no table of the corpus's n-grams is ever broadcast: a task
holds one block or one range, whatever the size of the corpus.

Keys are shortened to a given number of bits within a range, so the chance that
two keys of a range fall together stays the same at every size.
"""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellstar.llm.common import mix64
from cellstar.llm.shingles import word_hashes

#: Words of a block, about; and bytes of text for each hash partition.
BLOCK_WORDS, RANGE_BYTES = 150_000, 1 << 24

_STEP = np.uint64(0x9E3779B97F4A7C15)


def ranges_for(texts: DataFrame) -> int:
    """Hash partitions for all of ``text``: one for each RANGE_BYTES of it, eight at least."""
    size = texts.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    return max(8, -(-size // RANGE_BYTES))


class Ranges:
    """The hash space in ``count`` ranges, keys cut to ``bits`` within a range."""

    def __init__(self, count: int, bits: int):
        self.count = count
        self.shift = max(0, 64 - bits - (count - 1).bit_length())
        space = 1 << (64 - self.shift)
        self.bounds = np.array([-(-i * space // count) for i in range(1, count)], np.uint64)

    def cut(self, hashes: np.ndarray) -> np.ndarray:
        return hashes >> np.uint64(self.shift)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The range of every key."""
        return np.searchsorted(self.bounds, keys, side="right")

    def split(self, keys: np.ndarray):
        """(range, first, last + 1) of every range that ascending ``keys`` touch."""
        ends = [0, *np.searchsorted(keys, self.bounds).tolist(), len(keys)]
        return [(p, a, b) for p, (a, b) in enumerate(zip(ends, ends[1:])) if a < b]


def _planes(x: np.ndarray) -> bytes:
    """Unsigned numbers as zstd of their bytes, sorted by significance."""
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    planes = np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _whole(z: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(z[1:]), np.uint8).reshape(z[0], -1)
    out = np.zeros((raw.shape[1], 8), np.uint8)
    out[:, :z[0]] = raw.T
    return out.reshape(-1).view("<u8").astype(np.uint64)


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as their differences."""
    return _planes(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(z: bytes) -> np.ndarray:
    return np.cumsum(_whole(z), dtype=np.uint64)


pack_counts, unpack_counts = _planes, _whole


def normalise(raw: np.ndarray, ends: np.ndarray, breaks: str = "") -> tuple[np.ndarray, np.ndarray]:
    """The texts raw[ends[i]:ends[i+1]] with A-Z in lower case, each run of white
    space one space, and each run with a character of ``breaks`` one line feed;
    and their new ends. Nothing stays of a run at a text's edge but one sign that
    ends the text."""
    kind = np.zeros(256, np.uint8)
    kind[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 1
    kind[[ord(c) for c in breaks]] = 2
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    k = kind[raw]
    inside = k == 0
    # a run of separators: from one word's end to the next word; runs end with their text
    last = np.zeros(len(raw), bool)
    last[ends[1:][ends[1:] > ends[:-1]] - 1] = True
    close = inside & np.append(~inside[1:], True)[:len(raw)] | inside & last
    at = np.flatnonzero(close)                      # last byte of every word
    after = np.append(at[1:], len(raw))
    first = np.concatenate(([0], np.cumsum(k == 2)))
    hard = first[after] > first[at]                 # a break before the next word's end
    text = np.searchsorted(ends, at, side="right") - 1
    hard[:-1] |= text[1:] != text[:-1]
    hard[-1:] = True
    out = np.empty(int(inside.sum()) + len(at), np.uint8)
    n = np.cumsum(inside)
    place = np.arange(len(at)) + n[at] if len(at) else at
    signs = np.zeros(len(out), bool)
    signs[place] = True
    out[signs] = np.where(hard, 10, 32)
    out[~signs] = lower[raw[inside]]
    words = np.bincount(text, minlength=len(ends) - 1)
    upto = np.concatenate(([0], np.cumsum(words)))
    new = np.concatenate((place + 1, [0]))[upto - 1]
    new[upto == 0] = 0
    return out, new


class Words:
    """Words of normalised text: their hash, their line, and the bytes they span."""

    def __init__(self, raw: np.ndarray):
        feeds = np.flatnonzero(raw == 10)
        ends = np.concatenate(([0], feeds + 1)).astype(np.int64)
        if ends[-1] != len(raw):
            ends = np.append(ends, len(raw))
        self.line, self.hash = word_hashes(raw, ends)
        stop = (raw == 10) | (raw == 32)
        self.end = np.flatnonzero(stop)
        self.start = np.concatenate(([0], self.end[:-1] + 1)) if len(self.end) else self.end


def grams(h: np.ndarray, group: np.ndarray, order: int, seed: np.uint64 = np.uint64(0)):
    """(index of first word, hash) of the n-grams of 1 to ``order`` words that
    stay within a group, order by order."""
    k = mix64(h ^ seed)
    found = [(np.arange(len(h)), k)]
    for n in range(2, order + 1):
        if len(k) < 2:
            found += [(np.zeros(0, np.int64), np.zeros(0, np.uint64))] * (order + 1 - n)
            break
        k = mix64(k[:-1] * _STEP + h[n - 1:])
        at = np.flatnonzero(group[:-(n - 1)] == group[n - 1:])
        found.append((at, k[at]))
    return found


def counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sum of their weights (1 each)."""
    if weights is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
    if not len(first):
        return keys, np.zeros(0, np.uint64)
    sums = np.diff(np.append(first, len(keys))) if weights is None else np.add.reduceat(weights, first)
    return keys[first], sums.astype(np.uint64)
