"""Word shingles of whole texts as 64-bit hashes, many texts at a time.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; all excluded
characters are single bytes, so words are found in the UTF-8 bytes. A word's
hash is a difference of prefix sums of a polynomial over random byte values.
"""

from __future__ import annotations

import numpy as np

from cellstar.llm.common import mix64

_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
for _upper in range(ord("A"), ord("Z") + 1):  # A-Z count as a-z
    _VALUE[_upper] = _VALUE[_upper + 32]
_IN_WORD = np.ones(256, bool)
_IN_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_powers = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def powers(base: int, n: int) -> np.ndarray:
    have = _powers[base]
    while len(have) < n:
        have = np.concatenate((have, have * np.uint64(pow(base, len(have), 1 << 64))))
    if len(have) <= 1 << 22:  # not kept for a single huge text
        _powers[base] = have
    return have[:n]


def word_hashes(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text index, hash) of every word of the texts raw[ends[i]:ends[i+1]]."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inside = _IN_WORD[raw]
    before = np.concatenate(([False], inside[:-1]))
    before[ends[:-1][ends[:-1] < len(raw)]] = False
    after = np.concatenate((inside[1:], [False]))
    after[ends[1:][ends[1:] > 0] - 1] = False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_VALUE[raw] * powers(_BASE, len(raw)))))
    h = (total[end] - total[start]) * powers(_INVERSE, len(raw))[start]
    text = np.searchsorted(ends, start, side="right") - 1
    return text, mix64(h + (end - start).astype(np.uint64))


def shingle_sets(raw: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, hash) of every text's distinct ``width``-word shingles,
    ascending; a text of fewer words has its whole sequence as one."""
    text, h = word_hashes(raw, ends)
    n = len(text)
    factors = [np.uint64(pow(_BASE, 3 * j + 5, 1 << 64)) for j in range(width)]
    parts_t, parts_h = [], []
    if n >= width:
        at = np.flatnonzero(text[:n - width + 1] == text[width - 1:])
        s = np.zeros(len(at), np.uint64)
        for j in range(width):
            s += h[at + j] * factors[j]
        parts_t.append(text[at])
        parts_h.append(mix64(s))
    words = np.bincount(text, minlength=len(ends) - 1)
    first = np.concatenate(([0], np.cumsum(words)))[:-1]
    for k in range(1, width):
        few = np.flatnonzero(words == k)
        s = np.full(len(few), k, np.uint64)
        for j in range(k):
            s += h[first[few] + j] * factors[j]
        parts_t.append(few)
        parts_h.append(mix64(s))
    t, s = np.concatenate(parts_t).astype(np.int64), np.concatenate(parts_h)
    order = np.lexsort((s, t))
    t, s = t[order], s[order]
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (s[1:] != s[:-1])
    return t[new], s[new]
