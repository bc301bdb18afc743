"""Groups of equal substrings by external induced sorting.

``equal_windows`` orders the suffixes of a byte string to a depth of ``length``
bytes and yields the groups of positions that share their first ``length``
bytes. The suffixes that begin at a local minimum (LMS) are ordered first: one
induction orders their substrings up to the next minimum, which names them;
the names' sequence is the reduced problem. Its order matters to a bounded
depth only, as every name spans two bytes at least, so ranks are doubled a few
times instead of inducing further levels. A second induction then carries
tuples (position, common prefix with the suffix before it in its bucket)
from the LMS suffixes to the larger and from those to the smaller ones. A
common prefix carried is one more than the least between two suffixes that
enter the same bucket, capped at ``length``.

Buckets are first-in-first-out queues by leading byte, drained in order of that
byte, which makes them one priority queue; what they hold beyond a bounded
memory lies in an unnamed temporary file of the task, like a sort's spill, and
goes with it. Memory for the text itself: a few bytes a position.
"""

from __future__ import annotations

import tempfile
from collections import deque
from collections.abc import Iterator

import numpy as np

#: Tuples that a block holds, and that all queues of a pass hold in memory.
BLOCK = 1 << 16
MEMORY = 1 << 21


class Queues:
    """256 first-in-first-out queues of (position, prefix) blocks, spilling."""

    def __init__(self, memory: int):
        self.blocks: list[deque] = [deque() for _ in range(256)]
        self.memory, self.held, self.file = memory, 0, None

    def push(self, c: int, pos: np.ndarray, lcp: np.ndarray) -> None:
        if self.held + len(pos) > self.memory:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
            at = self.file.seek(0, 2)
            self.file.write(pos.tobytes())
            self.file.write(lcp.tobytes())
            self.blocks[c].append((at, len(pos)))
        else:
            self.held += len(pos)
            self.blocks[c].append((pos, lcp))

    def _read(self, block, keep: bool):
        if isinstance(block[0], int):
            at, n = block
            self.file.seek(at)
            return np.frombuffer(self.file.read(8 * n), np.int64), np.frombuffer(self.file.read(n), np.uint8)
        if not keep:
            self.held -= len(block[0])
        return block

    def drain(self, c: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks in order, those included that are pushed meanwhile."""
        queue = self.blocks[c]
        while queue:
            pos, lcp = self._read(queue.popleft(), False)
            while queue and len(pos) + len(queue[0][1] if not isinstance(queue[0][0], int) else ()) <= BLOCK \
                    and not isinstance(queue[0][0], int):
                more = self._read(queue.popleft(), False)
                pos, lcp = np.concatenate((pos, more[0])), np.concatenate((lcp, more[1]))
            yield pos, lcp

    def backwards(self, c: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for block in reversed(self.blocks[c]):
            yield self._read(block, True)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class Scan:
    """What one direction of an induction does with the suffixes it meets in
    order: it pushes each one's preceding suffix if ``wanted`` has it."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, cap: int, queues: Queues):
        # at each position, the byte that leads the suffix before it if that one is wanted, else -1
        self.lead = np.full(len(text), -1, np.int16)
        self.lead[1:][wanted[:-1]] = text[:-1][wanted[:-1]]
        self.cap, self.queues = cap, queues
        self.least = np.full(256, cap, np.uint8)   # least prefix met since the bucket's last tuple
        self.begun = np.zeros(256, bool)

    def __call__(self, pos: np.ndarray, lcp: np.ndarray) -> None:
        lead = self.lead[pos]
        at = np.flatnonzero(lead >= 0)
        all_least = lcp.min()
        if not len(at):
            np.minimum(self.least, all_least, out=self.least)
            return
        lead = lead[at].astype(np.uint8)
        order = np.argsort(lead, kind="stable")
        at, lead = at[order], lead[order]
        before = pos[at] - 1
        edge = np.flatnonzero(np.concatenate(([True], lead[1:] != lead[:-1], [True])))
        if self.cap == 1:   # the order alone matters
            none = np.zeros(BLOCK, np.uint8)
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                for k in range(a, b, BLOCK):
                    self.queues.push(int(lead[a]), before[k:min(k + BLOCK, b)], none[:min(BLOCK, b - k)])
            return
        met = np.zeros(256, bool)
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            c, own = int(lead[a]), at[a:b]
            low = np.empty(b - a, np.uint8)
            low[0] = min(int(self.least[c]), int(lcp[:own[0] + 1].min()))
            if b - a > 1:
                low[1:] = np.minimum.reduceat(lcp[:own[-1] + 1], own[:-1] + 1)
            carried = np.minimum(low, self.cap - 1) + np.uint8(1)
            if not self.begun[c]:
                carried[0], self.begun[c] = 0, True
            rest = lcp[own[-1] + 1:]
            self.least[c] = rest.min() if len(rest) else self.cap
            met[c] = True
            for k in range(0, b - a, BLOCK):
                self.queues.push(c, before[a + k:min(a + k + BLOCK, b)], carried[k:k + BLOCK])
        self.least[~met] = np.minimum(self.least[~met], all_least)


def _split(text: np.ndarray):
    """(larger than its next suffix, equal bytes from here on capped at 255)."""
    n = len(text)
    change = np.full(n, n, np.int64)
    at = np.flatnonzero(text[1:] != text[:-1])
    if len(at):
        change[:at[-1] + 1] = np.repeat(at + 1, np.diff(at, prepend=-1))
    run = np.minimum(change - np.arange(n), 255).astype(np.uint8)
    larger = np.ones(n, bool)
    inner = change < n
    larger[inner] = text[np.flatnonzero(inner)] > text[change[inner]]
    return larger, run


def induce(text, larger, run, first, first_lcp, cap, memory):
    """All suffixes from the ordered LMS ones ``first``: yields, in descending
    order, (positions, prefix with the next greater suffix, starts a new
    leading byte or type)."""
    waiting, sorted_l = Queues(memory), Queues(memory)
    scan = Scan(text, larger, cap, waiting)
    lead = text[first]
    cut = np.searchsorted(lead, np.arange(257))
    n = len(text)
    waiting.push(int(text[n - 1]), np.array([n - 1]), np.zeros(1, np.uint8))
    scan.begun[text[n - 1]] = True
    scan.least[:] = 0
    for c in range(256):
        last = None
        for pos, lcp in waiting.drain(c):
            sorted_l.push(c, pos, lcp)
            scan(pos, np.minimum(lcp, cap))
            last = pos[-1]
        for a in range(cut[c], cut[c + 1], BLOCK):
            b = min(a + BLOCK, cut[c + 1])
            pos, lcp = first[a:b], first_lcp[a:b].copy()
            if a == cut[c]:
                lcp[0] = 0 if last is None else min(run[last], run[pos[0]], cap)
            scan(pos, lcp)
    waiting.close()
    waiting = Queues(memory)
    scan = Scan(text, ~larger, cap, waiting)
    for c in range(255, -1, -1):
        last, new = None, True
        for pos, lcp in waiting.drain(c):
            yield pos, lcp, new
            scan(pos, lcp)
            last, new = pos[-1], False
        new, carry = True, None
        for pos, lcp in sorted_l.backwards(c):
            pos, lcp = pos[::-1], lcp[::-1]       # lcp: with the next smaller one
            greater = np.concatenate(([0 if carry is None else carry], lcp[:-1])).astype(np.uint8)
            if carry is None and last is not None:
                greater[0] = min(run[last], run[pos[0]], cap)
            carry = lcp[-1]
            yield pos, greater, new
            scan(pos, greater)
            new = False
    waiting.close()
    sorted_l.close()


def _same_text(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix of the suffixes a[i] and b[i], capped; eight bytes at a time."""
    n = len(text)
    padded = np.concatenate((text, np.zeros(cap + 8, np.uint8)))
    eight = np.ndarray((n + cap,), "<u8", padded, 0, (1,))
    out = np.zeros(len(a), np.int64)
    alive = np.arange(len(a))
    for d in range(0, cap, 8):
        apart = eight[a[alive] + d] ^ eight[b[alive] + d]
        same = apart == 0
        stop = alive[~same]
        out[stop] = d + (apart[~same].view(np.uint8).reshape(-1, 8) != 0).argmax(1)
        alive = alive[same]
        if not len(alive):
            break
    out[alive] = cap
    return np.minimum(np.minimum(out, cap), n - np.maximum(a, b)).astype(np.uint8)


def lms_order(text, larger, run, lms, length, memory):
    """The LMS positions ordered to ``length`` bytes, and their common prefixes."""
    size = np.diff(np.append(lms, len(text) - 1)) + 1   # up to the next minimum, which counts
    index = np.full(len(text), -1, np.int64)
    index[lms] = np.arange(len(lms))
    by_lead = lms[np.argsort(text[lms], kind="stable")]
    found = [p[index[p] >= 0] for p, _, _ in induce(text, larger, run, by_lead, np.zeros(len(lms), np.uint8), 1, memory)]
    order = index[np.concatenate(found)[::-1]]
    a, b = order[:-1], order[1:]
    same = size[a] == size[b]
    alive = np.flatnonzero(same)
    for d in range(int(size.max())):   # names: equal substrings
        alive = alive[size[b[alive]] > d]
        if not len(alive):
            break
        x, y = lms[a[alive]] + d, lms[b[alive]] + d
        ok = (text[x] == text[y]) & (larger[x] == larger[y])
        same[alive[~ok]] = False
        alive = alive[ok]
    rank = np.empty(len(lms), np.int64)
    rank[order] = np.concatenate(([0], np.cumsum(~same))) + 1
    step = 1
    while step * 2 < length + 2 and rank.max() < len(lms):
        ahead = np.concatenate((rank[step:], np.zeros(min(step, len(rank)), np.int64)))[:len(rank)]
        both = (rank.astype(np.uint64) << np.uint64(32)) | ahead.astype(np.uint64)   # a shard has less than 2**32 bytes
        order = np.argsort(both)
        both = both[order]
        rank[order] = np.concatenate(([0], np.cumsum(both[1:] != both[:-1]))) + 1
        step *= 2
    first = lms[np.argsort(rank)]
    return first, np.concatenate((np.zeros(1, np.uint8), _same_text(text, first[:-1], first[1:], length)))


def equal_windows(text: np.ndarray, length: int, memory: int = MEMORY) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (position, group): positions in one group begin with the same
    ``length`` bytes; a group's positions follow one another, over blocks too.
    Windows of one repeated byte have groups -1 - byte, which may come twice."""
    n = len(text)
    if n < length:
        return
    larger, run = _split(text)
    lms = np.flatnonzero(~larger[1:] & larger[:-1]) + 1
    if len(lms):
        first, lcp = lms_order(text, larger, run, lms, length, memory)
    else:
        first, lcp = lms, np.zeros(0, np.uint8)
    group, flats = 0, bool((run >= length).any())
    for pos, greater, new in induce(text, larger, run, first, lcp, length, memory):
        apart = greater < length
        if new:
            apart = apart.copy()
            apart[0] = True
        own = group + np.cumsum(apart)
        group = int(own[-1])
        if flats:
            flat = run[pos] >= length
            own[flat] = -1 - text[pos[flat]].astype(np.int64)
        yield pos, own
