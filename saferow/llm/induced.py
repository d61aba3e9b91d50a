"""Suffix order and common prefixes by external induced sorting.

Suffixes that start a rising stretch after a fall (the seeds) are sorted by
recursion on the string of their names; all others are induced from them in two
scans, one upwards for the falling and one downwards for the rising suffixes.
A scan takes tuples (first symbol, position, common prefix) from a priority
queue in the order of the suffixes and puts the tuples of the suffixes one place
to the left back into it.  Their common prefix with the tuple put before them
under the same symbol is one more than the least common prefix scanned between
their sources, so prefixes are carried through the scans and never compared.

The queue is monotone: nothing smaller than the scan's place is put in.  So it
is kept as a row of buckets by symbol range; only the bucket of the scan is held
sorted, the others are unsorted runs, which go to a file beyond ``memory`` bytes.
Tuples are taken in batches that none of their own products could interrupt.
"""

from __future__ import annotations

import tempfile

import numpy as np

BUCKETS, GROUP = 256, 16
#: Strings up to this length are ordered by rank doubling: the end of the recursion.
SHORT = 1 << 20
_FAR = np.iinfo(np.int32).max


class BucketQueue:
    """Runs of (key, position, prefix) tuples by bucket, in RAM or in a file.

    Buckets are grouped; a tuple of a later group waits with its group and is
    dealt to its bucket when the scan gets there.
    """

    def __init__(self, buckets: int, per: int, memory: int):
        self.per, self.near = per, {}
        self.far = [[] for _ in range(-(-buckets // GROUP))]
        self.memory, self.held, self.file, self.group = memory, 0, None, -1

    def put(self, run: np.ndarray) -> None:
        """A run of tuples in order of their keys, none before the scan's bucket."""
        group = (run[:, 0] >> 1) // (self.per * GROUP)
        if group[0] == group[-1]:
            parts = [(group[0], run)]
        else:
            edge = np.flatnonzero(group[1:] != group[:-1]) + 1
            parts = zip(group[np.append(0, edge)].tolist(), np.split(run, edge))
        for g, part in parts:
            if g == self.group:
                self._deal(part)
            else:
                self.far[g].append(part)
        self.held += run.nbytes
        if self.held > self.memory:
            self.spill()

    def _deal(self, run: np.ndarray) -> None:
        place = (run[:, 0] >> 1) // self.per
        edge = np.flatnonzero(place[1:] != place[:-1]) + 1
        for b, part in zip(place[np.append(0, edge)].tolist(), np.split(run, edge)):
            self.near.setdefault(b, []).append(part)

    def spill(self) -> None:
        """The waiting runs of all later groups go to the file."""
        if self.file is None:
            self.file = tempfile.TemporaryFile(prefix="induced-")
        self.file.seek(0, 2)
        for g, runs in enumerate(self.far):
            mine = [r for r in runs if isinstance(r, np.ndarray)]
            if mine:
                merged = np.concatenate(mine)
                place = (self.file.tell(), len(merged))
                merged.tofile(self.file)
                self.far[g] = [r for r in runs if not isinstance(r, np.ndarray)] + [place]
        self.file.flush()
        self.held = 0

    def _read(self, run) -> np.ndarray:
        if isinstance(run, np.ndarray):
            return run
        self.file.seek(run[0])
        return np.fromfile(self.file, np.int32, 3 * run[1]).reshape(-1, 3)

    def take(self, bucket: int) -> np.ndarray:
        if bucket // GROUP != self.group:
            self.group = bucket // GROUP
            runs, self.far[self.group] = self.far[self.group], []
            if runs:
                got = np.concatenate([self._read(r) for r in runs])
                self._deal(got[np.argsort((got[:, 0] >> 1) // self.per, kind="stable")])
        runs = self.near.pop(bucket, None)
        if not runs:
            return np.zeros((0, 3), np.int32)
        out = np.concatenate(runs)
        self.held = max(0, self.held - out.nbytes)
        return out

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def _least_between(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """min(values[lo..hi]) for many ranges, by a table of power-of-two minima."""
    size = hi - lo + 1
    level = np.frexp(size.astype(np.float64))[1] - 1
    out = np.empty(len(lo), values.dtype)
    table, k = values, 0
    while True:
        at = np.flatnonzero(level == k)
        if len(at):
            out[at] = np.minimum(table[lo[at]], table[hi[at] - (1 << k) + 1])
        if k >= (level.max() if len(level) else 0):
            return out
        table, k = np.minimum(table[:-(1 << k)], table[1 << k:]), k + 1


def _scan(text, wanted, seeds, seed_prefix, run, symbols, cap, memory):
    """One induction scan in rising order of ``text`` (int32, symbols below ``symbols``).

    ``wanted[i]``: suffix i is to be induced.  Gives positions, prefixes with the
    predecessor in the scan, and which of them were induced.
    """
    per = max(1, -(-symbols // BUCKETS))
    buckets = -(-symbols // per)
    queue = BucketQueue(buckets, per, memory)
    carry = np.full(symbols, _FAR, np.int32)
    met = np.zeros(symbols, bool)  # symbols that something was put under
    seed_key = 2 * text[seeds] + 1
    out = []
    for bucket in range(buckets):
        got = queue.take(bucket)
        a, b = np.searchsorted(seed_key, [2 * bucket * per, 2 * (bucket + 1) * per])
        mine = np.column_stack([seed_key[a:b], seeds[a:b], seed_prefix[a:b]]).astype(np.int32)
        here = np.concatenate([got, mine])
        here = here[np.argsort(here[:, 0], kind="stable")]
        top, last, look = (bucket + 1) * per, None, 4096
        while len(here):
            key, pos = here[:look, 0], here[:look, 1]
            left = pos - 1
            ok = (pos > 0) & wanted[left]
            sym = text[left]
            inner = np.where(ok & (sym < top), 2 * sym, _FAR)
            least = np.minimum.accumulate(inner)
            stop = np.flatnonzero(key[1:] > least[:-1])
            end = int(stop[0]) + 1 if len(stop) else len(key)
            look = max(4096, 2 * end)
            batch, here = here[:end], here[end:]
            ok, sym, left = ok[:end], sym[:end], left[:end]
            pos, key, pre = batch[:, 1], batch[:, 0], batch[:, 2].copy()
            # from the induced to the seeds of a symbol: the shorter run of it
            before = np.concatenate([[last[0] if last else -2], key[:-1]])
            prior = np.concatenate([[last[1] if last else 0], pos[:-1]])
            seam = np.flatnonzero((key & 1 == 1) & (before == key - 1))
            pre[seam] = np.minimum(run[pos[seam]], run[prior[seam]])
            pre[before >> 1 != key >> 1] = 0
            last = (int(key[-1]), int(pos[-1]))
            out.append(np.column_stack([pos, pre, key & 1]))
            at = np.flatnonzero(ok)
            if len(at):
                s = sym[at]
                order = np.argsort(s, kind="stable")
                at, s = at[order], s[order]
                new = np.zeros((len(at), 3), np.int32)
                new[:, 0], new[:, 1] = 2 * s, left[at]
                first = np.r_[True, s[1:] != s[:-1]]
                lo = np.where(first, 0, np.r_[0, at[:-1] + 1])
                low = _least_between(pre, lo, at)
                low[first] = np.where(met[s[first]], np.minimum(low[first], carry[s[first]]), -1)
                new[:, 2] = np.minimum(low + 1, cap)
                tail = np.minimum.accumulate(pre[::-1])[::-1]
                ends = np.r_[first[1:], True]
                np.minimum(carry, tail[0], out=carry)
                after = np.append(tail, _FAR)[at[ends] + 1]
                carry[s[ends]] = after
                met[s] = True
                inside = int(np.searchsorted(s, top))
                if inside:
                    here = np.insert(here, np.searchsorted(here[:, 0], new[:inside, 0], "right"), new[:inside], axis=0)
                if inside < len(new):
                    queue.put(new[inside:])
            else:
                np.minimum(carry, pre.min(), out=carry)
    queue.close()
    done = np.concatenate(out) if out else np.zeros((0, 3), np.int32)
    return done[:, 0].astype(np.int64), done[:, 1].astype(np.int32), done[:, 2] == 0


def _induce(text, rising, seeds, seed_prefix, symbols, cap, memory):
    """All suffixes in order (without the closing symbol) from sorted seeds."""
    n = len(text)
    # length of the run of equal symbols from each place
    ends = np.flatnonzero(np.r_[text[1:] != text[:-1], True])
    run = (np.repeat(ends, np.diff(ends, prepend=-1)) - np.arange(n) + 1).astype(np.int32)
    pos, pre, made = _scan(text, ~rising, seeds, seed_prefix, run, symbols, cap, memory)
    # downwards: the falling suffixes, largest first, are the seeds of the second scan
    down = pos[made][::-1]
    # kept prefixes are those with the next smaller falling suffix of the same symbol
    down_pre = np.concatenate([[0], pre[made][::-1][:-1]]).astype(np.int32)
    if len(down):
        down_pre[1:][text[down][1:] != text[down][:-1]] = 0
    turned = (symbols - 1 - text).astype(np.int32)
    pos, pre, _ = _scan(turned, rising, down, down_pre, run, symbols, cap, memory)
    return pos[::-1], np.concatenate([[0], pre[1:][::-1]]).astype(np.int32)


def _doubled(text: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for a short string: ranks of 1, 2, 4 ... symbols, all kept, from
    which common prefixes are read off from the longest down."""
    n = len(text)
    ranks = [np.append(np.unique(text, return_inverse=True)[1] + 1, 0).astype(np.int32)]
    while len(ranks) < 2 or (1 << len(ranks) - 1) < min(cap, n):
        half = 1 << len(ranks) - 1
        second = ranks[-1][np.minimum(np.arange(n) + half, n)]
        pair = ranks[-1][:n].astype(np.int64) * (n + 1) + second
        ranks.append(np.append(np.unique(pair, return_inverse=True)[1] + 1, 0).astype(np.int32))
        if ranks[-1].max() == n:
            break
    order = np.argsort(ranks[-1][:n], kind="stable")
    a, b, common = order[:-1], order[1:], np.zeros(n - 1, np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        r, size = ranks[level], 1 << level
        x, y = a + common, b + common
        fits = np.maximum(x, y) + size <= n
        common += size * (fits & (r[np.minimum(x, n)] == r[np.minimum(y, n)]))
    return order, np.concatenate([[0], np.minimum(common, cap)]).astype(np.int32)


def _stretch_ranks(t, rising, seeds, symbols) -> np.ndarray:
    """Rank of each seed's stretch (up to and with the next seed's symbol), by
    sorting a few symbols at a time, those that still tie on."""
    length = np.diff(np.append(seeds, len(t) - 1)) + 1
    bits = int(2 * symbols + 1).bit_length()
    step = 62 // bits
    rank, active, at = np.zeros(len(seeds), np.int64), np.arange(len(seeds)), 0
    while len(active):
        key = np.zeros(len(active), np.int64)
        for j in range(at, at + step):
            pos = np.minimum(seeds[active] + j, len(t) - 1)
            value = 2 * t[pos].astype(np.int64) + rising[pos] + 1
            key = key << bits | np.where(j < length[active], value, 0)
        order = np.lexsort((key, rank[active])) if at else np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        group = rank[active]
        index = np.arange(len(active))
        new_group = np.r_[True, group[1:] != group[:-1]]
        new_key = new_group | np.r_[True, key[1:] != key[:-1]]
        rank[active] = group + np.maximum.accumulate(np.where(new_key, index, 0)) \
            - np.maximum.accumulate(np.where(new_group, index, 0))
        alone = new_key & np.r_[new_key[1:], True]
        at += step
        active = active[~alone & (length[active] > at)]
    return rank


def suffix_order(text: np.ndarray, cap: int, memory: int = 1 << 28, short: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes of ``text`` in order, common prefix of each with the one before).

    ``text``: integers from 0 up.  Prefixes are exact up to ``cap``; suffixes that
    share at least ``cap`` symbols may come in any order.
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    short = SHORT if short is None else short
    if n <= short:
        return _doubled(text, cap)
    t = np.concatenate([text + 1, [0]]).astype(np.int32)  # closed by a symbol below all others
    symbols = int(t.max()) + 1
    step = np.sign(np.diff(t))
    change = np.flatnonzero(step)  # the last step is a fall, so every place has a next change
    rising = np.append(np.repeat(step[change] > 0, np.diff(change, prepend=-1)), True)
    seeds = np.flatnonzero(rising[1:-1] & ~rising[:-2]) + 1
    place = _stretch_ranks(t, rising, seeds, symbols)
    names = np.unique(place, return_inverse=True)[1]
    if len(names) == 0 or names.max() + 1 == len(seeds):
        ranked, common = np.argsort(names), np.zeros(len(seeds), np.int32)
    else:
        ranked, common = suffix_order(names, cap // 2 + 2, memory, short)  # a stretch has two symbols at least
    # common prefix of neighbouring seeds: their equal stretches, then symbol by symbol
    # through the first stretches that differ
    pre = np.zeros(len(ranked), np.int64)
    if len(ranked) > 1:
        a, b = ranked[:-1], ranked[1:]
        closed = np.append(seeds, n + 1)
        pa = closed[np.minimum(a + common[1:], len(seeds))]
        pb = closed[np.minimum(b + common[1:], len(seeds))]
        far = pa - seeds[a]
        open_ = np.flatnonzero((far < cap) & (pa <= n) & (pb <= n))
        pa, pb = pa[open_], pb[open_]
        while len(open_):
            same = (t[np.minimum(pa, n)] == t[np.minimum(pb, n)]) & (pa < n) & (pb < n) & (far[open_] < cap)
            open_, pa, pb = open_[same], pa[same] + 1, pb[same] + 1
            far[open_] += 1
        pre[1:] = np.minimum(far, cap)
    sorted_seeds = np.append(n, seeds[ranked])  # the closing symbol first
    return _induce(t, rising, sorted_seeds, np.append(0, pre).astype(np.int32), symbols, cap, memory)
