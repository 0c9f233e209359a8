"""Induced suffix sorting in batches, over arrays that may lie on disk.

The suffix array doubles as the queue of the induction: each symbol's bucket is
a first-in-first-out run, and because the scan meets the keys in order, the
buckets together are a monotone priority queue of suffixes. Arrays longer than
``MEMORY`` entries are kept in unnamed temporary files of the task and touched a
batch at a time. The text itself, its hash sums and the list of left-most-smaller
places are in memory at any size, over 40 bytes an entry, so a shard must fit into
memory. The shards of :mod:`cartlens.llm.suffix_dedup` do and stay far below
``MEMORY`` (2.31 M entries at most on 0.51 GB): they are sorted in memory and no
registered query reaches the files.

A batch takes as many queue entries as cannot be overtaken: everything in front
of the first slot that an earlier entry of the batch itself fills. Names of the sorted
left-most-smaller substrings form the reduced text, which is sorted recursively.
The substrings are sorted by keys of several symbols in memory, or by an induction
where the text lies on disk or holds a substring of over ``SPAN`` symbols. A reduced
text of at most ``SHORT`` names ends the recursion: its buckets hold a few entries each and its
batches would be tiny, so it is sorted by names of twice as many symbols each time.
"""

from __future__ import annotations

import tempfile

import numpy as np

from cartlens.llm import common

#: Entries held in memory per array; longer arrays go to disk.
MEMORY = 1 << 24
BATCH = 1 << 15
#: Longest substring that is compared by keys, and longest reduced text that is not induced again.
SPAN, SHORT = 1 << 10, 1 << 18


def array(n: int, dtype, fill: int | None = None, memory: int | None = None) -> np.ndarray:
    """An array in memory or, when it is long, in a temporary file that vanishes with it."""
    if n <= (MEMORY if memory is None else memory):
        out = np.empty(n, dtype=dtype)
    else:
        with tempfile.TemporaryFile() as f:
            out = np.memmap(f, dtype=dtype, mode="w+", shape=(n,))
    if fill is not None:
        out[:] = fill
    return out


def _types(x: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one (the last one counts as such)."""
    n = len(x)
    out = array(n, bool)
    out[n - 1] = True
    hi = n - 1
    while hi > 0:  # blocks from the right; equal symbols take over the type of the next different one
        lo = max(0, hi - (1 << 20))
        a, b = x[lo:hi], x[lo + 1:hi + 1]
        known = np.append(np.where(a != b, np.arange(hi - lo), hi - lo), hi - lo)
        after = np.minimum.accumulate(known[::-1])[::-1][:-1]
        small = np.append(a < b, out[hi])
        out[lo:hi] = small[after]
        hi = lo
    return out


def _scan(sa: np.ndarray, x: np.ndarray, small: np.ndarray, bound: np.ndarray, forward: bool) -> None:
    """One induction: larger suffixes by a forward scan from the buckets' starts, or
    smaller ones by a backward scan from their ends."""
    n, at, size, step = len(sa), 0, 256, 1 if forward else -1
    if not forward:
        bound = bound - 1
    leads = array(n + 2, bool, 0)  # by entry + 1: whether the suffix before it is to be filled in (-1: no entry)
    np.not_equal(small, forward, out=leads[2:])
    ramp = np.arange(BATCH)
    while at < n:
        size = min(size, n - at)
        part = sa[at:at + size] if forward else sa[n - at - size:n - at][::-1]
        k = np.flatnonzero(leads[part + 1])
        if not len(k):
            at += size
            size = min(2 * size, BATCH)
            continue
        # Slots in the order of the symbols: each bucket is filled in the order of the queue.
        j = part[k] - 1
        symbol = x[j]
        order = symbol.argsort(kind="stable")
        s = symbol[order]
        nth = ramp[:len(s)]
        first = nth.copy()
        first[1:][s[1:] == s[:-1]] = 0
        slot = bound[s] + step * (nth - np.maximum.accumulate(first))
        ahead = np.empty(len(s), np.int64)  # distance from the batch's first entry
        ahead[order] = slot - at if forward else n - at - 1 - slot
        # The batch ends at the first slot that an entry before it fills.
        np.minimum.accumulate(ahead, out=ahead)
        after = np.empty(len(s), np.int64)
        after[:-1], after[-1] = k[1:], size
        met = int((ahead <= after).argmax())
        end = int(ahead[met]) if ahead[met] <= after[met] else size
        if end < size:
            done = order <= met
            order, slot, s = order[done], slot[done], s[done]
        sa[slot] = j[order]
        bound[s] = slot + step  # of equal symbols the last one counts
        at += end
        size = min(2 * size if end == size else max(64, 2 * end), BATCH)


def _induce(x: np.ndarray, small: np.ndarray, ends: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """All suffixes sorted by induction from the left-most-smaller ones, given in bucket order."""
    sa = array(len(x), np.int32 if len(x) < 1 << 31 else np.int64, -1)
    starts = np.concatenate([[0], ends[:-1]])
    symbol = x[lms]
    _, first, count = np.unique(symbol, return_index=True, return_counts=True)
    rank = np.arange(len(lms)) - np.repeat(first, count)
    slots = ends[symbol] - np.repeat(count, count) + rank
    sa[slots] = lms
    _scan(sa, x, small, starts.copy(), True)
    sa[slots[1:]] = -1  # set anew by the backward scan; the end of the text stays first
    _scan(sa, x, small, ends.copy(), False)
    return sa


def _twins(new: np.ndarray, flags: bool = False) -> np.ndarray:
    """Places (or flags) of sorted entries that equal a neighbour; ``new`` tells which differ from the one before."""
    twin = ~new
    twin[:-1] |= ~new[1:]
    return twin if flags else np.flatnonzero(twin)


def _by_substring(x: np.ndarray, small: np.ndarray, lms: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """The left-most-smaller positions in the order of their substrings (each up to the next such
    position), by keys of several symbols; whether each differs from the one before it."""
    bits = int(2 * symbols + 2).bit_length()
    width = 63 // bits
    code = np.zeros(len(x) + width, dtype=np.int64)  # of equal symbols the larger type comes first
    code[:len(x)] = 2 * x.astype(np.int64) + small + 2
    left = np.append(np.diff(lms) + 1, 1)

    def keys(at: np.ndarray, left: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), dtype=np.int64)
        for i in range(width):
            out = out << bits | np.where(i < left, code[np.minimum(at + i, len(x))], 0)
        return out

    key = keys(lms, left)
    order = np.argsort(key, kind="stable")
    new = np.ones(len(lms), dtype=bool)
    new[1:] = np.diff(key[order]) != 0
    depth = width
    place = _twins(new)
    place = place[left[order[place]] > depth]
    while len(place):  # what is equal so far and goes on: equal ones go on together
        at = order[place]
        key = keys(lms[at] + depth, left[at] - depth)
        turn = np.lexsort((key, np.cumsum(new[place])))
        at, key = at[turn], key[turn]
        order[place] = at
        new[place[1:]] |= key[1:] != key[:-1]
        depth += width
        place = place[(left[at] > depth) & _twins(new[place], flags=True)]
    return lms[order], new


def _doubled(x: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order, first by as many symbols as a key holds, then by twice as many
    each time, of those that still equal others: for short texts."""
    n = len(x)
    bits = (int(x.max()) + 1).bit_length()
    step = min(n, 63 // bits)
    key = np.zeros(n, dtype=np.int64)
    for i in range(step):
        key <<= bits
        key[:n - i] |= x[i:] + 1
    order = np.argsort(key, kind="stable")
    new = np.ones(n, dtype=bool)
    new[1:] = np.diff(key[order]) != 0
    rank = np.zeros(n + 1, dtype=np.int64)  # the place of the first equal one, from 1; 0 for the end of the text
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(1, n + 1), 0))
    place = _twins(new)
    while len(place):
        at = order[place]
        key = rank[at] * (n + 1) + rank[np.minimum(at + step, n)]
        turn = np.argsort(key, kind="stable")
        at, key = at[turn], key[turn]
        order[place] = at
        new[place[1:]] |= key[1:] != key[:-1]
        rank[at] = np.maximum.accumulate(np.where(new[place], place + 1, 0))
        place = place[_twins(new[place], flags=True)]
        step *= 2
    return order


def _by_induction(x: np.ndarray, small: np.ndarray, ends: np.ndarray, lms: np.ndarray, is_lms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same by an induction from the positions in the order of their first symbol."""
    n = len(x)
    sa = _induce(x, small, ends, lms[np.argsort(x[lms], kind="stable")])
    ordered = sa[is_lms[sa]]
    place = array(n, np.int64)
    place[lms] = np.arange(len(lms))
    stop = np.append(lms[1:] + 1, n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(common.mix(x.astype(np.uint64) + np.uint64(1)) * common.powers(n)[0][:n], out=sums[1:])
    end = stop[place[ordered]]
    code = common.span_hash(sums, ordered, end)
    new = np.ones(len(ordered), dtype=bool)
    new[1:] = (code[1:] != code[:-1]) | (np.diff(ordered) != np.diff(end))
    return ordered, new


def suffix_array(x: np.ndarray, symbols: int) -> np.ndarray:
    """Starts of the suffixes of ``x`` in ascending order. ``x`` holds symbols from 0
    to ``symbols`` - 1; the last one is 0 and occurs nowhere else."""
    n = len(x)
    x = x.astype(np.uint16 if symbols <= 1 << 16 else np.int32 if symbols < 1 << 31 else np.int64)
    if n < 3:
        return np.arange(n)[::-1].copy()
    small = _types(x)
    ends = np.cumsum(np.bincount(x, minlength=symbols))
    is_lms = array(n, bool, 0)
    is_lms[1:] = small[1:] & ~small[:-1]
    lms = np.flatnonzero(is_lms)
    longest = int(np.diff(lms).max(initial=0))
    if n <= MEMORY and longest <= SPAN:
        ordered, new = _by_substring(x, small, lms, symbols)
    else:
        ordered, new = _by_induction(x, small, ends, lms, is_lms)
    name = np.cumsum(new) - 1
    if name[-1] + 1 < len(lms):
        place = array(n, np.int64)
        place[lms] = np.arange(len(lms))
        reduced = array(len(lms), np.int64)
        reduced[place[ordered]] = name
        del place
        ordered = lms[_doubled(reduced) if len(lms) <= SHORT else suffix_array(reduced, int(name[-1]) + 1)]
    return _induce(x, small, ends, ordered)
