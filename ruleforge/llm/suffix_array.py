"""Suffix arrays by induced sorting (Nong, Zhang, Chan, 2009) over NumPy arrays, and capped common prefixes.

The induction scans buckets instead of single suffixes: all suffixes that a bucket already holds induce
their predecessors at once, and a bucket that induces into itself is scanned again from where it grew. So the
work stays linear in the text and the number of array operations follows the alphabet, not the text.
"""

from __future__ import annotations

import numpy as np

#: Largest alphabet that is scanned bucket by bucket; above it reduced texts are ranked by doubling.
ALPHABET = 1024


def s_types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its right neighbour; a sentinel below all symbols follows the text."""
    n = len(t)
    differs = np.ones(n, bool)
    differs[:-1] = t[:-1] != t[1:]
    smaller = np.zeros(n, bool)
    smaller[:-1] = t[:-1] < t[1:]
    at = np.where(differs, np.arange(n), n)
    nearest = np.minimum.accumulate(at[::-1])[::-1]
    return smaller[nearest]


def _induce(t: np.ndarray, s: np.ndarray, lms: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The suffix array that the order of ``lms`` (leftmost smaller positions) induces."""
    n, k = len(t), len(starts) - 1
    sa = np.full(n, -1, np.int32)
    tail = starts[:-1].copy()

    def forward(at: np.ndarray) -> None:
        at = at[at > 0] - 1
        at = at[~s[at]]
        if len(at):
            place(at, 1)

    def place(at: np.ndarray, step: int) -> None:
        c = t[at]
        order = np.argsort(c, kind="stable")
        c = c[order]
        first = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
        sizes = np.diff(np.r_[first, len(c)])
        nth = np.arange(len(c)) - np.repeat(first, sizes)
        sa[tail[c] + nth if step > 0 else tail[c] - 1 - nth] = at[order]
        tail[c[first]] += step * sizes

    by_char = np.searchsorted(t[lms[np.argsort(t[lms], kind="stable")]], np.arange(k + 1)) if len(lms) else np.zeros(k + 1, np.int64)
    lms = lms[np.argsort(t[lms], kind="stable")] if len(lms) else lms
    place(np.array([n - 1], np.int32), 1)
    for c in range(k):
        lo = starts[c]
        while lo < (hi := tail[c]):
            forward(sa[lo:hi])
            lo = hi
        if by_char[c] < by_char[c + 1]:
            forward(lms[by_char[c] : by_char[c + 1]])
    ends_l = tail.copy()
    tail[:] = starts[1:]

    def backward(at: np.ndarray) -> None:
        at = at[at > 0] - 1
        at = at[s[at]]
        if len(at):
            place(at, -1)

    for c in range(k - 1, -1, -1):
        hi = starts[c + 1]
        while (lo := tail[c]) < hi:
            backward(sa[lo:hi][::-1])
            hi = lo
        if starts[c] < ends_l[c]:
            backward(sa[starts[c] : ends_l[c]][::-1])
    return sa


def _by_doubling(t: np.ndarray, depth: int) -> np.ndarray:
    rank, width, n = t.astype(np.int64), 1, len(t)
    while True:
        key = rank * (int(rank.max()) + 2)
        key[: max(n - width, 0)] += rank[width:] + 1
        sa = np.argsort(key, kind="stable")
        sorted_keys = key[sa]
        new = np.empty(n, np.int64)
        new[sa] = np.cumsum(np.r_[0, sorted_keys[1:] != sorted_keys[:-1]])
        if new[sa[-1]] == n - 1 or 2 * width >= depth:
            return sa.astype(np.int32)
        rank, width = new, 2 * width


def suffix_array(t: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Positions of the suffixes of ``t`` (non-negative integers) in ascending order, by their first ``depth`` symbols at least."""
    n = len(t)
    depth = n if depth is None else min(depth, n)
    if n < 2:
        return np.zeros(n, np.int32)
    k = int(t.max()) + 1
    if k > ALPHABET:
        return _by_doubling(t, depth)
    s = s_types(t)
    lms = np.flatnonzero(s[1:] & ~s[:-1]).astype(np.int32) + 1
    starts = np.r_[0, np.cumsum(np.bincount(t, minlength=k))].astype(np.int64)
    if len(lms) > 1:
        order = _induce(t, s, lms, starts)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        ranked = order[is_lms[order]]
        size = np.zeros(n, np.int32)
        size[lms[:-1]] = np.diff(lms)
        names = np.empty(n, np.int32)
        names[ranked] = np.cumsum(np.r_[0, _differ(t, size, ranked)])
        reduced = names[lms]
        if int(reduced.max()) + 1 < len(lms):
            lms = lms[suffix_array(reduced, depth)]  # a name spans a symbol at least
        else:
            lms = ranked
    return _induce(t, s, lms, starts)


def _differ(t: np.ndarray, size: np.ndarray, ranked: np.ndarray) -> np.ndarray:
    """For neighbours among the ranked substrings (each up to the next leftmost smaller position), whether they differ."""
    a, b = ranked[:-1], ranked[1:]
    out = (size[a] != size[b]) | (size[a] == 0)
    live = np.flatnonzero(~out)
    depth = 0
    while len(live):
        same = t[a[live] + depth] == t[b[live] + depth]
        out[live[~same]] = True
        live = live[same & (size[a[live]] > depth)]
        depth += 1
    return out


def words8(raw: np.ndarray) -> np.ndarray:
    """The little-endian 64-bit word that starts at each byte; ``raw`` must have 8 bytes or more."""
    n = len(raw) - 7
    out = np.empty(n, np.uint64)
    for o in range(min(8, n)):
        k = (len(raw) - o) // 8
        out[o::8] = np.frombuffer(raw[o : o + 8 * k].tobytes(), "<u8")[: len(range(o, n, 8))]
    return out


def permuted_prefixes(raw: np.ndarray, sa: np.ndarray, cap: int) -> np.ndarray:
    """For sa[i], in the place of its position: the bytes it shares with sa[i - 1], ``cap`` at most."""
    w = words8(np.r_[raw, np.zeros(cap + 16, np.uint8)])
    out = np.zeros(len(raw), np.int32)
    a, b = sa[1:].astype(np.int64), sa[:-1].astype(np.int64)
    live = np.arange(len(a))
    for k in range(0, cap, 8):
        x = w[a[live] + k] ^ w[b[live] + k]
        same = np.where(x == 0, 8, np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)) >> 3)
        out[a[live]] += same.astype(np.int32)
        live = live[x == 0]
        if not len(live):
            break
    return np.minimum(out, cap)
