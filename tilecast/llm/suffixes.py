"""Suffix order of a text by two-stage sorting.

Only suffixes that are smaller than their successor are sorted directly. All others are induced:
scanning the order from the left, a suffix that is larger than its successor comes to the next
free place in the bucket of its first byte at the moment when the successor is scanned. Buckets
are scanned in whole stretches.
"""

from __future__ import annotations

import numpy as np

#: Bytes up to which the direct sort compares; enough for common prefixes of 50 bytes.
DEPTH = 56


def eight_bytes(t: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as a number, as far as there are eight."""
    t = np.ascontiguousarray(t)
    return np.ndarray(max(len(t) - 7, 0), ">u8", t, strides=(1,)).astype(np.uint64)


def words(t: np.ndarray) -> np.ndarray:
    """Eight bytes from each position on as a number, zeros behind the end."""
    return eight_bytes(np.concatenate((t, np.zeros(DEPTH + 7, np.uint8))))


def smaller_than_next(t: np.ndarray) -> np.ndarray:
    """For each suffix, whether it is smaller than its successor; the empty suffix is smallest."""
    differs = t[1:] != t[:-1]
    rises = np.append(t[1:] > t[:-1], False)
    change = np.flatnonzero(differs)
    if not len(change):
        return np.zeros(len(t), bool)
    # The bytes up to the next change are equal, so the change decides; behind the last there is none.
    out = np.repeat(rises[change], np.diff(change, prepend=-1))
    return np.append(out, np.zeros(len(t) - len(out), bool))


def _direct(w: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The given suffixes by their first ``DEPTH`` bytes; only ties look further than eight."""
    order = which[np.argsort(w[which])]
    group = np.concatenate(([0], np.cumsum(w[order][1:] != w[order][:-1]))) if len(order) else order
    at = np.arange(len(order))
    for k in range(8, DEPTH, 8):
        same = np.zeros(len(at), bool)
        tie = group[1:] == group[:-1]
        same[1:] |= tie
        same[:-1] |= tie
        at, group = at[same], group[same]
        if not len(at):
            break
        word = w[order[at] + k]
        o = np.lexsort((word, group))
        order[at] = order[at[o]]
        word = word[o]
        new = (group[1:] != group[:-1]) | (word[1:] != word[:-1])
        group = np.concatenate(([0], np.cumsum(new)))
    return order


def suffix_order(t: np.ndarray, w: np.ndarray | None = None) -> np.ndarray:
    """Start positions of all suffixes, sorted by their first ``DEPTH`` bytes at least."""
    n = len(t)
    if not n:
        return np.empty(0, np.int64)
    w = words(t) if w is None else w
    small = smaller_than_next(t)
    size = np.bincount(t, minlength=256)
    induced = np.bincount(t[~small], minlength=256)
    start = np.cumsum(size) - size
    out = np.full(n, -1, np.int64)
    first = _direct(w, np.flatnonzero(small))
    # Directly sorted suffixes fill the ends of their buckets.
    head = np.cumsum(size - induced) - (size - induced)
    out[start[t[first]] + induced[t[first]] + np.arange(len(first)) - head[t[first]]] = first
    free = start.copy()
    out[free[t[n - 1]]] = n - 1  # the successor of the last suffix is the empty one
    free[t[n - 1]] += 1
    for c in np.flatnonzero(size):
        done, middle, end = start[c], start[c] + induced[c], start[c] + size[c]
        while done < end:
            upto = free[c] if done < middle else end
            before = out[done:upto] - 1
            before = before[before >= 0]
            before = before[~small[before]]
            done = upto
            if len(before):
                byte = t[before]
                o = np.argsort(byte, kind="stable")
                before, byte = before[o], byte[o]
                count = np.bincount(byte, minlength=256)
                rank = np.arange(len(before)) - (np.cumsum(count) - count)[byte]
                out[free[byte] + rank] = before
                free += count
    return out


def shares_prefix(w: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether suffixes that follow each other in ``order`` have ``length`` (up to ``DEPTH``) first bytes in common."""
    same = np.ones(max(len(order) - 1, 0), bool)
    for k in range(0, length, 8):
        word = w[order + k]
        if length - k < 8:
            word >>= np.uint64(64 - 8 * (length - k))
        same &= word[1:] == word[:-1]
    return same
