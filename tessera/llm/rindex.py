"""A run-length index: which substrings of a set of strings occur twice.

The Burrows-Wheeler transform of the strings is cut into runs of one symbol.
Suffix-array samples are kept at the first and last row of each run only.  A
suffix whose row lies inside a run agrees with its neighbour in the previous
symbol, so its match is one symbol shorter than that of the suffix before it
in the text: matching statistics stream through the text, counting down from
one sampled run end to the next.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix order of an array of small non-negative integers, by prefix doubling.

    A suffix whose rank is its own has its place; only the others are sorted
    again, within the places of their group (the rank is a group's first place).
    """
    n = len(text)
    bits = max(1, int(text.max(initial=0) + 1).bit_length())
    h = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for k in range(h):
        key <<= bits
        key[:max(n - k, 0)] |= text[k:] + 1
    order, place = np.argsort(key), np.arange(n)
    rank = np.empty(n, np.int64)
    moved, key = order, key[order]  # the suffixes at the places that are open
    while n:
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[moved] = np.maximum.accumulate(np.where(new, place, 0))
        alone = new & np.append(new[1:], True)
        if alone.all():
            break
        place, moved = place[~alone], moved[~alone]
        key = rank[moved] * (n + 1)
        ahead = moved + h
        inside = ahead < n
        key[inside] += rank[ahead[inside]] + 1
        sort = np.argsort(key)
        moved, key = moved[sort], key[sort]
        order[place] = moved
        h *= 2
    return order


def common_prefix(text: np.ndarray, i: np.ndarray, j: np.ndarray, step: int = 16) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``i`` and ``j``, pairwise."""
    padded = np.concatenate([text, -1 - np.arange(step)])
    out = np.zeros(len(i), np.int64)
    open_ = np.arange(len(i))
    reach = np.arange(step)
    while len(open_):
        at = out[open_]
        a = np.minimum((i[open_] + at)[:, None] + reach, len(padded) - 1)
        b = np.minimum((j[open_] + at)[:, None] + reach, len(padded) - 1)
        same = padded[a] == padded[b]
        first = np.where(same.all(1), step, same.argmin(1))
        out[open_] = at + first
        open_ = open_[first == step]
    return out


def matching_statistics(text: np.ndarray) -> np.ndarray:
    """For each position, the longest prefix of its suffix that starts anywhere else, too."""
    n = len(text)
    if n < 2:
        return np.zeros(n, np.int64)
    order = suffix_array(text)
    bwt = np.where(order > 0, text[order - 1], -1)
    change = np.flatnonzero(bwt[1:] != bwt[:-1])  # the last rows of runs, but the last run's
    best = np.zeros(n, np.int64)
    # run heads against the row before them, run ends against the row after
    for at, other in ((order[change + 1], order[change]), (order[change], order[change + 1])):
        sample = np.argsort(at)
        where, length = at[sample], common_prefix(text, at, other)[sample]
        last = np.searchsorted(where, np.arange(n), "right") - 1
        streamed = np.where(last >= 0, length[last] - (np.arange(n) - where[last]), 0)
        best = np.maximum(best, streamed)
    return best


def repeated_starts(strings: list[bytes], length: int) -> list[np.ndarray]:
    """For each string, the starts of its substrings of ``length`` bytes that
    occur again, in any of the strings."""
    size = np.array([len(s) for s in strings], np.int64)
    data = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64) + len(strings)
    # each string ends with a symbol of its own, so no match crosses an end
    text = np.insert(data, np.cumsum(size), np.arange(len(strings)))
    long_ = np.flatnonzero(matching_statistics(text) >= length)
    begin = np.cumsum(size + 1) - size - 1
    owner = np.searchsorted(begin, long_, "right") - 1
    cut = np.searchsorted(owner, np.arange(len(strings) + 1))
    return [long_[a:b] - begin[i] for i, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True))]
