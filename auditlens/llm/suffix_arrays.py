"""Suffix arrays in numpy: Larsson-Sadakane refinement and Kasai prefixes.

A shard's text is a byte array of regions laid end to end; ``end`` gives each
position its region's end, which no suffix crosses. The order is total: a
suffix that ends sorts before one that goes on, and equal suffixes sort by
place, as if each region ended with a character of its own.
"""

from __future__ import annotations

import numpy as np

#: Positions worked on at once, for the arrays that need not span the text.
_STEP = 1 << 19


def place_type(n: int) -> type:
    """Holds any place in ``n`` bytes, or the sum of four."""
    return np.int32 if n < 1 << 29 else np.int64


def leading_words(data: np.ndarray, end: np.ndarray, count: int = 8, bits: int = 8, add: int = 0) -> np.ndarray:
    """The next ``count`` bytes (each plus ``add``, in ``bits`` bits) as one number; zero past the end."""
    n = len(data)
    word = np.zeros(n, np.uint64)
    for i in range(0, n, _STEP):
        own = word[i:i + _STEP]
        left = end[i:i + _STEP] - np.arange(i, i + len(own))
        padded = np.zeros(len(own) + count, np.uint64)
        ahead = data[i:i + len(padded)]
        padded[:len(ahead)] = ahead
        padded += np.uint64(add)
        for k in range(count):
            part = np.where(left > k, padded[k:k + len(own)], np.uint64(0))
            own |= part << np.uint64(bits * (count - 1 - k))
    return word


def suffix_array(data: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes.

    Refinement: suffixes sorted by their first h bytes carry their group's first
    place as rank; only groups of two or more are sorted on, by the rank of the
    position h bytes later, which doubles h.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    h = 7
    # Nine bits a byte, so that the end differs from a zero byte.
    word = leading_words(data, end, h, 9, 1)
    place = place_type(n)
    end = end.astype(place, copy=False)
    order = np.argsort(word).astype(place)
    word = word[order]
    new = np.ones(n, bool)
    new[1:] = word[1:] != word[:-1]
    del word
    start = np.maximum.accumulate(np.where(new, np.arange(n, dtype=place), place(0)))
    rank = np.empty(n, place)
    rank[order] = start + place(n)  # above every place of a region's end
    while True:
        single = new.copy()
        single[:-1] &= new[1:]
        unsorted = np.flatnonzero(~single).astype(place)  # places of the groups still unsorted
        if not len(unsorted):
            return order
        # Some whole groups at a time. Ranks that a round has refined already serve as well.
        cuts = np.searchsorted(start[unsorted], start[unsorted[_STEP::_STEP]])
        for places in np.split(unsorted, np.unique(cuts)):
            at = order[places]
            later = at + place(h)
            key = np.minimum(later, end[at])  # an ended suffix: its region's end
            inside = later < end[at]
            key[inside] = rank[later[inside]]
            group = start[places]
            turn = np.argsort(group.astype(np.uint64) << np.uint64(32) | key.astype(np.uint64))
            at, key = at[turn], key[turn]  # groups keep their places, so group is unchanged
            order[places] = at
            fresh = np.ones(len(at), bool)
            fresh[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
            new[places] = fresh
            begins = np.maximum.accumulate(np.where(fresh, places, place(0)))
            start[places] = begins
            rank[at] = begins + place(n)
        h *= 2


def common_prefixes(data: np.ndarray, end: np.ndarray, order: np.ndarray, depth: int,
                    lane: int = 64) -> np.ndarray:
    """For each place of ``order``, the bytes (to ``depth``) shared with the place before.

    Kasai's rule: the suffix one position later shares at least one byte less
    with its own predecessor. Positions are walked in text order in lanes of
    ``lane`` consecutive positions, all lanes at once; each step starts from
    the lane's last value less one and extends by eight bytes at a time.
    """
    n = len(data)
    place = place_type(n)
    shared = np.zeros(n, place)
    if n < 2:
        return shared
    word = leading_words(data, end)
    before = np.full(n, -1, place)
    before[order[1:]] = order[:-1]
    begins = np.ones(n, bool)  # nothing carries over into a new region
    begins[1:] = end[1:] != end[:-1]
    head = np.arange(0, n, lane)
    value = np.zeros(len(head), np.int64)
    for step in range(lane):
        at = head + step
        at = at[at < n]
        value = np.maximum(value[:len(at)] - 1, 0)
        value[begins[at]] = 0
        other = before[at]
        limit = np.where(other < 0, 0, np.minimum(np.minimum(end[at] - at, end[other] - other), depth))
        value = np.minimum(value, limit)
        open_ = np.flatnonzero(value < limit)
        while len(open_):
            v = value[open_]
            diff = word[at[open_] + v] ^ word[other[open_] + v]
            same = np.full(len(open_), 8, np.int64)
            for k in range(8):
                same -= diff >= np.uint64(1 << 8 * k)
            v = np.minimum(v + same, limit[open_])
            value[open_] = v
            open_ = open_[(same == 8) & (v < limit[open_])]
        shared[at] = value
    return shared[order]
