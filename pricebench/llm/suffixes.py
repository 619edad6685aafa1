"""Suffix order, shared prefixes and longest previous factors of byte strings, in numpy.

Everything is limited to a depth: two suffixes that agree that far count as equal.
"""

import numpy as np


def doubled_ranks(text: np.ndarray, depth: int) -> list[tuple[int, np.ndarray]]:
    """Order-preserving ranks of the 1, 2, 4, ... bytes from each place, up to the largest power below ``depth``.

    Past its end the text counts as zeros.
    """
    n = len(text)
    wide = np.concatenate([text, np.zeros(2 * depth, np.uint8)]).astype(np.int64)
    ranks, size = [(1, wide)], 1
    while 2 * size <= depth:
        now = ranks[-1][1]
        ahead = np.concatenate([now[size:], np.zeros(size, np.int64)])
        if size <= 2:  # up to four bytes, the bytes themselves are the rank
            paired = now << (8 * size) | ahead
        else:
            paired = now * (int(ahead.max(initial=0)) + 1) + ahead
            paired = np.unique(paired, return_inverse=True)[1]
        if size == 2:
            paired = np.unique(paired, return_inverse=True)[1]
        size *= 2
        ranks.append((size, paired))
    return ranks


def suffix_order(text: np.ndarray, starts: np.ndarray, position: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes at ``starts`` in order, equal ones by ``position``, and what each shares with the one before.

    Each must have ``depth`` bytes. Shared lengths stop at ``depth``.
    """
    ranks = doubled_ranks(text, depth)
    size, last = ranks[-1]
    order = np.lexsort((position, last[starts + depth - size], last[starts]))
    a, b = starts[order[:-1]], starts[order[1:]]
    shared = np.zeros(len(a), np.int64)
    for size, rank in reversed(ranks):
        shared += np.where(rank[a + shared] == rank[b + shared], size, 0)
    same = (last[a] == last[b]) & (last[a + depth - ranks[-1][0]] == last[b + depth - ranks[-1][0]])
    shared = np.where(same, depth, np.minimum(shared, depth - 1))
    return order, np.concatenate([[0], shared])[: len(starts)]


def _nearest_smaller(position: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """What each suffix shares with the nearest one before it in suffix order that has a smaller position.

    All pointers jump at once: between a suffix and the one it points at, every position is larger, so
    a pointer to a larger position may move on to where that one points.
    """
    to = np.arange(len(position)) - 1
    length = shared.copy()
    open_ = np.flatnonzero((to >= 0) & (length > 0))
    while len(open_):
        at = to[open_]
        open_ = open_[position[at] > position[open_]]
        at = to[open_]
        to[open_], length[open_] = to[at], np.minimum(length[open_], length[at])
        open_ = open_[(to[open_] >= 0) & (length[open_] > 0)]
    return np.where(to >= 0, length, 0)


def previous_factors(order: np.ndarray, shared: np.ndarray, position: np.ndarray) -> np.ndarray:
    """The longest prefix of each suffix that also starts at a smaller position, indexed like ``position``.

    It is the larger of what the previous and the next smaller position in suffix order share with it.
    """
    found = np.zeros(len(position), np.int64)
    if len(order):
        sorted_positions = position[order]
        before = _nearest_smaller(sorted_positions, shared)
        after = _nearest_smaller(sorted_positions[::-1], np.concatenate([[0], shared[1:][::-1]]))[::-1]
        found[order] = np.maximum(before, after)
    return found
