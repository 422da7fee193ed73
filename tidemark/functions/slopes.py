"""Median of all pairwise slopes of one long series without a list of pairs.

With points in order of ``x``, the pairs whose slope is at most ``s`` are those whose order by ``y - s x`` is reversed, so
they are counted like inversions, in n log n.  Bisection on ``s`` then closes in on the slope of the wanted rank.
"""

from __future__ import annotations

import numpy as np

#: width of the last bracket, as a part of the slope and of the slope across the whole series
CLOSE, FLAT = 1e-13, 1e-15


def inversions(ranks: np.ndarray) -> int:
    """Pairs of places in wrong order in a permutation of ``0 … n-1``: binary digit by digit, from the highest."""
    total, order = 0, ranks.astype(np.int64)
    for bit in reversed(range(int(len(ranks) - 1).bit_length())):
        # elements with the same higher digits stand together, in their first order
        one = (order >> bit) & 1
        ones = np.cumsum(one)
        group = order >> (bit + 1)
        begin = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        before = (ones - one)[begin]
        inside = ones - np.repeat(before, np.diff(np.append(begin, len(order))))
        total += int(inside[one == 0].sum())
        order = order[np.argsort(order >> bit, kind="stable")]
    return total


def _ranks(z: np.ndarray) -> np.ndarray:
    """Ranks of values; of equal ones the later has the lower rank, so that a tie counts as an inversion."""
    places = np.arange(len(z))
    out = np.empty(len(z), np.int64)
    out[np.lexsort((-places, z))] = places
    return out


def _pairs(sizes: np.ndarray) -> int:
    return int((sizes.astype(np.int64) * (sizes.astype(np.int64) - 1) // 2).sum())


def _slope_of_rank(x: np.ndarray, y: np.ndarray, k: int, same: int, low: float, high: float) -> float:
    """The ``k``-th smallest slope; it lies above ``low`` and is at most ``high``."""
    flat = FLAT * max(np.ptp(y) / np.ptp(x), np.finfo(float).tiny)
    while high - low > CLOSE * max(abs(low), abs(high)) + flat:
        middle = low + (high - low) / 2
        if not low < middle < high:
            break
        if inversions(_ranks(y - middle * x)) - same >= k:
            high = middle
        else:
            low = middle
    # the bracket holds slopes of the data: neighbours that change places across it are among their pairs
    edge = 4 * (high - low)
    at = np.lexsort((np.arange(len(x)), y - (low - edge) * x))
    i, j = at[:-1], at[1:]
    z = y - (high + edge) * x
    turned = (x[i] != x[j]) & (np.sign(z[j] - z[i]) * np.sign(j - i) <= 0) & (j > i)
    if not turned.any():
        return high
    found = (y[j[turned]] - y[i[turned]]) / (x[j[turned]] - x[i[turned]])
    near = found[np.abs(found - high) <= 8 * (high - low) + flat]
    return float(near[np.argmin(np.abs(near - high))]) if len(near) else high


def median_pairwise_slope(x: np.ndarray, y: np.ndarray) -> float | None:
    """Median of ``(y_j - y_i) / (x_j - x_i)`` over all pairs with different ``x``; null without such a pair.

    Time grows as n log n, memory as n.  The result is a slope of the data (or the mean of two), found to thirteen digits.
    """
    order = np.lexsort((y, x))
    # slopes don't change with the origin, and small numbers lose fewer digits
    x, y = x[order] - x[order][len(x) // 2], y[order] - np.median(y)
    n = len(x)
    groups = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
    total = n * (n - 1) // 2 - _pairs(np.diff(np.append(groups, n)))
    if total == 0:
        return None
    twins = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])]))
    same = _pairs(np.diff(np.append(twins, n)))
    steps = np.diff(x)
    most = float(np.ptp(y) / steps[steps > 0].min()) * 1.001 + np.finfo(float).tiny
    first = _slope_of_rank(x, y, (total + 1) // 2, same, -most, most)
    if total % 2:
        return first
    return (first + _slope_of_rank(x, y, total // 2 + 1, same, -most, most)) / 2
