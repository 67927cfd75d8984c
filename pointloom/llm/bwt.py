"""Common prefixes on a Burrows-Wheeler transform, in increasing length, up to a bound.

Works on one array of symbols (0 separates texts) in numpy. The suffixes are sorted by their first symbols only, as many
as the bound asks for. Starting from the whole array, intervals of suffixes with a common prefix are extended backward by
one symbol, breadth first: the right end of each new interval is where two neighbouring suffixes differ right after a
common prefix of the present length. When the bound is reached, the ends that were never met are exactly those between
suffixes that share at least that many symbols.
"""

from __future__ import annotations

import numpy as np

WIDE = 64


def sorted_suffixes(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes, ordered by their first `depth` symbols at least. Doubling from eight symbols on."""
    n = len(symbols)
    padded = np.concatenate([symbols, np.zeros(8, np.uint8)])
    key = np.ndarray((n,), dtype=">u8", buffer=padded.tobytes(), strides=(1,)).astype(np.uint64)
    known = 8
    while True:
        order = np.argsort(key)
        if known >= depth:
            return order
        by = key[order]
        rank = np.empty(n, dtype=np.uint64)
        rank[order] = np.cumsum(np.r_[True, by[1:] != by[:-1]])
        if int(rank[order[-1]]) == n:
            return order
        key = rank << np.uint64(32)
        key[: n - known] |= rank[known:]
        known *= 2


def equal_prefix_groups(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix starts in order, group of each): two suffixes are in one group if their first `length` symbols are equal.

    Holds for suffixes without a separator in those symbols; of the others nothing is said. Needs a separator at the end.
    """
    n = len(symbols)
    suffix = sorted_suffixes(symbols, length)
    last = symbols[suffix - 1]  # the transform; the suffix at 0 wraps round to the final separator
    by_symbol = np.argsort(last, kind="stable")
    to_front = np.empty(n, dtype=np.int32)
    to_front[by_symbol] = np.arange(n, dtype=np.int32)
    same = last[by_symbol[1:]] == last[by_symbol[:-1]]
    after = np.full(n, n, dtype=np.int32)  # the next row with the same symbol
    after[by_symbol[:-1][same]] = by_symbol[1:][same]
    before = np.full(n, -1, dtype=np.int32)
    before[by_symbol[1:][same]] = by_symbol[:-1][same]
    count = np.bincount(last, minlength=256)
    begin = np.cumsum(count) - count
    present = [int(c) for c in np.flatnonzero(count) if c]
    rows_of = {c: by_symbol[begin[c] : begin[c] + count[c]] for c in present}

    met = np.zeros(n + 1, dtype=bool)
    met[[0, n]] = True
    low, high = np.array([0]), np.array([n])
    for _ in range(length):
        wide = high - low > WIDE
        new_low: list[np.ndarray] = []
        new_high: list[np.ndarray] = []
        if wide.any():
            a, b = low[wide], high[wide]
            for c in present:
                first = np.searchsorted(rows_of[c], a)
                end = np.searchsorted(rows_of[c], b)
                some = end > first
                new_low.append(begin[c] + first[some])
                new_high.append(begin[c] + end[some])
        if not wide.all():
            a, b = low[~wide], high[~wide]
            size = b - a
            row = np.repeat(a - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            row_low, row_high = np.repeat(a, size), np.repeat(b, size)
            text = last[row] != 0
            firsts = row[text & (before[row] < row_low)]
            lasts = row[text & (after[row] >= row_high)]
            # the new intervals are disjoint, so their first and last rows pair up in order
            new_low.append(np.sort(to_front[firsts]).astype(np.int64))
            new_high.append(np.sort(to_front[lasts]).astype(np.int64) + 1)
        low = np.concatenate(new_low) if new_low else low[:0]
        high = np.concatenate(new_high) if new_high else high[:0]
        fresh = ~met[high]
        low, high = low[fresh], high[fresh]
        met[high] = True
        if not len(low):
            break
    return suffix, np.cumsum(met[:n])
