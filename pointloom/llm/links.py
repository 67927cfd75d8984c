"""Spanning forests of links that are computed block by block."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np


def forest(n: int, links: Callable[[], Iterator[tuple[np.ndarray, np.ndarray]]]) -> tuple[np.ndarray, np.ndarray]:
    """Edges (index, root index) that connect what the links of `n` items connect.

    `links` gives all links in blocks of index pairs, and is run again until no label gets lower.
    """
    label = np.arange(n)
    while True:
        before = label.copy()
        for a, b in links():
            low = np.minimum(label[a], label[b])
            np.minimum.at(label, label[a], low)
            np.minimum.at(label, label[b], low)
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            while not np.array_equal(label, label[label]):
                label = label[label]
        if np.array_equal(before, label):
            moved = np.flatnonzero(label != np.arange(n))
            return moved, label[moved]
