"""Work on runs of rows, as ``guichet.runs`` has it, and the labels that links within one lead to."""

from __future__ import annotations

import numpy as np

from guichet.runs import by_run, in_block_pairs

__all__ = ["by_run", "in_block_pairs", "lowest_labels"]


def lowest_labels(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest identifier that each row reaches by links between rows a and b."""
    label = ids.copy()
    while len(a):
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        if (before == label).all():
            break
    return label
