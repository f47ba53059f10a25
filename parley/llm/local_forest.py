"""Components within one task, on numpy arrays."""

from __future__ import annotations

import numpy as np


def join_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the sets of ``labels`` (each item's smallest known member) along the links (a, b), in place."""
    while True:
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = labels[labels]
            if np.array_equal(up, labels):
                break
            labels[:] = up
