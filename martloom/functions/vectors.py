"""Small numpy helpers used inside tasks: nearest units and distance sums over one block of rows.

The module is pickled by value, so executors need numpy but not this package.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A block of distances to a few thousand units then stays in the processor's cache.
ROWS_PER_BLOCK = 256
# Sums of coordinates are kept as integers of this unit (2^-24), so they do not depend on the order of rows.
UNIT = float(1 << 24)
# A block of larger values could not be summed exactly, nor blocks of them without ever overflowing.
EXACT_BELOW = float(1 << 21)
# Blocks whose sums surely fit into 64 bits: 2^8 rows of 2^21 in units of 2^-24 are below 2^53.
BLOCKS_PER_SUM = 1 << 9


def squared_distances(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Exact form, summed coordinate by coordinate in order."""
    total = np.zeros((len(x), len(w)))
    for d in range(x.shape[1]):
        gap = x[:, d, None] - w[None, :, d]
        total += gap * gap
    return total


def _first_minimum(scores: np.ndarray, slack: np.ndarray, x: np.ndarray, w: np.ndarray, excluded) -> np.ndarray:
    """Index of the first exact minimum per row, given distances that carry errors up to ``slack``."""
    best = scores.argmin(axis=1)
    limit = scores[np.arange(len(x)), best] + slack
    close = np.count_nonzero(scores <= limit[:, None], axis=1) > 1
    if close.any():
        exact = squared_distances(x[close], w)
        if excluded is not None:
            exact[np.arange(len(exact)), excluded[close]] = np.inf
        best[close] = exact.argmin(axis=1)
    return best


def nearest(x: np.ndarray, w: np.ndarray, second: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Nearest and second nearest row of ``w`` for each row of ``x``, the first one on a tie.

    One matrix product gives distances up to rounding, less the row's own square; only rows with
    more than one candidate within the rounding error are measured again.
    """
    squares = (w * w).sum(axis=1)
    scores = x @ (-2.0 * w.T)
    scores += squares
    slack = 1e-9 * (1.0 + (x * x).sum(axis=1) + squares.max())
    best = _first_minimum(scores, slack, x, w, None)
    if not second:
        return best, None
    scores[np.arange(len(x)), best] = np.inf
    return best, _first_minimum(scores, slack, x, w, best)


def blocks(x: np.ndarray):
    for start in range(0, len(x), ROWS_PER_BLOCK):
        yield x[start : start + ROWS_PER_BLOCK]


def add_to_units(sums: np.ndarray, counts: np.ndarray, x: np.ndarray, best: np.ndarray) -> None:
    """Add each row, in integer units, to the sums of its nearest unit."""
    if len(x) and not np.abs(x).max() < EXACT_BELOW:
        raise OverflowError(f"a map takes finite values below {EXACT_BELOW:.0f}; scale the columns first")
    counts += np.bincount(best, minlength=len(counts))
    units = np.rint(x * UNIT)
    for d in range(x.shape[1]):
        sums[:, d] += np.bincount(best, weights=units[:, d], minlength=len(counts)).astype(np.int64)


# Products of coordinates are summed as whole numbers of this unit (2^-16) squared, in two halves that fit into longs.
PRODUCT_UNIT_BITS, HALF_BITS = 16, 18


def exact_products(x: np.ndarray) -> np.ndarray:
    """Sums of the products of all pairs of columns, a first column of ones included, as Python integers."""
    if len(x) and not np.abs(x).max() < EXACT_BELOW:
        raise OverflowError(f"a map takes finite values below {EXACT_BELOW:.0f}; scale the columns first")
    whole = np.rint(np.hstack([np.ones((len(x), 1)), x]) * (1 << PRODUCT_UNIT_BITS)).astype(np.int64)
    high, low = whole >> HALF_BITS, whole & ((1 << HALF_BITS) - 1)
    mixed = (high.T @ low).astype(object)
    squares = (high.T @ high).astype(object) * (1 << 2 * HALF_BITS)
    return squares + (mixed + mixed.T) * (1 << HALF_BITS) + (low.T @ low).astype(object)


# Squared distances below this share of the squares they come from have lost digits and are measured again.
CLOSE = 1e-6


def label_distance_sums(
    x: np.ndarray, x_weights: np.ndarray, y: np.ndarray, y_weights: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``x`` and each label the weighted sum of distances to the rows of ``y``, and the same from ``y`` to ``x``.

    The weights have a column per label. A block of distances is one matrix product, used for both directions while it is in the
    processor's cache; pairs that lie too close for a product are measured coordinate by coordinate.
    """
    middle = y.mean(axis=0)
    x, y = x - middle, y - middle
    x_squares, y_squares = (x * x).sum(axis=1), (y * y).sum(axis=1)
    # Rows of like length share a block, so that a few long ones do not make others seem close.
    by_x, by_y = np.argsort(x_squares), np.argsort(y_squares)
    x, x_weights, x_squares = x[by_x], x_weights[by_x], x_squares[by_x]
    y, y_weights, y_squares = y[by_y], y_weights[by_y], y_squares[by_y]
    left = np.column_stack([-2.0 * x, x_squares, np.ones(len(x))])
    right = np.ascontiguousarray(np.column_stack([y, np.ones(len(y)), y_squares]).T)
    of_x, of_y = np.zeros((len(x), y_weights.shape[1])), np.zeros((len(y), x_weights.shape[1]))
    for i in range(0, len(x), ROWS_PER_BLOCK):
        rows = slice(i, i + ROWS_PER_BLOCK)
        mine = np.ascontiguousarray(x_weights[rows].T)
        for j in range(0, len(y), ROWS_PER_BLOCK):
            cols = slice(j, j + ROWS_PER_BLOCK)
            gaps = left[rows] @ right[:, cols]
            # Written so that what is not a number counts as close.
            close = ~(gaps > CLOSE * (x_squares[rows].max() + y_squares[cols].max()))
            if close.any():
                a, b = np.nonzero(close)
                if 8 * len(a) > gaps.size:
                    gaps = squared_distances(x[rows], y[cols])
                else:
                    gaps[a, b] = ((x[rows][a] - y[cols][b]) ** 2).sum(axis=1)
            np.sqrt(gaps, out=gaps)
            of_x[rows] += gaps @ y_weights[cols]
            of_y[cols] += (mine @ gaps).T
    # Back to the order in which the rows came.
    return of_x[np.argsort(by_x)], of_y[np.argsort(by_y)]
