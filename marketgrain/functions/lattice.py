"""Exact p-value of the two-sample Kolmogorov-Smirnov statistic.

All orders of m and n values are equally likely if both samples have one distribution. An order is a path over a lattice, one
step right or up for a value of either sample; its statistic is below d if |i / m - j / n| stays below d all the way. The paths
inside that band are counted row by row, a running sum over the row before it, cut to the band.
"""

from __future__ import annotations

from math import lgamma

import numpy as np


def exact_tail(gap: float, m: int, n: int) -> float:
    """Probability of a largest gap of at least ``gap``."""
    m, n = sorted((int(m), int(n)))
    height = round(gap * m * n)  # the gap times m n is a whole number
    if m == 0 or height <= 0:
        return 1.0
    row, scale = np.zeros(n + 1), 0.0
    low, high = 0, min(n, -(-height // m) - 1)
    row[:high + 1] = 1.0
    for i in range(1, m + 1):
        # whole numbers j with |i n - j m| < height
        below, above = max(0, (i * n - height) // m + 1), min(n, -(-(i * n + height) // m) - 1)
        if below > above:
            return 1.0
        row[low:below] = 0.0
        row[below:above + 1] = np.cumsum(row[below:above + 1])
        low, high = below, above
        top = row[above]
        if top <= 0:
            return 1.0
        row[low:high + 1] /= top
        scale += np.log(top)
    if high < n:
        return 1.0
    every = lgamma(m + n + 1) - lgamma(m + 1) - lgamma(n + 1)
    return float(min(1.0, max(0.0, 1.0 - np.exp(scale + np.log(row[n]) - every))))
