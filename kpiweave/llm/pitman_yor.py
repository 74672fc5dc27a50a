"""Seating in Pitman-Yor restaurants: Gibbs draws of table counts, in numpy.

A dish with ``c`` customers sits at ``t`` tables. Given everything else, a sweep unseats all
customers of a dish and seats them anew by the Chinese-restaurant rule; a customer joins an old
table with weight ``i - d t`` (``i`` seated so far) or opens one with weight
``(theta + d T) p`` (``T`` tables in the restaurant, ``p`` the parent's probability of the dish).
Of ``DRAWS`` such seatings one is kept by importance weight, which makes up for tables being drawn
before later customers are known. Customers are seated one by one up to 16, then in blocks of a
sixteenth of those seated, so a dish of any size takes a logarithmic number of steps.
"""

from __future__ import annotations

import numpy as np

DRAWS = 10
THETA = 1.0


def discount(ones: int, twos: int) -> float:
    """The usual estimate from the number of dishes with one and with two customers."""
    return float(np.clip(ones / (ones + 2 * twos) if ones else 0.5, 0.1, 0.95))


def seat(
    c: np.ndarray, p: np.ndarray, tables: np.ndarray, d: float, rng: np.random.Generator
) -> np.ndarray:
    """Tables of each dish. ``c`` customers (at least 1), ``p`` parent probabilities, ``tables``
    of the dish's restaurant without the dish's own."""
    if not len(c):
        return np.zeros(0, np.int64)
    best, weight = None, None
    for _ in range(DRAWS):
        t, logs = _draw(c, p, tables, d, rng)
        if best is None:
            best, weight = t, logs
            continue
        # Reservoir sampling by weight: draw k replaces with its share of the weight so far.
        total = np.logaddexp(weight, logs)
        take = np.log(rng.random(len(c)) + 1e-300) < logs - total
        best, weight = np.where(take, t, best), total
    return best


def _draw(c, p, tables, d, rng):
    t = np.ones(len(c), np.int64)
    logs = np.zeros(len(c))
    active, seated = np.flatnonzero(c > 1), 1
    while len(active):
        block = max(1, seated // 16)
        size = np.minimum(block, c[active] - seated)
        new = (THETA + d * (tables[active] + t[active])) * p[active]
        old = seated - d * t[active]
        t[active] += rng.binomial(size, np.clip(new / (new + old), 0, 1))
        logs[active] += size * np.log(new + old)
        seated += block
        active = active[c[active] > seated]
    return t, logs


def predictive(c, t, p, customers, tables, d):
    """Probability of dishes with ``c`` customers at ``t`` tables, of a restaurant."""
    return (c - d * t + (THETA + d * tables) * p) / (THETA + customers)
