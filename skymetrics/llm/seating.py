"""Seating of a Chinese restaurant's customers, many dishes at once."""

from functools import lru_cache

import numpy as np

# Customers of a dish who are seated exactly; those beyond sit down in groups that double.
EXACT = 100

_CELLS = 1 << 20


def uniform(bits: np.ndarray) -> np.ndarray:
    """Numbers from 0 to 1 by a hash of 64-bit numbers."""
    bits = (bits ^ (bits >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    bits = (bits ^ (bits >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((bits ^ (bits >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53)


@lru_cache(8)
def _arrangements(discount: float) -> np.ndarray:
    """Log of the weight of all ways to seat n customers at t tables, at [n, t]: generalised Stirling
    numbers, S(n + 1, t) = S(n, t - 1) + (n - t * discount) * S(n, t)."""
    found = np.full((EXACT + 1, EXACT + 1), -np.inf)
    found[0, 0] = 0.0
    for n in range(EXACT):
        stay = np.full(EXACT + 1, -np.inf)
        t = np.arange(1, n + 1)
        stay[1 : n + 1] = found[n, 1 : n + 1] + np.log(np.maximum(n - t * discount, 1e-300))
        found[n + 1] = np.logaddexp(stay, np.append(-np.inf, found[n, :-1]))
    return found


def _drawn(n: int, base: np.ndarray, others: np.ndarray, discount: float, strength: float, luck: np.ndarray):
    """Tables of dishes with ``n`` customers each, drawn from what other dishes' tables leave likely."""
    t = np.arange(1, n + 1)
    weight = np.cumsum(np.log(strength + discount * (others[:, None] + t - 1)), 1) + t * np.log(base)[:, None]
    weight += _arrangements(discount)[n, 1 : n + 1]
    chance = np.cumsum(np.exp(weight - weight.max(1, keepdims=True)), 1)
    return 1 + (chance[:, :-1] < luck[:, None] * chance[:, -1:]).sum(1)


def seat(customers: np.ndarray, base: np.ndarray, others, discount, strength, key: np.ndarray) -> np.ndarray:
    """Tables of each dish once its customers got up and sat down again: a block of a Gibbs sweep.

    All customers of a dish are seated at once, given the tables of ``others``: t tables have a chance as
    the ways to seat so many at t tables, times the draws of t tables with this dish. That is exact for
    up to ``EXACT`` customers. More sit down in groups that double, with as many new tables as expected,
    rounded at random.
    """
    seated = np.minimum(customers, 1).astype(np.int64)
    others = np.broadcast_to(np.asarray(others, float), customers.shape)
    base = np.maximum(base, 1e-300)
    some = np.flatnonzero(customers > 1)
    size = np.minimum(customers[some], EXACT)
    order = np.argsort(size, kind="stable")
    for alike in np.split(some[order], np.flatnonzero(np.diff(size[order])) + 1):
        if not len(alike):
            continue
        n = int(min(customers[alike[0]], EXACT))
        for at in np.array_split(alike, -(-len(alike) * n // _CELLS)):
            seated[at] = _drawn(n, base[at], others[at], discount, strength, uniform(key[at]))
    first, group = EXACT, EXACT
    while len(left := np.flatnonzero(customers > first)):
        size = np.minimum(group, customers[left] - first)
        mass = first + (size - 1) / 2 - discount * seated[left]
        pull = (strength + discount * (others[left] + seated[left])) * base[left]
        luck = uniform(key[left] + np.uint64((first * 0x9E3779B97F4A7C15) & (1 << 64) - 1))
        new = np.floor(size * pull / (pull + np.maximum(mass, 1e-9)) + luck).astype(np.int64)
        seated[left] += np.minimum(size, new)
        first, group = first + group, group * 2
    return seated
