"""Cutting stock by column generation over a histogram of lengths (driver side, size bounded by the capacity).

Items of near-equal length form a class whose size is its longest member.  The
restricted master LP (minimise sequences, cover every class) starts from a
first-fit solution's patterns and is solved by the revised simplex method over
the patterns known so far; its duals price new
patterns by an unbounded-knapsack dynamic program over the capacity; generation
stops when Farley's bound is within ``gap`` of the LP value.  Patterns are
rounded down; what is left is packed first-fit decreasing by size.
"""

from __future__ import annotations

import numpy as np


def length_classes(histogram: dict[int, int], exact: int = 256, step: int = 128) -> tuple[list[int], dict[int, int]]:
    """(class sizes ascending, class index of each length): lengths up to ``exact`` alone, longer ones within 1/step."""
    sizes: list[int] = []
    index: dict[int, int] = {}
    ceiling = -1
    for length in sorted(histogram, reverse=True):
        if length < ceiling or not sizes:
            sizes.append(length)
            ceiling = length if length <= exact else length - length // step
        index[length] = len(sizes) - 1
    sizes = sizes[::-1]
    return sizes, {k: len(sizes) - 1 - v for k, v in index.items()}


def _price(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack: best worth for every capacity and the class taken last there (-1: none)."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    use = np.flatnonzero(worth > 1e-12)
    size, gain = sizes[use], worth[use]
    for c in range(1, capacity + 1):
        best[c], k = best[c - 1], int(np.searchsorted(size, c, "right"))
        if k:
            value = gain[:k] + best[c - size[:k]]
            top = int(value.argmax())
            if value[top] > best[c] + 1e-12:
                best[c], last[c] = value[top], use[top]
    return best, last


def _pattern(c: int, last: np.ndarray, sizes: np.ndarray, first: int) -> np.ndarray:
    row = np.zeros(len(sizes))
    row[first] += 1
    c -= sizes[first]
    while c > 0:
        if last[c] < 0:
            c -= 1
            continue
        row[last[c]] += 1
        c -= sizes[last[c]]
    return row


def _simplex(pool: np.ndarray, basis: list[int], demand: np.ndarray, rounds: int = 4000, patience: int = 150):
    """Minimise the sum of x with pool.T x = demand, from a feasible basis; returns (basis, x of the basis, duals).

    Stops early after ``patience`` pivots without progress (degenerate) or when a
    basis turns numerically singular: any feasible basis is a valid answer.
    """
    inverse = np.linalg.inv(pool[basis].T)
    product = np.empty_like(inverse)                         # reused: new arrays of this size cost more than the arithmetic
    x = inverse @ demand
    basis, safe = list(basis), (list(basis), x.copy(), inverse.sum(0))
    value, stalled = x.sum(), 0
    for it in range(1, rounds + 1):
        worth = pool @ inverse.sum(0)
        enter = int(worth.argmax())
        column = inverse @ pool[enter]
        able = column > 1e-7
        if worth[enter] <= 1 + 1e-7 or stalled >= patience or not able.any():
            break
        ratio = np.full(len(x), np.inf)
        ratio[able] = np.maximum(x[able], 0) / column[able]
        theta = ratio.min()
        ties = np.flatnonzero(ratio <= theta + 1e-12)
        out = int(ties[column[ties].argmax()])               # the steadiest pivot among ties
        x -= theta * column
        x[out] = theta
        pivot = inverse[out] / column[out]
        inverse -= np.multiply(column[:, None], pivot, out=product)
        inverse[out] = pivot
        basis[out] = enter
        stalled = 0 if x.sum() < value - 1e-9 else stalled + 1
        value = min(value, x.sum())
        if it % 50 == 0:
            try:
                inverse = np.linalg.inv(pool[basis].T)
            except np.linalg.LinAlgError:
                return safe
            x = inverse @ demand
            if x.min() < -1e-6 * max(1.0, demand.max()):
                return safe
            safe = (list(basis), x.copy(), inverse.sum(0))
    return basis, x, inverse.sum(0)


def solve(sizes: list[int], demand: list[int], capacity: int, gap: float = 0.001, rounds: int = 30,
          per_round: int = 100) -> list[tuple[int, dict[int, int]]]:
    """Patterns [(times, {class: items})] that hold exactly ``demand`` items of each class."""
    if not sizes:
        return []
    size, need = np.array(sizes, np.int64), np.array(demand, float)
    m = len(size)
    greedy = _first_fit(size, np.array(demand, np.int64), capacity)
    pool = np.concatenate([np.diag((capacity // size).astype(float)), np.zeros((len(greedy), m))])
    for k, (_, content) in enumerate(greedy):
        pool[m + k, list(content)] = list(content.values())
    basis = list(range(m))
    for _ in range(rounds):
        basis, x, duals = _simplex(pool, basis, need)
        best, last = _price(size, duals, capacity)
        value = x.sum()
        if best[capacity] <= 1 + 1e-7 or value * (1 - 1 / best[capacity]) <= gap * value:
            break
        forced = duals + best[capacity - size]               # the best pattern that holds this class
        tops = [k for k in np.argsort(-forced)[:per_round] if forced[k] > 1 + 1e-7]
        fresh = np.unique(np.array([_pattern(capacity, last, size, k) for k in tops]), axis=0)
        pool = np.concatenate([pool, fresh])
    left = np.array(demand, np.int64)
    plan = []
    for k, times in sorted(zip(basis, np.floor(np.maximum(x, 0) + 1e-9).astype(np.int64)), key=lambda p: -p[1]):
        row = pool[k].astype(np.int64)
        used = row > 0
        times = int(min(times, (left[used] // row[used]).min())) if used.any() else 0
        if times > 0:
            left -= times * row
            plan.append((times, {int(c): int(row[c]) for c in np.flatnonzero(row)}))
    plan += _first_fit(size, left, capacity)
    # with few items rounding can cost more than it gains: the greedy start is then kept
    return min(plan, greedy, key=lambda p: sum(times for times, _ in p))


def _first_fit(size: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[int, dict[int, int]]]:
    """First fit decreasing over what rounding left, class by class: equal bins stay together as (times, content)."""
    bins: list[list] = []                                    # [times, room, content]
    for c in np.flatnonzero(left)[::-1].tolist():
        n, s = int(left[c]), int(size[c])
        k = 0
        while n and k < len(bins):
            times, room, content = bins[k]
            fits = room // s
            if fits:
                full = min(times, n // fits)
                if full < times:                             # split the group: some bins take fewer
                    bins.insert(k + 1, [times - full, room, dict(content)])
                    bins[k][0] = full
                if full:
                    bins[k][1] -= fits * s
                    bins[k][2] = {**content, c: fits}
                    n -= full * fits
                else:
                    bins.pop(k)                              # nothing taken in full: one bin takes the rest
                    bins.insert(k, [1, room - n * s, {**content, c: n}])
                    if times > 1:
                        bins[k + 1][0] = times - 1
                    else:
                        bins.pop(k + 1)
                    n = 0
            k += 1
        per = capacity // s
        if n >= per:
            bins.append([n // per, capacity - per * s, {c: per}])
        if n % per:
            bins.append([1, capacity - (n % per) * s, {c: n % per}])
    return [(times, content) for times, _, content in bins]
