"""Synthetic sprints with known motion."""

import numpy as np

from tidegrid.operators.series import FPS
from tidegrid.plans.build import YARDS_PER_PERIOD

TAU = 0.9


def motion(t, speed):
    """Place in yards at clock time t: from -1 before the start."""
    run = np.maximum(t, 0)
    return np.where(t < 0, 0.0, speed * (run - TAU * (1 - np.exp(-run / TAU)))) - 1.0


def finish(speed):
    grid = np.arange(0, 9, 0.001)
    return float(grid[np.searchsorted(motion(grid, speed), 39.6)])


def run_frames(run_id, speed, k0=30.4, seed=0):
    rng = np.random.default_rng(seed)
    total = finish(speed)
    n = int(k0 + (total + 0.8) * FPS)
    k = np.arange(n)
    t = (k - k0) / FPS
    x = motion(t, speed)
    s = x / YARDS_PER_PERIOD + rng.normal(0, 0.002, n)
    seen = np.ones(n, bool)
    for a in rng.integers(20, n - 20, 3):
        seen[a : a + rng.integers(1, 4)] = False
    s[int(rng.integers(40, n - 20))] += 0.6
    rows = []
    stance = np.floor((t + 0.25) / 0.25)
    foot = motion(stance * 0.25, speed) + 0.5
    for i in range(n):
        contact = (t[i] + 0.25) % 0.25 < 0.12
        left, right = (foot[i], foot[i] - 1.0) if stance[i] % 2 else (foot[i] - 1.0, foot[i])
        other = rng.normal(0, 0.01)
        rows.append((run_id, int(i), float(s[i]) if seen[i] else None, float(left + (0 if contact else 3 * other + i * 0.3)), float(right + (0 if contact else 2 + i * 0.3)), 10.0 + other, 1.0, bool(seen[i])))
    return rows, n, total
