"""Many smooth convex problems minimised side by side by limited-memory BFGS.

All problems are evaluated together, so a learner over Spark spends one pass on
the data for a step of every problem, however many there are.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

MEMORY = 10
#: Least share of the promised decrease that a step must bring.
ARMIJO = 1e-4


def _direction(g: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]], inverse: np.ndarray | None = None) -> np.ndarray:
    """Two-loop recursion, from ``inverse`` if given: minus the approximate inverse Hessian times the gradient."""
    q, alphas = g.copy(), []
    for s, y in reversed(pairs):
        a = (s @ q) / (s @ y)
        alphas.append(a)
        q -= a * y
    if inverse is not None:
        q = inverse @ q
    elif pairs:
        s, y = pairs[-1]
        q *= (s @ y) / (y @ y)
    for (s, y), a in zip(pairs, reversed(alphas)):
        q += s * (a - (y @ q) / (s @ y))
    return -q


def minimise_all(evaluate: Callable[[list[int], list[np.ndarray]], list[tuple[float, np.ndarray]]], start: list[np.ndarray],
                 max_passes: int = 100, tol: float = 1e-3, lengths: list[float] | None = None, memory: list[list] | None = None,
                 inverses: list[np.ndarray] | None = None) -> list[np.ndarray]:
    """Minimisers of all problems from ``start``.

    ``evaluate(which, points)`` gives value and gradient of the problems
    ``which`` at ``points``.  A problem is done when its gradient is ``tol``
    times as long as ``lengths`` says (the first one's length, if not given), or
    no step brings a decrease; the others go on, for ``max_passes`` evaluations
    at most.  ``memory`` has each problem's (step, gradient change) pairs, known
    from a like problem; those of the last steps are left in it.
    ``inverses`` has each problem's inverse Hessian, about, near the start.
    """
    n = len(start)
    best = [w.astype(float) for w in start]
    value, gradient = [np.inf] * n, [np.zeros_like(w, float) for w in start]
    pairs: list[list] = [[] for _ in range(n)] if memory is None else memory
    move, slope, size, first = [None] * n, [0.0] * n, [1.0] * n, [0.0] * n
    trial, active = list(best), list(range(n))
    for _ in range(max_passes):
        if not active:
            break
        for i, (v, g) in zip(active, evaluate(active, [trial[i] for i in active])):
            if move[i] is None or v <= value[i] + ARMIJO * size[i] * slope[i]:
                known = inverses is not None or move[i] is None and bool(pairs[i])
                if move[i] is None:
                    first[i] = max(float(np.linalg.norm(g)) if lengths is None else lengths[i], 1e-12)
                else:
                    s, y = trial[i] - best[i], g - gradient[i]
                    if s @ y > 1e-12 * (y @ y):
                        pairs[i] = (pairs[i] + [(s, y)])[-MEMORY:]
                best[i], value[i], gradient[i] = trial[i], v, g
                move[i] = _direction(g, pairs[i], None if inverses is None else inverses[i])
                slope[i] = float(move[i] @ g)
                longest = np.inf if known else 10 * np.linalg.norm(pairs[i][-1][0]) if pairs[i] else 1.0  # no leap where curvature is not known yet
                size[i] = float(min(1.0, longest / max(np.linalg.norm(move[i]), 1e-12)))
                if np.linalg.norm(g) <= tol * first[i]:
                    size[i] = 0.0
            else:
                bend = v - value[i] - size[i] * slope[i]  # the parabola through both values has its least at:
                least = -slope[i] * size[i] ** 2 / (2 * bend) if np.isfinite(bend) else 0.0
                size[i] = min(max(least, 0.1 * size[i]), 0.5 * size[i])
            if slope[i] >= 0 or size[i] < 1e-12:
                size[i] = 0.0
            trial[i] = best[i] + size[i] * move[i]
        active = [i for i in active if size[i] > 0]
    return best
