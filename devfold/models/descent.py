"""Limited-memory BFGS in the driver, for costs whose value and gradient a job works out.

The steps are those of the optimiser behind Spark's logistic regression: ten remembered steps, a line search for
the strong Wolfe conditions, and the same rules of when to end, so a fit ends where that one would.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

import numpy as np

MEMORY, VALUES = 10, 20
#: Decrease and curvature that a step has to bring, and trials of a line search.
DECREASE, CURVATURE, TRIALS = 1e-4, 0.9, 10

Cost = Callable[[np.ndarray], tuple[float, np.ndarray]]


class NoStepError(ArithmeticError):
    """No step along a direction meets the conditions."""


class _Point(NamedTuple):
    at: float
    value: float
    slope: float
    gradient: np.ndarray


def _between(left: _Point, right: _Point) -> float:
    """Where the cubic through two points is least, off their ends."""
    one = left.slope + right.slope - 3 * (left.value - right.value) / (left.at - right.at)
    inner = one * one - left.slope * right.slope
    if not inner >= 0:
        raise NoStepError("no minimum between two points")
    two = math.sqrt(inner)
    width = right.at - left.at
    at = right.at - width * (right.slope + two - one) / (right.slope - left.slope + 2 * two)
    return min(max(at, left.at + 0.1 * width), left.at + 0.9 * width)


def _along(cost: Cost, x: np.ndarray, start: _Point, direction: np.ndarray, first: float) -> _Point:
    """A point along ``direction`` that meets the strong Wolfe conditions; ``first`` is tried first."""
    if start.slope > 0:
        raise NoStepError("the cost grows along the direction")

    def point(at: float) -> _Point:
        value, gradient = cost(x + direction * at)
        return _Point(at, value, float(gradient @ direction), gradient)

    def zoom(low: _Point, high: _Point) -> _Point:
        for _ in range(TRIALS):
            new = point(_between(high, low) if low.at > high.at else _between(low, high))
            if new.value > start.value + DECREASE * new.at * start.slope or new.value >= low.value:
                high = new
                continue
            if abs(new.slope) <= CURVATURE * abs(start.slope):
                return new
            if new.slope * (high.at - low.at) >= 0:
                high = low
            low = new
        raise NoStepError("no step in the bracket")

    at, low = first, start
    for trial in range(TRIALS):
        new = point(at)
        if not math.isfinite(new.value):
            at /= 2
            continue
        if new.value > start.value + DECREASE * at * start.slope or (new.value >= low.value and trial):
            return zoom(low, new)
        if abs(new.slope) <= CURVATURE * abs(start.slope):
            return new
        if new.slope >= 0:
            return zoom(new, low)
        low, at = new, at * 1.5
    raise NoStepError("no step along the direction")


def _direction(gradient: np.ndarray, steps: list[np.ndarray], turns: list[np.ndarray]) -> np.ndarray:
    """Against the gradient, as the last steps and the turns of the gradient over them bend it; latest first."""
    out = gradient.copy()
    if not steps:
        return -out
    bend = steps[0] @ turns[0]
    if not bend >= 0:
        raise NoStepError("the last step has no curvature")
    size, shares = [s @ t for s, t in zip(steps, turns, strict=True)], []
    for step, turn, own in zip(steps, turns, size, strict=True):
        shares.append((step @ out) / own)
        out -= shares[-1] * turn
    out *= bend / (turns[0] @ turns[0])
    for step, turn, own, share in reversed(list(zip(steps, turns, size, shares, strict=True))):
        out += (share - (turn @ out) / own) * step
    if not np.isfinite(out).all():
        raise NoStepError("the remembered steps give no direction")
    return -out


def minimised(cost: Cost, x: np.ndarray, rounds: int, tolerance: float) -> np.ndarray:
    """Where ``cost`` is least, from ``x`` on, after ``rounds`` steps at most.

    It ends earlier once the value is within ``tolerance`` of its start's value of the highest of the last ``VALUES`` ones, once the
    gradient is within ``tolerance`` of the value, or when two searches in a row find no step.
    """
    value, gradient = cost(x)
    first, recent, failed, done = value, [math.inf], False, 0
    steps: list[np.ndarray] = []
    turns: list[np.ndarray] = []
    while done < rounds and np.linalg.norm(gradient) > max(tolerance * value, 1e-8):
        if len(recent) > 1 and abs(value - max(recent)) <= tolerance * first:
            break
        try:
            direction = _direction(gradient, steps, turns)
            start = _Point(0.0, value, float(gradient @ direction), gradient)
            new = _along(cost, x, start, direction, 1.0 if done else 1 / float(np.linalg.norm(direction)))
            if new.at * np.linalg.norm(gradient) < 1e-10:
                raise NoStepError("the step is too short")
        except NoStepError:
            if failed:
                break
            failed, steps, turns = True, [], []
            continue
        moved = x + direction * new.at
        steps, turns = [moved - x, *steps][:MEMORY], [new.gradient - gradient, *turns][:MEMORY]
        x, value, gradient = moved, new.value, new.gradient
        recent, failed, done = [*recent, value][-VALUES:], False, done + 1
    return x
