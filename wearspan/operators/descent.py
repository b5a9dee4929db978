"""Minimisation by L-BFGS with a strong Wolfe search, for sums over a table that several searches share.

The steps are those that Spark ML's trainers take (the method of Nocedal and Wright, section 3.5 and 7.2, with the constants and the ends
of the trainers' library), so a model is the one they would fit. A search is a generator: it yields the point whose
value and gradient it wants next. `minimise` asks for the points of all searches together, so the table is read once for all of them.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Callable, Generator

import numpy as np

Point = np.ndarray
Search = Generator[Point, tuple[float, Point], Point]

MEMORY = 10
TOLERANCE = 1e-6
# Values looked back at before a search may end because they no longer fall.
LOOK_BACK = 20
SUFFICIENT, CURVATURE = 1e-4, 0.9
TRIES = 10


class SearchFailed(ArithmeticError):
    """No step along a direction is good enough."""


def minimise(starts: list[Point], evaluate: Callable[[dict[int, Point]], dict[int, tuple[float, Point]]], max_iter: int) -> list[Point]:
    """The end points of one search from each start. `evaluate` gets the points that are waited for, by the number of their search."""
    searches = [search(x, max_iter) for x in starts]
    found: list[Point] = [np.array([])] * len(starts)
    waiting = {i: next(s) for i, s in enumerate(searches)}
    while waiting:
        answers = evaluate(waiting)
        waiting = {}
        for i, answer in answers.items():
            try:
                waiting[i] = searches[i].send(answer)
            except StopIteration as end:
                found[i] = end.value
    return found


def search(x: Point, max_iter: int) -> Search:
    """One search; the last point is returned when the steps are used up, the gradient is small, or the values stay."""
    value, gradient = yield x
    first = value
    history: deque = deque(maxlen=MEMORY)
    values: deque = deque([math.inf], maxlen=LOOK_BACK)
    steps, failed = 0, False
    while steps < max_iter and np.linalg.norm(gradient) > max(TOLERANCE * abs(value), 1e-8):
        if len(values) > 1 and abs(value - max(values)) <= TOLERANCE * first:
            break
        try:
            direction = _direction(gradient, history)
            first_step = 1.0 if steps else 1.0 / float(np.linalg.norm(direction))
            at, new_value, new_gradient = yield from _line_search(x, value, gradient, direction, first_step)
        except SearchFailed:
            if failed:
                break
            failed = True
            history.clear()
            continue
        failed = False
        history.appendleft((at - x, new_gradient - gradient))
        x, value, gradient = at, new_value, new_gradient
        values.append(value)
        steps += 1
    return x


def _direction(gradient: Point, history: deque) -> Point:
    scale = 1.0
    if history:
        step, change = history[0]
        with np.errstate(all="ignore"):
            scale = np.float64(step @ change) / (change @ change)
        if step @ change < 0 or math.isnan(step @ change):
            raise SearchFailed("the history has no curvature")
    direction, shares = gradient.copy(), []
    for step, change in history:
        with np.errstate(all="ignore"):
            share = np.float64(step @ direction) / (step @ change)
        if math.isnan(share):
            raise SearchFailed("the history has no curvature")
        shares.append(share)
        direction -= share * change
    direction *= scale
    for (step, change), share in zip(reversed(history), reversed(shares), strict=True):
        direction += (share - (change @ direction) / (step @ change)) * step
    return -direction


def _line_search(x: Point, value: float, gradient: Point, direction: Point, t: float) -> Generator:
    """The point, value and gradient of a step along `direction` that meets the strong Wolfe conditions; `t` is the first to try."""
    slope = float(gradient @ direction)
    if slope > 0:
        raise SearchFailed("not a direction of descent")

    def probe(t: float) -> Generator:
        at = x + direction * t
        v, g = yield at
        return t, float(g @ direction), v, at, g

    def chosen(bracket: tuple) -> tuple[Point, float, Point]:
        if bracket[0] * np.linalg.norm(gradient) < 1e-10:
            raise SearchFailed("the step is too small")
        return bracket[3], bracket[2], bracket[4]

    low = (0.0, slope, value, x, gradient)
    ends = None
    for i in range(TRIES):
        c = yield from probe(t)
        if not math.isfinite(c[2]):
            t /= 2.0
            continue
        if c[2] > value + SUFFICIENT * t * slope or (c[2] >= low[2] and i > 0):
            ends = (low, c)
            break
        if abs(c[1]) <= CURVATURE * abs(slope):
            return chosen(c)
        if c[1] >= 0:
            ends = (c, low)
            break
        low = c
        t *= 1.5
    if ends is None:
        raise SearchFailed("no bracket")
    low, high = ends
    for _ in range(TRIES):
        c = yield from probe(_between(high, low) if low[0] > high[0] else _between(low, high))
        if c[2] > value + SUFFICIENT * c[0] * slope or c[2] >= low[2]:
            high = c
            continue
        if abs(c[1]) <= CURVATURE * abs(slope):
            return chosen(c)
        if c[1] * (high[0] - low[0]) >= 0:
            high = low
        low = c
    raise SearchFailed("no step between the ends of a bracket")


def _between(left: tuple, right: tuple) -> float:
    """Minimum of the cubic through two points, kept away from both."""
    (a, da, fa), (b, db, fb) = left[:3], right[:3]
    with np.errstate(all="ignore"):
        d1 = np.float64(da + db - 3 * (fa - fb) / (a - b))
        d2 = np.sqrt(d1 * d1 - da * db)
        t = float(b - (b - a) * (db + d2 - d1) / (db - da + 2 * d2))
    # No number is neither too low nor too high, as in the trainers.
    return a + 0.1 * (b - a) if t < a + 0.1 * (b - a) else a + 0.9 * (b - a) if t > a + 0.9 * (b - a) else t
