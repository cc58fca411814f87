"""Parameter search by a tree-structured Parzen estimator.

After some random draws, past trials are split into the best and the rest; each parameter is drawn
from a mixture around the best trials' values, and of several draws the one is taken that the best
trials make likeliest against the rest. A trial's draws depend on the seed, its number and the
trials before it, so a search that is resumed from its history goes on as it would have.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from statistics import NormalDist

from pyspark.sql import DataFrame, SparkSession

HISTORY = "trial int, value double, params string"


@dataclass(frozen=True)
class Dimension:
    """A parameter between two ends, both included; on a logarithmic scale or of whole numbers if so marked."""

    name: str
    low: float
    high: float
    log: bool = False
    whole: bool = False
    step: int = 1

    @property
    def ends(self) -> tuple[float, float]:
        if self.whole:
            return self.low / self.step - 0.5, self.high / self.step + 0.5
        return (math.log(self.low), math.log(self.high)) if self.log else (self.low, self.high)

    def inner(self, value: float) -> float:
        return value / self.step if self.whole else math.log(value) if self.log else value

    def outer(self, x: float) -> float:
        if self.whole:
            return int(min(max(round(x), self.low // self.step), self.high // self.step)) * self.step
        return min(max(math.exp(x) if self.log else x, self.low), self.high)


class Parzen:
    """Normal curves around given points, cut off at the ends, and one wide curve over the whole range."""

    def __init__(self, points: Sequence[float], low: float, high: float):
        self.low, self.high = low, high
        at, span = sorted(points), high - low
        least = span / min(100, len(at) + 2)
        fence = [low, *at, high]
        widths = [min(max(b - a, c - b, least), span) for a, b, c in zip(fence, fence[1:], fence[2:])]
        self.curves = [NormalDist(m, max(w, 1e-12)) for m, w in zip([*at, (low + high) / 2], [*widths, span])]
        self.inside = [max(c.cdf(high) - c.cdf(low), 1e-12) for c in self.curves]

    def draw(self, turn: random.Random) -> float:
        c = turn.choice(self.curves)
        p = turn.uniform(c.cdf(self.low), c.cdf(self.high))
        return min(max(c.inv_cdf(min(max(p, 1e-12), 1 - 1e-12)), self.low), self.high)

    def log_density(self, x: float) -> float:
        return math.log(sum(c.pdf(x) / i for c, i in zip(self.curves, self.inside)) / len(self.curves) + 1e-300)


@dataclass
class Search:
    """Looks for the largest value; a trial without a number counts as the worst."""

    space: tuple[Dimension, ...]
    seed: int = 42
    start: int = 10
    draws: int = 24
    trials: list[tuple[dict[str, float], float]] = field(default_factory=list)

    def ask(self) -> dict[str, float]:
        turn = random.Random(f"{self.seed}/{len(self.trials)}")
        if len(self.trials) < self.start:
            return {d.name: d.outer(turn.uniform(*d.ends)) for d in self.space}
        ranked = sorted(range(len(self.trials)), key=lambda i: (-self.trials[i][1], i))
        few = min(math.ceil(len(ranked) / 10), 25)
        out = {}
        for d in self.space:
            values = [d.inner(self.trials[i][0][d.name]) for i in ranked]
            good, rest = Parzen(values[:few], *d.ends), Parzen(values[few:], *d.ends)
            out[d.name] = d.outer(max((good.draw(turn) for _ in range(self.draws)), key=lambda x: good.log_density(x) - rest.log_density(x)))
        return out

    def tell(self, params: dict[str, float], value: float | None) -> None:
        self.trials.append((params, -math.inf if value is None or math.isnan(value) else float(value)))

    def run(self, objective: Callable[[dict[str, float]], float | None], trials: int) -> dict[str, float]:
        """Goes on until there are `trials`, those resumed from included; the best parameters, the earliest of ties."""
        while len(self.trials) < trials:
            params = self.ask()
            self.tell(params, objective(params))
        return self.best[0]

    @property
    def best(self) -> tuple[dict[str, float], float]:
        if not self.trials:
            raise ValueError("no trial was made")
        return max(self.trials, key=lambda t: t[1])

    def table(self, spark: SparkSession) -> DataFrame:
        """trial, value (null if there was none) and params (JSON)."""
        rows = [(i, None if v == -math.inf else v, json.dumps(p, sort_keys=True)) for i, (p, v) in enumerate(self.trials)]
        return spark.createDataFrame(rows, HISTORY)

    def resume(self, history: DataFrame) -> Search:
        """Takes over the trials of table()."""
        self.trials = [(json.loads(r["params"]), -math.inf if r["value"] is None else r["value"]) for r in history.orderBy("trial").collect()]
        return self
