"""Gradient boosting on histograms, with monotone constraints.

Features are cut into at most MOST_BINS bins once; categories are cut by their weight of evidence, and
missing or unseen ones have a branch of their own where the training rows hold any, else go where an
evidence of zero goes. Each level of a tree that is split is one aggregate: sums of
gradients and hessians by node, feature and bin, whose size doesn't depend on the rows. The driver
searches splits in them, and the last splits' sums give the leaves; trees are compiled to expressions over the binned columns, so no row ever
leaves the executors and a lost one costs its partitions only.
"""

from __future__ import annotations

import bisect
import json
import math
import random
from collections import defaultdict
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.expressions import bin_right_closed, cuts_literal, no_nan
from riskloom.operators.search import Dimension, Search
from riskloom.session import settled

MOST_BINS = 64
#: Trees after which the margin, a column of the rows, is written down, so that plans stay short.
SETTLE_TREES = 16


@dataclass(frozen=True)
class BoosterParams:
    trees: int = 80
    depth: int = 2
    rate: float = 0.035
    subsample: float = 0.75
    colsample: float = 0.75
    least_hessian: float = 12.0
    gamma: float = 2.0
    alpha: float = 0.3
    ridge: float = 4.0
    seed: int = 42
    #: The weight of label 1 against that which makes both classes weigh the same.
    positive: float = 1.0


@dataclass
class Booster:
    cuts: dict[str, list[float]]
    base: float
    #: A tree is a leaf {"leaf": w} or {"feature", "bin", "missing_left", "left", "right", "gain"}; "cover" is the hessian of its training rows.
    trees: list[dict] = field(default_factory=list)
    #: The weight of evidence of each category of the categorical features, whose cuts are in these.
    woe: dict[str, dict[str, float]] = field(default_factory=dict)

    # ---- as columns

    def binned(self, df: DataFrame) -> DataFrame:
        """Adds _b_<feature>: the bin, -1 if missing or an unseen category."""
        cols = {}
        for f, c in self.cuts.items():
            x = self._evidence(f) if f in self.woe else no_nan(f)
            cols[f"_b_{f}"] = F.when(x.isNull(), F.lit(-1)).otherwise(bin_right_closed(x, cuts_literal(c)))
        return df.withColumns(cols)

    def _evidence(self, feature: str) -> Column:
        items = F.create_map(*[x for k, v in self.woe[feature].items() for x in (F.lit(k), F.lit(float(v)))])
        key = F.col(feature).cast("string")
        return F.when(key.isNotNull(), F.try_element_at(items, key))

    @staticmethod
    def _text(node: dict, end: Callable[[dict], str | None]) -> str:
        """A tree as SQL, which Spark parses much faster than it takes a tree's columns one by one; `end` gives what a node stands for, None where it is split."""
        if (found := end(node)) is not None:
            return found
        b, low = f"`_b_{node['feature']}`", "" if node["missing_left"] else "0 <= {0} AND "
        return f"IF({low.format(b)}{b} <= {node['bin']}, {Booster._text(node['left'], end)}, {Booster._text(node['right'], end)})"

    def _value(self, node: dict) -> Column:
        return F.expr(self._text(node, lambda n: f"{float(n['leaf'])!r}D" if "leaf" in n else None))

    def margin(self) -> Column:
        return sum(map(self._value, self.trees), F.lit(float(self.base)))

    def score(self, df: DataFrame, name: str = "model_score") -> DataFrame:
        out = self.binned(df).withColumn(name, 1 / (1 + F.exp(-self.margin())))
        return out.drop(*(f"_b_{f}" for f in self.cuts))

    def importance(self) -> dict[str, float]:
        """Shares of the total gain by feature."""
        gain: dict[str, float] = defaultdict(float, {f: 0.0 for f in self.cuts})

        def walk(node: dict) -> None:
            if "leaf" not in node:
                gain[node["feature"]] += node["gain"]
                walk(node["left"])
                walk(node["right"])

        for t in self.trees:
            walk(t)
        total = sum(gain.values()) or 1.0
        return {f: g / total for f, g in gain.items()}

    def dumps(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def loads(text: str) -> Booster:
        return Booster(**json.loads(text))

    # ---- fitting

    @staticmethod
    def fit(df: DataFrame, features: Sequence[str], label: str = "label", params: BoosterParams | None = None, monotone: dict[str, int] | None = None, key: str | None = None, woe: dict[str, dict[str, float]] | None = None) -> Booster:
        """Logistic loss; rows of label 1 weigh as much as the others together. `monotone` has +1 or -1 by feature,
        `woe` the evidence of each category of the features that are categorical."""
        p, monotone, woe = params or BoosterParams(), monotone or {}, {f: w for f, w in (woe or {}).items() if f in features}
        points = [i / MOST_BINS for i in range(1, MOST_BINS)]
        row = df.agg(F.count(label).alias("n"), F.sum(F.col(label).cast("double")).alias("b"), *(F.percentile_approx(no_nan(f), points, 100_000).alias(f) for f in features if f not in woe)).first()
        if not row["b"] or row["b"] == row["n"]:
            raise ValueError("both classes are needed")
        heavy = p.positive * (row["n"] - row["b"]) / row["b"]
        model = Booster({f: category_cuts(woe[f]) if f in woe else sorted(set(row[f] or [])) for f in features}, 0.0, woe=woe)
        mark = F.xxhash64(*(F.col(key) if key else F.col(f) for f in ([key] if key else features)))
        rows = settled(model.binned(df.where(F.col(label).isNotNull()).select(*features, F.col(label).cast("double").alias("_y"), mark.alias("_key"))).select("_y", "_key", F.lit(float(model.base)).alias("_m"), *(f"_b_{f}" for f in features)))
        draw = random.Random(p.seed)
        margin = F.col("_m")
        for t in range(p.trees):
            used = draw.sample(list(features), max(1, round(p.colsample * len(features))))
            q = 1 / (1 + F.exp(-F.col("_m")))
            w = F.when(F.col("_y") == 1, F.lit(heavy)).otherwise(1.0)
            part = rows.withColumn("_m", margin).where(F.pmod(F.xxhash64("_key", F.lit(p.seed + t)), F.lit(1000)) < int(1000 * p.subsample))
            part = part.select((w * (q - F.col("_y"))).alias("g"), F.greatest(w * q * (1 - q), F.lit(1e-16)).alias("h"), *(f"_b_{f}" for f in features))
            model.trees.append(model._tree(part, used, p, monotone))
            margin = margin + model._value(model.trees[-1])
            if (t + 1) % SETTLE_TREES == 0 and t + 1 < p.trees:
                rows, margin = settled(rows.withColumn("_m", margin)), F.col("_m")
        return model

    def _tree(self, part: DataFrame, used: Sequence[str], p: BoosterParams, monotone: dict[str, int]) -> dict:
        root: dict = {"low": -math.inf, "high": math.inf}
        open_ = [root]
        for depth in range(max(p.depth, 1)):
            if not open_:
                break
            for i, n in enumerate(open_):
                n["id"] = i
            at = self._place(root)
            long = part.withColumn("_node", at).where("_node >= 0").select("_node", "g", "h", F.inline(F.array(*[F.struct(F.lit(i).alias("f"), F.col(f"_b_{f}").alias("b")) for i, f in enumerate(used)])))
            sums: dict[int, dict[str, dict[int, tuple[float, float]]]] = defaultdict(lambda: defaultdict(dict))
            for r in long.groupBy("_node", "f", "b").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():
                sums[r["_node"]][used[r["f"]]][r["b"]] = (r["g"], r["h"])
            following = []
            for n in open_:
                n["cover"] = sum(h for _, h in next(iter(sums[n["id"]].values()), {}).values())
                n.update(self._split(sums[n["id"]], p, monotone, n, depth < p.depth))
                if "left" in n:
                    following += [n["left"], n["right"]]
            if depth + 1 >= p.depth:
                for n in following:
                    n.update(leaf=self._weight(n["g"], n["h"], p, n["low"], n["high"]), cover=n["h"])
            open_ = following
        return self._clean(root, p.rate)

    def _place(self, node: dict) -> Column:
        return F.expr(self._text(node, lambda n: "-1" if "leaf" in n else None if "left" in n else str(n["id"])))

    @staticmethod
    def _weight(g: float, h: float, p: BoosterParams, low: float, high: float) -> float:
        shrunk = math.copysign(max(abs(g) - p.alpha, 0.0), g)
        return min(max(-shrunk / (h + p.ridge), low), high)

    @staticmethod
    def _gain(g: float, h: float, w: float, p: BoosterParams) -> float:
        return -(2 * g * w + (h + p.ridge) * w * w) - 2 * p.alpha * abs(w)

    def _split(self, sums: dict[str, dict[int, tuple[float, float]]], p: BoosterParams, monotone: dict[str, int], node: dict, may: bool) -> dict:
        low, high = node["low"], node["high"]
        some = next(iter(sums.values()), {})
        G, H = sum(g for g, _ in some.values()), sum(h for _, h in some.values())
        whole = self._weight(G, H, p, low, high)
        best: tuple[float, dict] | None = None
        for f, bins in sorted(sums.items()) if may else ():
            mg, mh = bins.get(-1, (0.0, 0.0))
            neutral = bisect.bisect_left(self.cuts[f], 0.0) if f in self.woe else None
            gl = hl = 0.0
            known = sorted(b for b in bins if b >= 0)
            for b in known[:-1] if mh == 0 else known:
                gl, hl = gl + bins[b][0], hl + bins[b][1]
                for missing_left in (False, True) if mh else (neutral is not None and neutral <= b,):
                    lg, lh = (gl + mg, hl + mh) if missing_left else (gl, hl)
                    if min(lh, H - lh) < p.least_hessian:
                        continue
                    wl, wr = self._weight(lg, lh, p, low, high), self._weight(G - lg, H - lh, p, low, high)
                    way = monotone.get(f, 0)
                    if way * (wr - wl) < 0:
                        continue
                    gain = 0.5 * (self._gain(lg, lh, wl, p) + self._gain(G - lg, H - lh, wr, p) - self._gain(G, H, whole, p)) - p.gamma
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-12):
                        middle = (wl + wr) / 2
                        sides = [{"low": low, "high": high, "g": g, "h": h} for g, h in ((lg, lh), (G - lg, H - lh))]
                        if way:
                            sides[0]["high" if way > 0 else "low"] = middle
                            sides[1]["low" if way > 0 else "high"] = middle
                        best = (gain, {"feature": f, "bin": b, "missing_left": missing_left, "gain": gain, "left": sides[0], "right": sides[1]})
        return best[1] if best else {"leaf": whole}

    def _clean(self, node: dict, rate: float) -> dict:
        if "leaf" in node:
            return {"leaf": node["leaf"] * rate, "cover": node["cover"]}
        return {k: node[k] for k in ("feature", "bin", "missing_left", "gain", "cover")} | {s: self._clean(node[s], rate) for s in ("left", "right")}


def category_cuts(woe: dict[str, float]) -> list[float]:
    """Cuts midway between different weights of evidence, evenly thinned to MOST_BINS bins."""
    w = sorted(set(woe.values()))
    between = [(a + b) / 2 for a, b in zip(w, w[1:])]
    step = max(1.0, len(between) / (MOST_BINS - 1))
    return [between[int(i * step)] for i in range(min(len(between), MOST_BINS - 1))]


def booster_space(trees: tuple[int, int] = (100, 500)) -> tuple[Dimension, ...]:
    return (
        Dimension("trees", *trees, whole=True), Dimension("depth", 3, 7, whole=True), Dimension("rate", 0.01, 0.3, log=True), Dimension("subsample", 0.6, 1.0),
        Dimension("colsample", 0.6, 1.0), Dimension("least_hessian", 1, 10, whole=True), Dimension("gamma", 0.0, 5.0), Dimension("positive", 0.5, 2.0),
    )


def tune_booster(train: DataFrame, inner: DataFrame, features: Sequence[str], label: str = "label", trials: int = 10, seed: int = 42, monotone: dict[str, int] | None = None, trees: tuple[int, int] = (100, 500), woe: dict[str, dict[str, float]] | None = None, search: Search | None = None) -> BoosterParams:
    """The parameters of best KS on `inner`, by a Parzen estimator; `search` may hold earlier trials and gets the new ones."""
    from riskloom.operators import metrics

    search = search or Search(booster_space(trees), seed)

    def value(given: dict) -> float | None:
        model = Booster.fit(train, features, label, BoosterParams(**given, seed=seed), monotone, woe=woe)
        return metrics.ks(model.score(inner, "_p"), "_p", label).first()["ks"]

    return BoosterParams(**search.run(value, trials), seed=seed)


def monotone_constraints(df: DataFrame, features: Sequence[str], label: str = "label", least: float = 0.02) -> dict[str, int]:
    """The sign of each feature's rank correlation with the label, where it is at least `least`."""
    from riskloom.operators.eda import spearman_pairs

    out = {}
    for f in features:
        c = spearman_pairs(df.select(f, F.col(label).cast("double").alias(label)), [f, label]).first()["correlation"]
        if c is not None and not math.isnan(c) and abs(c) >= least:
            out[f] = 1 if c > 0 else -1
    return out
