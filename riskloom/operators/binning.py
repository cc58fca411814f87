"""Bins, weight of evidence and information value, for many features in one pass.

Features are unpivoted to long rows (feature, value, label), so n features cost one shuffle. Cuts
are small (a few numbers a feature); they reach the rows as literals.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, fields

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.functions.expressions import bin_or_missing, floored, interval_label, iv_label, no_nan, share
from riskloom.operators.ordered import cumulative_by_value, quantiles
from riskloom.session import settled

Cuts = dict[str, list[float]]
#: Ranges that the tree search starts with, parts that a range is made of when it is looked into, and ranges looked into in a round.
TREE_RANGES, FINER, MOST_REFINED = 1024, 32, 4096


def long_form(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ("label",)) -> DataFrame:
    """keep..., feature, value: one row a feature and row, values as doubles without NaN."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), no_nan(f).alias("value")) for f in features])
    return df.select(*keep, F.inline(pairs))


def long_text(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ("label",)) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("value")) for f in features])
    return df.select(*keep, F.inline(pairs))


def quantile_cuts(df: DataFrame, features: Sequence[str], bins: int = 10) -> Cuts:
    """Inner quantiles of each feature, without repeats or the feature's ends."""
    points = [i / bins for i in range(bins + 1)]
    found = quantiles(long_form(df, features, ()), "value", points, ["feature"]).collect()
    out: Cuts = {f: [] for f in features}
    for r in found:
        q = sorted({x for x in r["q"] or [] if x is not None})
        out[r["feature"]] = q[1:-1]
    return out


def uniform_cuts(df: DataFrame, features: Sequence[str], bins: int = 10) -> Cuts:
    """Inner edges of bins of equal width."""
    ends = df.agg(*[f(no_nan(c)).alias(f"{n}_{i}") for i, c in enumerate(features) for n, f in (("low", F.min), ("high", F.max))]).first()
    out: Cuts = {}
    for i, c in enumerate(features):
        low, high = ends[f"low_{i}"], ends[f"high_{i}"]
        out[c] = [] if low is None or low == high else [low + (high - low) * k / bins for k in range(1, bins)]
    return out


def _gini(n: np.ndarray, bad: np.ndarray) -> np.ndarray:
    return np.where(n > 0, 2 * bad * (n - bad) / np.maximum(n, 1), 0.0)


@dataclass
class Ranges:
    """A feature's values in order, in ranges of neighbours; a range of one value can't be cut, others hold `values` of them.

    Ranges are those of a number of equal steps of position, `step` the how manieth; `level` says how fine the steps are.
    """

    first: np.ndarray
    last: np.ndarray
    n: np.ndarray
    bad: np.ndarray
    values: np.ndarray
    level: np.ndarray
    step: np.ndarray

    @staticmethod
    def of(rows: Sequence[Sequence], level: int) -> Ranges:
        """From (first, last, n, bad, values, step)."""
        first, last, n, bad, values, step = (np.array(c, t) for c, t in zip(zip(*sorted(rows)), (float, float, *[np.int64] * 4)))
        return Ranges(first, last, n, bad, values, np.full(len(n), level), step)

    def refined(self, gone: np.ndarray, new: Sequence[Ranges]) -> Ranges:
        """With finer ranges in place of those at `gone`."""
        parts = [np.concatenate([np.delete(getattr(self, f.name), gone), *(getattr(r, f.name) for r in new)]) for f in fields(self)]
        order = np.argsort(parts[0], kind="stable")
        return Ranges(*(p[order] for p in parts))


def split_gain(r: Ranges, cut: float, weights: tuple[float, float] = (1.0, 1.0)) -> float:
    """What a cut between ranges takes off the gini impurity of all rows; `weights` are those of a good and of a bad row."""
    left = r.last < cut
    bad, n = weights[1] * r.bad, weights[0] * (r.n - r.bad) + weights[1] * r.bad
    part = lambda m: float(_gini(np.array([n[m].sum()]), np.array([bad[m].sum()]))[0])
    return part(left | True) - part(left) - part(~left)


def search_ranges(r: Ranges, leaves: int, leaf: int, weights: tuple[float, float] = (1.0, 1.0)) -> tuple[list[float], dict[int, float]]:
    """Cuts of a gini tree that splits its best leaf until it has `leaves`, between ranges; and the ranges inside which a better
    cut may lie, with the most that it can gain.

    Rows weigh as their class does (good, bad); `leaf` counts rows. A gain is a convex function of the rows and bad rows to the left. Inside a range these lie in a parallelogram, with
    corners at the range's ends and where all its bad rows come first or last; no cut inside gains more than the corners.
    """
    total_n, total_bad = np.concatenate(([0], np.cumsum(r.n))), np.concatenate(([0], np.cumsum(r.bad)))
    mixed = (r.values > 1) & (r.bad > 0) & (r.bad < r.n)
    open_: dict[int, float] = {}

    def best(a: int, b: int) -> tuple[float, int]:
        all_n, all_bad = total_n[b] - total_n[a], total_bad[b] - total_bad[a]
        gini = lambda n, bad: _gini(weights[0] * (n - bad) + weights[1] * bad, weights[1] * bad)
        whole = gini(np.array([all_n]), np.array([all_bad]))[0]
        gain = lambda n, bad: whole - gini(n, bad) - gini(all_n - n, all_bad - bad)
        left_n, left_bad = total_n[a + 1 : b] - total_n[a], total_bad[a + 1 : b] - total_bad[a]
        found = np.where((left_n >= leaf) & (all_n - left_n >= leaf), gain(left_n, left_bad), -1.0)
        most, at = (float(found.max()), a + 1 + int(found.argmax())) if len(found) else (0.0, -1)
        if most <= 1e-12:
            most, at = 0.0, -1
        before_n, before_bad, n, bad = total_n[a:b] - total_n[a], total_bad[a:b] - total_bad[a], r.n[a:b], r.bad[a:b]
        inside = mixed[a:b] & (before_n + n > leaf) & (all_n - before_n > leaf)
        bound = np.maximum(np.maximum(gain(before_n + bad, before_bad + bad), gain(before_n + n - bad, before_bad)), np.maximum(gain(before_n, before_bad), gain(before_n + n, before_bad + bad)))
        for i in np.flatnonzero(inside & (bound > 1e-12) & (bound >= most * (1 - 1e-12))):
            open_[a + int(i)] = max(open_.get(a + int(i), 0.0), float(bound[i]))
        return most, at

    parts = {(0, len(r.n)): best(0, len(r.n))}
    cuts = []
    while len(parts) < leaves:
        (a, b), (_, at) = max(parts.items(), key=lambda x: (x[1][0], -x[0][0]))
        if at < 0:
            break
        del parts[a, b]
        parts[a, at], parts[at, b] = best(a, at), best(at, b)
        cuts.append((r.last[at - 1] + r.first[at]) / 2)
    return sorted(float(c) for c in cuts), open_


def best_first_cuts(first: np.ndarray, last: np.ndarray, n: np.ndarray, bad: np.ndarray, leaves: int, leaf: int) -> list[float]:
    """Cuts of a gini tree on a sorted histogram that splits its best leaf until it has `leaves`."""
    one = np.ones(len(n), np.int64)
    return search_ranges(Ranges(first, last, n, bad, one, one, one), leaves, leaf)[0]


def searched(rows: DataFrame, leaves: int, leaf: int, weights: tuple[float, float] = (1.0, 1.0), ranges: int | None = None) -> dict[str, tuple[list[float], Ranges]]:
    """For each group of (group, value, label) the cuts of a gini tree, the same as of a search over all values, and the
    ranges at the end, between which they lie.

    Spark sums the label by value and by ranges of neighbouring values. The search over ranges also
    tells which ranges may hold a better cut; Spark parts these into finer ones, until none may. So
    the driver gets a bounded number of ranges a round, and how many there are at first (`ranges`, else
    TREE_RANGES) changes no cut. A cut lies midway between two neighbouring values.
    """
    ranges = ranges or TREE_RANGES
    cum = cumulative_by_value(rows.where("value IS NOT NULL AND label IS NOT NULL"), ["group"], "value", {"n": F.count("*"), "bad": F.sum("label")})
    spots = settled(cum.select("group", "value", "n", "bad", (F.col("cum_n") - F.col("n")).alias("start"), F.col("all_n").alias("size")))

    def at(level: int) -> Column:
        """The step of a value: which of ranges * FINER^level equal parts its first row lies in."""
        return F.expr(f"CAST(CAST(start AS DECIMAL(19,0)) * CAST({ranges * FINER**level} AS DECIMAL(19,0)) div size AS BIGINT)")

    def summed(part: DataFrame, level: int) -> dict[str, list[tuple]]:
        out: dict[str, list[tuple]] = {}
        sums = part.groupBy("group", at(level).alias("step")).agg(F.min("value").alias("first"), F.max("value").alias("last"), F.sum("n").alias("n"), F.sum("bad").cast("long").alias("bad"), F.count("*").alias("values"))
        for r in sums.collect():
            out.setdefault(r["group"], []).append((r["first"], r["last"], r["n"], r["bad"], r["values"], r["step"]))
        return out

    known = {g: Ranges.of(x, 0) for g, x in summed(spots, 0).items()}
    cuts: dict[str, list[float]] = {}
    wanted = list(known)
    while wanted:
        asked: list[tuple[float, str, int]] = []
        for g in wanted:
            cuts[g], open_ = search_ranges(known[g], leaves, leaf, weights)
            asked += [(-bound, g, i) for i, bound in open_.items()]
        # those beyond the bound have their turn in a later round
        later = {g for _, g, _ in sorted(asked)[MOST_REFINED:]}
        asked = sorted(asked)[:MOST_REFINED]
        finer: dict[str, list[Ranges]] = {g: [] for _, g, _ in asked}
        for level in sorted({int(known[g].level[i]) for _, g, i in asked}):
            steps = [(g, int(known[g].step[i])) for _, g, i in asked if known[g].level[i] == level]
            chosen = rows.sparkSession.createDataFrame(steps, "group string, step long")
            part = spots.withColumn("step", at(level)).join(F.broadcast(chosen), ["group", "step"], "left_semi").drop("step")
            for g, x in summed(part, level + 1).items():
                finer[g].append(Ranges.of(x, level + 1))
        for g in finer:
            known[g] = known[g].refined(np.array([i for _, h, i in asked if h == g]), finer[g])
        wanted = sorted(later | set(finer))
    return {g: (cuts[g], known[g]) for g in known}


def tree_cuts(df: DataFrame, features: Sequence[str], label: str = "label", bins: int = 10, leaf: int = 50, ranges: int | None = None) -> Cuts:
    """Supervised cuts of each feature: those of a search over all its values, at every size of the data."""
    rows = long_form(df, features, (F.col(label).alias("label"),)).withColumnRenamed("feature", "group")
    return {f: [] for f in features} | {g: cuts for g, (cuts, _) in searched(rows, bins, leaf, ranges=ranges).items()}


def cuts_map(cuts: Cuts) -> Column:
    return F.create_map(*[x for f, c in cuts.items() for x in (F.lit(f), F.array(*map(F.lit, c)) if c else F.array().cast("array<double>"))])


def woe_stats(binned: DataFrame, by: Sequence[str] = ("feature",), bin_: str = "bin", label: str = "label") -> DataFrame:
    """Per bin: bad, total, good, their shares, woe, bad_rate, iv_bin, iv. Null bins don't count.

    A share of 0 becomes 1e-6, so every logarithm is finite. Rows without a label count nowhere.
    """
    sums = binned.where(F.col(bin_).isNotNull()).groupBy(*by, bin_).agg(F.coalesce(F.sum(label).cast("long"), F.lit(0).cast("long")).alias("bad"), F.count(label).alias("total"))
    sums = sums.withColumn("good", F.col("total") - F.col("bad"))
    over = W.partitionBy(*by)
    part = lambda c: floored(F.col(c) / F.greatest(F.sum(c).over(over).cast("double"), F.lit(1e-6)))
    out = sums.withColumns({"bad_pct": part("bad"), "good_pct": part("good")})
    out = out.withColumn("woe", F.log(F.col("good_pct") / F.col("bad_pct"))).withColumn("bad_rate", share(F.col("bad"), F.col("total")))
    out = out.withColumn("iv_bin", (F.col("good_pct") - F.col("bad_pct")) * F.col("woe"))
    return out.withColumn("iv", F.sum("iv_bin").over(over))


def cut_features(df: DataFrame, features: Sequence[str], method: str, bins: int, label: str = "label") -> Cuts:
    if method == "quantile":
        return quantile_cuts(df, features, bins)
    if method == "uniform":
        return uniform_cuts(df, features, bins)
    if method == "tree":
        return tree_cuts(df, features, label, bins)
    raise ValueError(f"unknown method {method}")


def woe_numeric(df: DataFrame, features: Sequence[str], method: str = "quantile", bins: int = 10, label: str = "label", cuts: Cuts | None = None) -> DataFrame:
    """woe_stats() of numeric features cut by `method`, with bin_label and bin_interval; missing values are bin -1."""
    cuts = cuts or cut_features(df, features, method, bins, label)
    edges = F.element_at(cuts_map(cuts), F.col("feature"))
    binned = long_form(df, features, (F.col(label).alias("label"),)).withColumn("bin", bin_or_missing(F.col("value"), edges))
    stats = woe_stats(binned)
    return stats.withColumn("bin_interval", interval_label(F.col("bin"), edges)).withColumn("bin_label", F.col("bin").cast("string"))


def woe_categories(df: DataFrame, features: Sequence[str], label: str = "label", missing: str = "missing") -> DataFrame:
    """woe_stats() by value; nulls are a bin of their own."""
    binned = long_text(df, features, (F.col(label).alias("label"),)).withColumn("bin_label", F.coalesce("value", F.lit(missing)))
    return woe_stats(binned, bin_="bin_label").withColumn("bin_interval", F.col("bin_label"))


def few_values(df: DataFrame, features: Sequence[str], bins: int) -> list[str]:
    """Numeric features with no more than `bins` distinct values, which are binned by value."""
    # a feature has at least as many values as bits that their hashes set; only those that may have few are counted by value
    bit = lambda f: F.when(F.col(f).isNotNull(), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(f), F.lit(64)).cast("int")))
    bits = df.agg(*[F.bit_count(F.bit_or(bit(f))).alias(str(i)) for i, f in enumerate(features)]).first()
    features = [f for i, f in enumerate(features) if (bits[i] or 0) <= bins]
    if not features:
        return []
    n = df.agg(*[F.count_distinct(f).alias(str(i)) for i, f in enumerate(features)]).first()
    return [f for i, f in enumerate(features) if n[i] <= bins]


def woe_iv(df: DataFrame, features: Sequence[str], method: str = "quantile", bins: int = 10, label: str = "label") -> DataFrame:
    """feature, bin_label, bin_interval and woe_stats() for features of any kind."""
    kinds = dict(df.dtypes)
    numeric = [f for f in features if kinds[f] not in ("string", "boolean")]
    by_value = {*few_values(df, numeric, bins)} if numeric else set()
    cut = [f for f in numeric if f not in by_value]
    parts: Iterable[DataFrame] = ([woe_numeric(df, cut, method, bins, label).drop("bin")] if cut else []) + ([woe_categories(df, rest, label)] if (rest := [f for f in features if f not in cut]) else [])
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    if out is None:
        raise ValueError("no features")
    return out


def iv_ranking(stats: DataFrame) -> DataFrame:
    """feature, iv, iv_label, iv_rank from woe_iv(), largest first; ties by name."""
    iv = stats.groupBy("feature").agg(F.round(F.max("iv"), 4).alias("iv"))
    return iv.select("feature", "iv", iv_label(F.col("iv")).alias("iv_label"), F.row_number().over(W.orderBy(F.desc("iv"), "feature")).alias("iv_rank"))
