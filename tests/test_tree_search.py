"""Supervised cuts against a plain search over all values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import binning


def gini(n, bad):
    return 2.0 * bad * (n - bad) / n if n else 0.0


def plain_cuts(values, labels, leaves=10, leaf=50):
    """Splits the best leaf of a sorted list of values, one after the other."""
    v, at = np.unique(values, return_inverse=True)
    n, bad = np.bincount(at), np.bincount(at, weights=labels).astype(int)
    cn, cb = np.concatenate(([0], np.cumsum(n))), np.concatenate(([0], np.cumsum(bad)))

    def best(a, b):
        top = (0.0, -1)
        for k in range(a + 1, b):
            l, r = cn[k] - cn[a], cn[b] - cn[k]
            if l >= leaf and r >= leaf:
                g = gini(cn[b] - cn[a], cb[b] - cb[a]) - gini(l, cb[k] - cb[a]) - gini(r, cb[b] - cb[k])
                if g > 1e-12 and g > top[0]:
                    top = (g, k)
        return top

    parts, cuts = {(0, len(v)): best(0, len(v))}, []
    while len(parts) < leaves:
        (a, b), (_, k) = max(parts.items(), key=lambda x: (x[1][0], -x[0][0]))
        if k < 0:
            break
        del parts[a, b]
        parts[a, k], parts[k, b] = best(a, k), best(k, b)
        cuts.append(float((v[k - 1] + v[k]) / 2))
    return sorted(cuts)


def frame_of(spark, **columns):
    import pandas as pd

    return spark.createDataFrame(pd.DataFrame(columns)).repartition(4)


def test_cuts_equal_a_plain_search_at_any_number_of_ranges(spark):
    rng = np.random.default_rng(11)
    n = 100_000
    smooth, steps, noise = rng.permutation(n) / 7, rng.integers(0, 40, n).astype(float), rng.normal(size=n)
    label = (rng.random(n) < 0.1 + 0.3 * (smooth > 3000) + 0.2 * np.sin(smooth / 2000) ** 2 + 0.01 * (steps % 3)).astype(int)
    df = frame_of(spark, smooth=smooth, steps=steps, noise=noise, label=label).cache()
    plain = {f: plain_cuts(x, label) for f, x in (("smooth", smooth), ("steps", steps), ("noise", noise))}
    assert len(np.unique(smooth)) == n and len(plain["smooth"]) == 9
    for ranges in (8, 300):
        assert binning.tree_cuts(df, ["smooth", "steps", "noise"], ranges=ranges) == plain


def test_rounds_are_bounded_and_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x, label = rng.normal(size=3000), rng.integers(0, 2, 3000)
    monkeypatch.setattr(binning, "MOST_REFINED", 3)
    assert binning.tree_cuts(frame_of(spark, x=x, label=label), ["x"], bins=4, ranges=5)["x"] == plain_cuts(x, label, 4)


def test_hot_values_nulls_and_nothing(spark):
    rng = np.random.default_rng(4)
    x = np.where(rng.random(2000) < 0.4, 1.0, np.round(rng.normal(size=2000), 2))
    label = (x + rng.normal(size=2000) > 1).astype(int)
    df = frame_of(spark, x=x, label=label)
    with_nulls = df.unionByName(df.limit(100).withColumn("x", F.lit(None).cast("double"))).unionByName(df.limit(50).withColumn("label", F.lit(None).cast("long")))
    assert binning.tree_cuts(with_nulls, ["x"], ranges=7)["x"] == plain_cuts(x, label)
    assert binning.tree_cuts(df.limit(0), ["x"]) == {"x": []} == binning.tree_cuts(df.withColumn("label", F.lit(1)), ["x"])


@pytest.mark.parametrize("seed", range(30))
def test_bounds_hold_inside_every_range(seed):
    """Whatever cut inside a range gains more than all cuts between ranges, the range is among the open ones."""
    rng = np.random.default_rng(seed)
    n, bad = rng.integers(1, 6, 60), None
    bad = np.minimum(rng.integers(0, 6, 60), n)
    ends = np.sort(rng.choice(np.arange(1, 60), 9, replace=False))
    parts = np.split(np.arange(60), ends)
    r = binning.Ranges(*(np.array(c) for c in zip(*[(p[0], p[-1], n[p].sum(), bad[p].sum(), len(p), 0, i) for i, p in enumerate(parts)])))
    cuts, open_ = binning.search_ranges(r, 2, 5)
    whole = binning.best_first_cuts(np.arange(60.0), np.arange(60.0), n, bad, 2, 5)
    if whole and whole != cuts:
        assert any(parts[i][0] < whole[0] < parts[i][-1] for i in open_)


def plain_tree(columns, labels, depth, leaf, draws, weights):
    """Leaves as lists of (feature, op, threshold), by a search over all values of each node's features."""
    def best(rows, features):
        top = None
        for i, f in enumerate(features):
            x = columns[f][rows]
            for t in np.unique(x)[:-1]:
                left = x <= t
                if left.sum() < leaf or (~left).sum() < leaf:
                    continue
                w = np.where(labels[rows] == 1, weights[1], weights[0])
                part = lambda m: gini(w[m].sum(), (w * labels[rows])[m].sum())  # noqa: B023, E731
                g = part(left | True) - part(left) - part(~left)
                if g > 1e-12 and (top is None or g > top[0] + 1e-12):
                    after = np.unique(x)[np.searchsorted(np.unique(x), t) + 1]
                    top = (g, f, round(float((t + after) / 2), 6))
        return top

    def grow(node, rows, path):
        order = draws(node)
        found = None
        if node.bit_length() <= depth:
            for at in range(0, len(order), 2):
                found = found or best(rows, order[at : at + 2])
        if not found:
            return [path] if path else []
        _, f, t = found
        left = columns[f][rows] <= t
        return grow(2 * node, rows[left], [*path, (f, "<=", t)]) + grow(2 * node + 1, rows[~left], [*path, (f, ">", t)])

    return grow(1, np.arange(len(labels)), [])


def test_tree_rules_equal_a_plain_tree(spark):
    import random

    from riskloom.operators.tree_rules import mine_tree_rules

    rng = np.random.default_rng(8)
    columns = {"a": np.round(rng.normal(size=900), 2), "b": rng.integers(0, 9, 900).astype(float), "c": np.round(rng.random(900), 3)}
    labels = (rng.random(900) < 0.05 + 0.5 * ((columns["a"] > 0.8) & (columns["c"] > 0.4)) + 0.03 * columns["b"]).astype(int)
    df = frame_of(spark, **columns, label=labels)
    draws = lambda n: random.Random(f"7/{n}").sample(["a", "b", "c"], 3)
    n, b = 900, int(labels.sum())
    plain = plain_tree(columns, labels, 3, 20, draws, (n / (2 * (n - b)), n / (2 * b)))
    rules = mine_tree_rules(df, ["a", "b", "c"], depth=3, most_features=2, leaf=20, most_coverage=1.0, least_lift=0.0, least_hits=0, seed=7)
    assert len(plain) >= 5 and sorted([(c.feature, c.op, c.value) for c in r.conditions] for r in rules) == sorted(plain)
    for r in rules:
        hit = np.logical_and.reduce([columns[c.feature] <= c.value if c.op == "<=" else columns[c.feature] > c.value for c in r.conditions])
        assert r.stats["hit_count"] == hit.sum() and abs(r.stats["lift"] - labels[hit].mean() / labels.mean()) < 1e-4
    assert mine_tree_rules(df.withColumn("label", F.lit(0)), ["a"]) == [] == mine_tree_rules(df.limit(0), ["a"])
    none = df.withColumn("a", F.lit(None).cast("double"))
    assert all(c.feature != "a" for r in mine_tree_rules(none, ["a", "b"], most_coverage=1.0, least_lift=0.0) for c in r.conditions)
