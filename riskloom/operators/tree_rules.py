"""Rules from the leaves of one decision tree.

The tree grows level by level. Each node draws its own features from a seed; Spark sums the labels of
all open nodes by feature and value, and the search over them finds the same thresholds as one over
all values. Rows of the two classes weigh the same in all.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.expressions import no_nan
from riskloom.operators.binning import long_form, searched, split_gain
from riskloom.operators.ordered import quantiles
from riskloom.operators.rules import CHUNK, Condition, Rule, rule_mask
from riskloom.session import settled


def _place(tree: dict, node: int = 1) -> Column:
    """The number of the leaf of a row: the children of node i are 2i (up to the threshold) and 2i + 1."""
    if node not in tree:
        return F.lit(node)
    feature, threshold = tree[node]
    return F.when(F.col(feature) <= threshold, _place(tree, 2 * node)).otherwise(_place(tree, 2 * node + 1))


def grow_tree(rows: DataFrame, features: Sequence[str], label: str, depth: int, most_features: int, leaf: int, weights: tuple[float, float], seed: int) -> dict[int, tuple[str, float]]:
    """The feature and threshold of each inner node, numbered from 1. Of equal gains the first feature of the node's draw wins.

    A node looks at `most_features` features that it draws, and at the next ones only if those can't split it.
    """
    tree: dict[int, tuple[str, float]] = {}
    order = {1: random.Random(f"{seed}/1").sample(list(features), len(features))}
    for level in range(depth):
        at = 0
        while order:
            drawn = {n: o[at : at + most_features] for n, o in order.items() if o[at : at + most_features]}
            if not drawn:
                break
            node = _place(tree)
            pairs = F.map_from_entries(F.array(*[F.struct(F.lit(n).alias("k"), F.array(*map(F.lit, fs)).alias("v")) for n, fs in drawn.items()]))
            long = long_form(rows.withColumn("_node", node), features, ("_node", F.col(label).alias("label")))
            asked = long.where(F.array_contains(F.try_element_at(pairs, F.col("_node")), F.col("feature")))
            found = searched(asked.select(F.concat_ws("/", "_node", "feature").alias("group"), "value", "label"), 2, leaf, weights)
            for n, fs in drawn.items():
                gains = [(split_gain(r, cuts[0], weights), -i, f, cuts[0]) for i, f in enumerate(fs) for cuts, r in [found.get(f"{n}/{f}", ([], None))] if cuts]
                if gains:
                    _, _, f, cut = max(gains)
                    tree[n] = (f, round(cut, 6))
            order = {n: o for n, o in order.items() if n not in tree}
            at += most_features
        ends = [c for n in tree if n.bit_length() == level + 1 for c in (2 * n, 2 * n + 1)]
        order = {c: random.Random(f"{seed}/{c}").sample(list(features), len(features)) for c in ends}
        if not ends:
            break
    return tree


def mine_tree_rules(df: DataFrame, features: Sequence[str], label: str = "label", depth: int = 3, most_features: int = 3, leaf: int = 50, most_coverage: float = 0.05, least_lift: float = 2.0, least_hits: int = 5, seed: int = 42) -> list[Rule]:
    """Leaves of a tree with balanced weights whose unrounded coverage and lift pass, best lift first.

    Missing values are the feature's median in the tree; each condition carries it, so a rule means
    the same wherever it is evaluated.
    """
    row = df.agg(F.count(label).alias("n"), F.sum(label).alias("b")).first()
    n, b = row["n"], row["b"]
    if not n or not 0 < b < n:
        return []
    found = {r["feature"]: r["q"][0] for r in quantiles(long_form(df, features, ()), "value", [0.5], ["feature"]).collect()}
    median = {f: found.get(f) or 0.0 for f in features}
    rows = settled(df.where(F.col(label).isNotNull()).select(F.col(label).alias("_label"), *(F.coalesce(no_nan(f), F.lit(float(median[f]))).alias(f) for f in features)))
    tree = grow_tree(rows, features, "_label", depth, min(most_features, len(features)), leaf, (n / (2 * (n - b)), n / (2 * b)), seed)
    paths: list[tuple[Condition, ...]] = []

    def walk(node: int, path: tuple[Condition, ...]) -> None:
        if node not in tree:
            paths.extend([path] if path else [])
            return
        f, t = tree[node]
        walk(2 * node, (*path, Condition(f, "<=", t, median[f])))
        walk(2 * node + 1, (*path, Condition(f, ">", t, median[f])))

    walk(1, ())
    rules = [Rule(p, "tree", i) for i, p in enumerate(paths)]
    kept = []
    for start in range(0, len(rules), CHUNK):
        part = rules[start : start + CHUNK]
        masks = [rule_mask(r, df.columns) for r in part]
        sums = df.where(F.col(label).isNotNull()).agg(*(c for i, m in enumerate(masks) for c in (F.count_if(m).alias(f"h{i}"), F.sum(F.when(m, F.col(label)).otherwise(0)).alias(f"b{i}")))).first()
        for i, r in enumerate(part):
            h, hb = sums[f"h{i}"], sums[f"b{i}"]
            coverage, bad = h / n, hb / h if h else 0.0
            if coverage <= most_coverage and bad / (b / n) >= least_lift and h >= least_hits:
                kept.append((-bad / (b / n), r.text, {"coverage": round(coverage, 4), "hit_count": h, "bad_rate": round(bad, 4), "lift": round(bad / (b / n), 4)}, r))
    return [Rule(r.conditions, "tree", i, s) for i, (_, _, s, r) in enumerate(sorted(kept, key=lambda x: x[:2]))]
