"""Attributions of a booster's margin to its features: Shapley values along the trees' paths.

A feature that is not in a coalition sends a row down both sides of its splits, in shares of the
training rows' hessians there. For each leaf the features of its path count alone, and a row either
meets a feature's conditions or doesn't; so a leaf's contributions are a small table by the pattern
of met features, made once from the coefficients of a product of linear factors. Rows only look
patterns up, in Arrow batches, without a shuffle; missing values follow the trees' own branches.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from riskloom.operators.boosting import Booster


@dataclass
class Leaf:
    """Features of a path, the bins (from the missing one on) that meet each, and contributions by pattern and feature."""

    features: list[str]
    met: list[np.ndarray]
    table: np.ndarray
    expected: float


def contributions(value: float, shares: Sequence[float]) -> np.ndarray:
    """For each pattern of met features (bit j for feature j) each feature's Shapley value of value * product of
    1 or 0 for features in a coalition, and of shares for the others."""
    m = len(shares)
    weight = [math.factorial(s) * math.factorial(m - 1 - s) / math.factorial(m) for s in range(m)]
    out = np.zeros((1 << m, m))
    for pattern in range(1 << m):
        met = [pattern >> j & 1 for j in range(m)]
        for i in range(m):
            sizes = np.array([1.0])  # by the number of other features in the coalition
            for j in range(m):
                if j != i:
                    sizes = np.convolve(sizes, [shares[j], met[j]])
            out[pattern, i] = value * (met[i] - shares[i]) * float(sizes @ weight)
    return out


def leaves(model: Booster) -> list[Leaf]:
    found: list[Leaf] = []

    def walk(node: dict, path: dict[str, tuple[np.ndarray, float]]) -> None:
        if "leaf" in node:
            shares = [s for _, s in path.values()]
            found.append(Leaf(list(path), [m for m, _ in path.values()], contributions(node["leaf"], shares), node["leaf"] * math.prod(shares)))
            return
        f = node["feature"]
        bins = np.arange(-1, len(model.cuts[f]) + 1)
        left = (bins <= node["bin"]) & (node["missing_left"] | (bins >= 0))
        whole = node["left"]["cover"] + node["right"]["cover"]
        for side, met in (("left", left), ("right", ~left)):
            share = node[side]["cover"] / whole if whole else 0.5
            before, rest = path.get(f, (np.ones(len(bins), bool), 1.0))
            walk(node[side], path | {f: (before & met, rest * share)})

    for tree in model.trees:
        walk(tree, {})
    return found


def base_value(model: Booster) -> float:
    """The margin that is expected of a row of which nothing is known."""
    return model.base + sum(leaf.expected for leaf in leaves(model))


def attributions(model: Booster, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """keep..., shap_<feature> for each feature, shap_base; with it they sum to the margin."""
    paths, names = leaves(model), list(model.cuts)
    base = model.base + sum(leaf.expected for leaf in paths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins = {f: b.column(f"_b_{f}").to_numpy(zero_copy_only=False).astype(np.int64) + 1 for f in names}
            out = {f: np.zeros(b.num_rows) for f in names}
            for leaf in paths:
                pattern = np.zeros(b.num_rows, np.int64)
                for j, (f, met) in enumerate(zip(leaf.features, leaf.met)):
                    pattern |= met[bins[f]].astype(np.int64) << j
                for j, f in enumerate(leaf.features):
                    out[f] += leaf.table[pattern, j]
            yield pa.RecordBatch.from_arrays([b.column("row"), *map(pa.array, out.values())], names=["row", *(f"shap_{f}" for f in names)])

    given = model.binned(df).select(F.struct(*keep).alias("row"), *(f"_b_{f}" for f in names))
    schema = StructType([given.schema["row"], *(StructField(f"shap_{f}", DoubleType()) for f in names)])
    return given.mapInArrow(run, schema).select("row.*", *(f"shap_{f}" for f in names), F.lit(float(base)).alias("shap_base"))


def shap_importance(model: Booster, df: DataFrame) -> DataFrame:
    """feature, shap_importance: the mean absolute attribution over all rows; rank 1 is the largest, ties by name."""
    rows = attributions(model, df.withColumn("_row", F.lit(0)), ["_row"])
    means = rows.agg(*(F.avg(F.abs(F.col(f"shap_{f}"))).alias(f) for f in model.cuts))
    return means.select(F.inline(F.array(*(F.struct(F.lit(f).alias("feature"), F.coalesce(F.col(f), F.lit(0.0)).alias("shap_importance")) for f in model.cuts)))).orderBy(F.desc("shap_importance"), "feature")
