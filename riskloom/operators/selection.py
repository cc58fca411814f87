"""Variable selection: correlation, monotonicity and stability, with the reason for every drop."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from riskloom.operators import binning, eda


def drop_correlated(order: Sequence[str], pairs: Sequence[tuple[str, str, float | None]], iv: dict[str, float], threshold: float = 0.7) -> dict[str, str]:
    """Features to drop, each with the feature it follows: of a correlated pair the one of lower IV, ties keep the first."""
    near = {(a, b) for a, b, c in pairs if c is not None and abs(c) >= threshold}
    dropped: dict[str, str] = {}
    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            if a in dropped:
                break
            if b in dropped or not {(a, b), (b, a)} & near:
                continue
            low, high = (b, a) if iv.get(a, 0.0) >= iv.get(b, 0.0) else (a, b)
            dropped[low] = high
    return dropped


def select_variables(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str, time: str | None, key: str, corr: float = 0.7, least_spearman: float = 0.6, most_psi: float = 0.1) -> DataFrame:
    """feature, status: kept, or why not. Numeric features pass three filters in turn, categorical ones need an IV."""
    stats = binning.woe_iv(df, [*numeric, *categorical], label=label)
    iv = {r["feature"]: r["iv"] for r in binning.iv_ranking(stats).collect()}
    status: dict[str, str] = {}
    pairs = [(r["feature_a"], r["feature_b"], r["correlation"]) for r in eda.spearman_pairs(df, numeric).collect()]
    for f, other in drop_correlated(numeric, pairs, iv, corr).items():
        status[f] = f"dropped: correlated with {other}"
    left = [f for f in numeric if f not in status]
    cut = [f for f in left if f not in binning.few_values(df, left, 10)] if left else []
    mono = {r["feature"]: r["is_monotone"] for r in eda.monotonicity(binning.woe_numeric(df, cut, "tree", label=label)).collect()} if cut else {}
    status |= {f: "dropped: WOE not monotone" for f in left if not mono.get(f, False)}
    left = [f for f in left if f not in status]
    psi = {r["feature"]: r["psi"] for r in eda.half_split_psi(df, left, time, key).collect()} if left else {}
    status |= {f: "dropped: unstable" for f in left if psi.get(f) is None or psi[f] > most_psi}
    status |= {f: "kept" if f in iv else "dropped: no IV" for f in categorical}
    rows = [(f, status.get(f, "kept")) for f in (*numeric, *categorical)]
    return df.sparkSession.createDataFrame(rows, "feature string, status string")
