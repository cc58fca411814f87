"""Rank correlations of pairs whose missing values differ."""

from riskloom.operators import eda
from tests.test_large_tables import _frame


def test_spearman_of_shared_holes_with_and_without_broadcast(spark, monkeypatch):
    df = _frame(spark)
    features = ["u", "v", "w", "z", "s"]
    want = df.select(*features).toPandas().corr("spearman")
    for small, hot, patterns in ((10**6, 1000, 10_000), (0, 1000, 10_000), (0, 3, 10_000), (0, 3, 1)):
        monkeypatch.setattr(eda, "SMALL", small)
        monkeypatch.setattr(eda, "HOT_ROWS", hot)
        monkeypatch.setattr(eda, "MOST_PATTERNS", patterns)
        found = eda.spearman_pairs(df, features).collect()
        assert [(r[0], r[1]) for r in found] == [(a, b) for i, a in enumerate(features) for b in features[i + 1 :]]
        assert all(abs(r[2] - want.loc[r[0], r[1]]) < 1e-6 for r in found)


def test_spearman_ranks_once(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(eda, "cumulative_by_value", lambda *a, _f=eda.cumulative_by_value, **k: calls.append(1) or _f(*a, **k))
    eda.spearman_pairs(_frame(spark), ["u", "v", "w", "z"]).collect()
    assert len(calls) == 1
