"""The forms for large tables give what the plain ones give."""

import numpy as np
from pyspark.sql import functions as F

from riskloom.operators import metrics, splits
from riskloom.operators.ordered import before_borders, bucketed_rank
from riskloom.session import settled


def _frame(spark, n=900):
    rng = np.random.default_rng(5)
    rows = [(i, float(rng.integers(0, 40)) if i % 7 else None, float(rng.normal()) if i % 3 else None, float(i % 5), float(i % 5) if i % 3 else None, int(rng.random() < 0.3), round(float(rng.random()), 2), "ab"[i % 2]) for i in range(n)]
    return spark.createDataFrame(rows, "k long, u double, v double, w double, z double, label int, s double, part string").repartition(3)


def test_settled_rows_are_read_by_column(spark):
    plan = settled(_frame(spark)).select("u")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<u:double>" in plan


def test_split_needs_no_rank_of_the_rows(spark):
    df = settled(_frame(spark))
    out = splits.stratified_split(df, "label", F.pmod(F.col("k") * 7919, F.lit(13)), "k")
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    ranked = bucketed_rank(df, ["label"], F.pmod(F.col("k") * 7919, F.lit(13)), ["k"], "_rank", "_size").withColumn("split", splits._part(splits.RATIOS))
    assert sorted(out.select("k", "split").collect()) == sorted(ranked.select("k", "split").collect())


def test_borders_that_an_expression_cannot_tell(spark):
    rows = lambda x: spark.createDataFrame(x, "label int, b int, k long")
    half = [F.floor(F.col("_size") / 2)]
    assert before_borders(rows([(0, 1, 5)] * 4), "label", F.col("b"), ["k"], half) is None
    assert before_borders(rows([(0, None, i) for i in range(4)]), "label", F.col("b"), ["k"], half) is None
    assert before_borders(rows([(i, 1, i) for i in range(60)]), "label", F.col("b"), ["k"], half) is None
    doubled = splits.stratified_split(rows([(0, 1, 5)] * 20), "label", F.col("b"), "k")
    assert {r["split"]: r["count"] for r in doubled.groupBy("split").count().collect()} == {"train": 14, "test": 3, "valid": 3}
    nulls = rows([(None, 1, i) for i in range(9)] + [(0, 1, None)] + [(0, 1, i) for i in range(9)])
    found = before_borders(nulls, "label", F.col("b"), ["k"], half)
    assert sorted((str(r["label"]), r["k"]) for r in nulls.where(found[0]).collect()) == sorted([("None", i) for i in range(4)] + [("0", i) for i in range(5)])


def test_metrics_from_one_running_total(spark, monkeypatch):
    df = _frame(spark)
    want = {r["part"]: (round(r["auc"], 4), round(r["ks"], 4)) for r in metrics.auc(df, "s", "label", ["part"]).join(metrics.ks(df, "s", "label", ["part"]), "part").collect()}
    calls = []
    monkeypatch.setattr(metrics, "cumulative_by_value", lambda *a, _f=metrics.cumulative_by_value, **k: calls.append(1) or _f(*a, **k))
    assert {r["part"]: (r["auc"], r["ks"]) for r in metrics.model_metrics(df, "s", "label", ("part",)).collect()} == want
    assert len(calls) == 1
