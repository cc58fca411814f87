import math

import pytest
from pyspark.sql import functions as F

from riskloom.operators.boosting import Booster, BoosterParams
from riskloom.plans import queries
from tests.test_large_tables import _frame


def test_gbt_scores_fits_all_trees(spark, monkeypatch):
    asked = []

    class Known(Exception):
        pass

    def fit(df, features, label="label", params=None, *a, **k):
        asked.append(params or BoosterParams())
        raise Known

    monkeypatch.setattr(Booster, "fit", staticmethod(fit))
    with pytest.raises(Known):
        queries.gbt_scores(spark.createDataFrame([("train", 1)], "split string, label int"))
    assert asked == [BoosterParams()] and asked[0].trees == 80


def test_leaves_come_from_the_sums_of_the_last_splits(spark, monkeypatch):
    df = _frame(spark).withColumnRenamed("v", "odd name")
    passes = []
    monkeypatch.setattr(Booster, "_place", lambda self, root, _f=Booster._place: passes.append(1) or _f(self, root))
    p = BoosterParams(trees=1, depth=2, rate=1.0, subsample=1.0, colsample=1.0, least_hessian=1, gamma=0, alpha=0.3, ridge=4.0)
    m = Booster.fit(df, ["u", "odd name", "w"], "label", p, key="k")
    assert len(passes) == 2
    n, bad = df.count(), df.where("label = 1").count()
    heavy = (n - bad) / bad
    leaves = {}

    def walk(node):
        if "leaf" in node:
            leaves[round(node["leaf"], 9)] = node["cover"]
        else:
            walk(node["left"])
            walk(node["right"])

    walk(m.trees[0])
    assert len(leaves) > 2
    rows = m.binned(df).withColumn("m", F.round(m.margin(), 9)).groupBy("m").agg(F.count_if(F.col("label") == 1).alias("b"), F.count_if(F.col("label") == 0).alias("g")).collect()
    assert {r["m"] for r in rows} == set(leaves)
    for r in rows:
        g, h = 0.5 * (r["g"] - heavy * r["b"]), 0.25 * (r["g"] + heavy * r["b"])
        assert abs(h - leaves[r["m"]]) < 1e-6 and abs(r["m"] + math.copysign(max(abs(g) - 0.3, 0), g) / (h + 4)) < 1e-6
