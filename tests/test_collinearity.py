"""The distributed QR decomposition and variance inflation against least squares on the rows themselves."""

import numpy as np
from pyspark.sql import functions as F

from riskloom.operators import eda


def frame_of(spark, a, parts=7):
    import pandas as pd

    return spark.createDataFrame(pd.DataFrame(a, columns=[f"x{i}" for i in range(a.shape[1])])).repartition(parts)


def plain(a, j):
    others = np.delete(a, j, axis=1)
    left = a[:, j] - others @ np.linalg.lstsq(others, a[:, j], rcond=None)[0]
    return (a[:, j] @ a[:, j]) / (left @ left)


def test_nearly_collinear_columns_stay_apart_where_products_fail(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=(3000, 4)) * [1, 1000, 0.01, 5]
    a[:, 3] = 2 * a[:, 0] + 1e-9 * rng.normal(size=3000)
    names = [f"x{i}" for i in range(4)]
    got = {r["feature"]: r["vif"] for r in eda.vif_table(frame_of(spark, a), names).collect()}
    assert np.linalg.cond(a.T @ a / np.outer(*[np.linalg.norm(a, axis=0)] * 2)) > 1e14
    for j, f in enumerate(names):
        assert abs(got[f] / plain(a, j) - 1) < 1e-3, f


def test_factors_merge_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(eda, "FAN", 2)
    rng = np.random.default_rng(5)
    a = rng.normal(size=(500, 3))
    r = eda.triangular_factor(frame_of(spark, a, 9), ["x0", "x1", "x2"])
    assert r.shape == (3, 3) and np.allclose(r.T @ r, a.T @ a)


def test_made_up_and_empty_columns(spark):
    rng = np.random.default_rng(6)
    a = rng.normal(size=(400, 4))
    a[:, 2] = a[:, 0] - 3 * a[:, 1]
    got = {r["feature"]: (r["vif"], r["high_vif"]) for r in eda.vif_table(frame_of(spark, a), ["x0", "x1", "x2", "x3"]).collect()}
    assert all(got[f] == (np.inf, True) for f in ("x0", "x1", "x2")) and abs(got["x3"][0] / plain(a[:, [0, 1, 3]], 2) - 1) < 1e-6 and not got["x3"][1]
    with_nulls = frame_of(spark, a).withColumn("x0", F.when(F.col("x3") > 0, F.col("x0")))
    few = a[a[:, 3] > 0][:, [0, 1, 3]]
    for r in eda.vif_table(with_nulls, ["x0", "x1", "x3"]).collect():
        assert abs(r["vif"] / plain(few, ["x0", "x1", "x3"].index(r["feature"])) - 1) < 1e-6
    none = eda.vif_table(frame_of(spark, a).limit(0), ["x0", "x1"]).collect()
    assert len(none) == 2 and eda.vif_table(frame_of(spark, a), ["x0"]).count() == 0
