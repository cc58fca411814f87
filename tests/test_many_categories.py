"""The encoder with more categories than a document should hold."""

import math

import pytest
from pyspark.sql import functions as F

from riskloom.operators import encoder as E
from riskloom.operators import joins
from riskloom.operators.models import Scorecard, fit_logistic


@pytest.fixture(scope="module")
def rows(spark):
    given = [(i, ["hot", None, "", f"v{i % 300}"][i % 4 if i % 4 < 3 else 3], float(i % 17), int((i * 7919 + (i % 4) * 300) % 1000 > 650)) for i in range(6000)]
    return spark.createDataFrame(given, "app_id long, shop string, x double, label int").repartition(4).cache()


def plain_woe(rows):
    bad, all_ = {}, {}
    for r in rows.collect():
        if r["shop"] is not None:
            bad[r["shop"]] = bad.get(r["shop"], 0) + r["label"]
            all_[r["shop"]] = all_.get(r["shop"], 0) + 1
    tb = sum(bad.values())
    tg = sum(all_.values()) - tb
    floor = lambda x: x or 1e-6
    return {k: math.log(floor((all_[k] - bad[k]) / tg) / floor(bad[k] / tb)) for k in all_}


def test_table_and_document_encode_alike(rows, monkeypatch):
    plain = plain_woe(rows)
    small = E.WoeEncoder.fit(rows, ("x",), ("shop",))
    assert small.large == [] and small.table is None
    assert small.categories["shop"].keys() == plain.keys() and all(abs(small.categories["shop"][k] - v) < 1e-9 for k, v in plain.items())
    monkeypatch.setattr(E, "MOST_CATEGORIES", 10)
    large = E.WoeEncoder.fit(rows, ("x",), ("shop",))
    assert large.large == ["shop"] and not large.categories and large.features == ["x", "shop"]
    again = E.WoeEncoder.loads(large.dumps(), large.table)
    fresh = rows.unionByName(rows.limit(1).withColumn("shop", F.lit("unseen")))
    want = sorted(map(tuple, small.transform(fresh).select("app_id", "shop", "x").collect()))
    for limits in ({}, {"SMALL": 5}, {"SMALL": 5, "HOT_ROWS": 50, "HOT_KEYS": 10}):
        for k, v in limits.items():
            monkeypatch.setattr(joins, k, v)
        got = again.transform(fresh)
        assert sorted(map(tuple, got.select("app_id", "shop", "x").collect())) == want and got.columns == fresh.columns


def test_scorecard_of_a_large_feature(spark, rows, monkeypatch):
    card = fit_logistic(rows, E.WoeEncoder.fit(rows, ("x",), ("shop",)), ["x", "shop"])
    monkeypatch.setattr(E, "MOST_CATEGORIES", 10)
    large = fit_logistic(rows, E.WoeEncoder.fit(rows, ("x",), ("shop",)), ["x", "shop"])
    assert all(abs(a - b) < 1e-6 for a, b in zip(card.coefficients, large.coefficients))
    loaded = Scorecard.loads(large.dumps(), spark, large.encoder.table)
    pairs = card.score(rows).select("app_id", F.col("model_score").alias("a")).join(loaded.score(rows), "app_id")
    assert pairs.where(F.abs(F.col("a") - F.col("model_score")) > 1e-6).count() == 0 and loaded.score(rows).columns == [*rows.columns, "model_score"]
    points = lambda c: sorted((r["feature"], r["bin"], round(r["points"], 1)) for r in c.scorecard().collect())
    assert points(card) == points(large)


def test_a_million_categories(spark):
    n = 1_000_000
    df = spark.range(2 * n).select(F.concat(F.lit("c"), F.col("id") % n).alias("c"), (F.col("id") % 3 == 0).cast("int").alias("label"))
    e = E.WoeEncoder.fit(df, (), ("c",))
    assert e.large == ["c"] and e.table.count() == n
    got = e.transform(df).agg(F.count("*"), F.count_if(F.col("c") == 0), F.count_distinct("c")).first()
    assert got[0] == 2 * n and got[1] == 0 and 2 <= got[2] <= 3
