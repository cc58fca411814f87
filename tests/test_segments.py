"""Segments' thresholds and other small facts as tables of any size."""

import pytest
from pyspark.sql import functions as F

from riskloom.operators import joins, policy, scoring
from riskloom.operators.rules import Condition, Rule

OVERRIDES = [
    {"segment_feature": "c", "segment_value": "a", "reject_threshold": 0.7, "review_threshold": 0.5},
    {"segment_feature": "d", "segment_value": "1", "reject_threshold": 0.9, "review_threshold": 0.2},
    {"segment_feature": "c", "segment_value": None, "reject_threshold": 0.4, "review_threshold": 0.3},
    {"segment_feature": "c", "segment_value": "b", "reject_threshold": 0.6, "review_threshold": 0.1},
    {"segment_feature": "c", "segment_value": "a", "reject_threshold": 0.65, "review_threshold": 0.55},
]
POLICY = {"score_thresholds": {"reject": 0.8, "review": 0.6}, "segment_overrides": OVERRIDES, "reject_rules": [Rule((Condition("x", ">", 95.0),)).document()]}


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(i, [None, "a", "b", "null", ""][i % 5], [1, 2, None][i % 3], float(i % 100), i % 101 / 100, i % 2, ["train", "test", "valid"][i % 7 % 3]) for i in range(3000)]
    return spark.createDataFrame(rows, "app_id long, c string, d int, x double, model_score double, label int, split string").repartition(4).cache()


def decided(df, **more):
    return sorted(map(tuple, scoring.apply_policy(df, POLICY, **more).select("app_id", "decision", "reject_threshold", "review_threshold", "hit_rules").collect()))


def test_a_table_of_segments_decides_as_the_document(spark, scored, monkeypatch):
    plain = decided(scored)
    table = policy.segment_table(spark, OVERRIDES)
    assert decided(scored, segments=table) == plain
    assert scoring.apply_policy(scored, POLICY, segments=table).columns == scoring.apply_policy(scored, POLICY).columns
    monkeypatch.setattr(scoring, "MOST_INLINE", 1)
    assert decided(scored) == plain
    for names in ({"SMALL": 0}, {"SMALL": 0, "HOT_ROWS": 10, "HOT_KEYS": 4}):  # by shuffle, and with hot values apart
        for k, v in names.items():
            monkeypatch.setattr(joins, k, v)
        assert decided(scored, segments=table) == plain
    assert decided(scored, segments=table.limit(0)) == sorted((*r[:1], *r[1:]) for r in decided(scored, segments=policy.segment_table(spark, [])))


def test_strategies_compare_alike(spark, scored):
    picked = [o for o in OVERRIDES if o["segment_feature"] == "c"][1:]
    plain = policy.compare_strategies(scored, [], {"reject": 0.8, "review": 0.6}, picked, replace=True)
    table = policy.compare_strategies(scored, [], {"reject": 0.8, "review": 0.6}, policy.segment_table(spark, picked), replace=True)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, table.collect())) and table.count() == 12


def test_a_hundred_thousand_segments(spark):
    n = 100_001
    keys = spark.range(n).select(F.col("id").alias("position"), F.lit("k").alias("segment_feature"), F.concat(F.lit("v"), "id").alias("segment_value"), (F.col("id") % 90 / 100).alias("reject_threshold"), F.lit(0.0).alias("review_threshold"))
    df = spark.range(0, 3 * n, 7).select(F.when(F.col("id") % 3 == 0, F.lit("v5")).otherwise(F.concat(F.lit("v"), F.col("id") % (2 * n))).alias("k"), F.lit(0.5).alias("model_score"))
    got = scoring.apply_policy(df, {"score_thresholds": {"reject": 0.8, "review": 0.6}}, segments=keys)
    want = df.withColumn("v", F.expr("CAST(substring(k, 2) AS LONG)")).select(F.when(F.col("v") >= n, "approve").when(F.col("v") % 90 / 100 <= 0.5, "reject").otherwise("review").alias("decision"))
    counts = lambda x: {r[0]: r[1] for r in x.groupBy("decision").count().collect()}
    assert counts(got) == counts(want) and got.count() == df.count()


def test_looked_up_keeps_every_row(spark, monkeypatch):
    rows = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("", 4), ("zz", 5)], "k string, i int")
    table = spark.createDataFrame([("a", 10), (None, 30), ("", 40)], "k string, w int")
    want = {(1, 10), (2, 10), (3, 30), (4, 40), (5, None)}
    got = lambda: {(r["i"], r["m"]["w"] if r["m"] else None) for r in joins.looked_up(rows, table, F.col("k"), "k", "m").collect()}
    assert got() == want
    monkeypatch.setattr(joins, "SMALL", 1)
    monkeypatch.setattr(joins, "HOT_ROWS", 1)
    assert got() == want
    assert joins.looked_up(rows.limit(0), table, F.col("k"), "k", "m").count() == 0
