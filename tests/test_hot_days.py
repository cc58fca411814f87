"""Ranks over a whole table where one day, or one missing time, holds most rows."""

import pytest
from pyspark.sql import functions as F

from riskloom.operators import ordered, splits


@pytest.fixture(scope="module")
def rows(spark):
    """Two thirds of the rows in one day, a sixth without a time, two keys missing."""
    day = F.when(F.col("id") % 6 < 4, F.lit("2024-05-05 00:00:00")).when(F.col("id") % 6 == 4, F.concat(F.lit("2024-0"), F.col("id") % 9 + 1, F.lit("-01 00:00:00")))
    df = spark.range(6000).select(F.col("id"), F.to_timestamp(day).alias("day"), F.when(F.col("id") > 1, F.pmod(F.col("id") * 7919, F.lit(100_003))).alias("key"))
    return df.withColumn("t", F.when(F.col("id") % 6 < 2, F.col("day")).otherwise(F.col("day") + F.expr("make_interval(0, 0, 0, 0, 0, 0, id % 500)"))).repartition(5).cache()


def plain(rows):
    known = rows.select("id", "t", "key").collect()
    known.sort(key=lambda r: (r["t"] is None, str(r["t"]), r["key"] is None, r["key"] or 0))
    return {r["id"]: i + 1 for i, r in enumerate(known)}


def test_parted_days_rank_alike(rows, monkeypatch):
    want = plain(rows)
    rank = lambda: ordered.bucketed_rank(rows.withColumn("_one", F.lit(1)), ["_one"], F.to_date("t"), ["t", "key"], "rank", "size")
    assert {r["id"]: r["rank"] for r in rank().collect() if r["key"] is not None}.items() <= want.items()
    split = splits.time_split(rows, "t", "key")
    before = {r["id"]: r["split"] for r in split.collect() if r["key"] is not None}
    monkeypatch.setattr(ordered, "LARGE_BUCKET", 100)
    got = rank().collect()
    assert len(got) == 6000 and sorted(r["rank"] for r in got) == list(range(1, 6001)) and {r["size"] for r in got} == {6000}
    assert {r["id"]: r["rank"] for r in got if r["key"] is not None}.items() <= want.items()
    assert {r["id"]: r["split"] for r in splits.time_split(rows, "t", "key").collect() if r["key"] is not None} == before
    assert rank().columns == [*rows.columns, "_one", "rank", "size"]


def test_a_hot_day_is_spread_over_parts(rows, monkeypatch):
    keyed = rows.withColumn("_one", F.lit(1)).withColumn("_bucket", F.struct(F.to_date("t").isNull().alias("none"), F.to_date("t").alias("at")))
    hot = keyed.groupBy("_one", "_bucket").agg(F.count("*").alias("_n")).where("_n > 500")
    assert hot.count() == 2
    monkeypatch.setattr(ordered, "PARTS", 8)
    sizes = ordered._parted(keyed, hot, ["_one"], ["t", "key"]).groupBy("_bucket").count().collect()
    of_day = [r["count"] for r in sizes if str(r["_bucket"]["at"]) == "2024-05-05"]
    assert sum(of_day) == 4000 and len(of_day) == 8 and max(of_day) < 800
    assert max(r["count"] for r in sizes if r["_bucket"]["none"]) < 400
