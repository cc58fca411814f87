"""The application table that queries run on: one row an order, made from the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.operators.splits import stratified_split
from riskloom.session import settled

NUMERIC = ("total_price", "acct_bal", "n_items", "sum_qty", "avg_disc", "price_copy", "drifting")
CATEGORICAL = ("channel", "priority", "region")
DRIFT_FROM = "1997-01-01"


def in_stored_order(df: DataFrame, key: str) -> DataFrame:
    """The rows of Parquet files parted by `key`, those of a key next to each other and in the order of the files' names and rows.

    Sums of doubles over them don't depend on how files are cut into row groups and tasks.
    """
    df = df.withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})
    if len(df.inputFiles()) > 1:
        files = df.select("_file").distinct().select("_file", F.row_number().over(W.orderBy("_file")).alias("_nth"))
        df = df.join(F.broadcast(files), "_file")
    else:
        df = df.withColumn("_nth", F.lit(1))
    return df.drop("_file").repartition(key).sortWithinPartitions(key, "_nth", "_row").drop("_nth", "_row")


def load_apps(spark: SparkSession, folder: str) -> DataFrame:
    """app_id, apply_time, features, label, model_score, split.

    The joined rows are written once; every pass of a query reads the columns that it needs from there.
    """
    read = lambda name: spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    lines = in_stored_order(read("lineitem").select("l_orderkey", "l_quantity", "l_discount"), "l_orderkey")
    items = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").cast("int").alias("n"), F.sum("l_quantity").alias("sum_qty"), F.avg("l_discount").alias("avg_disc"))
    places = read("nation").join(F.broadcast(read("region")), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    people = read("customer").join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_acctbal", "c_mktsegment", "r_name")
    key, tp = F.col("o_orderkey"), F.col("o_totalprice") / F.lit(500000.0)
    qty = F.coalesce("sum_qty", F.lit(0.0))
    rows = read("orders").join(people, F.col("o_custkey") == F.col("c_custkey")).join(items, "o_orderkey", "left")
    apps = rows.select(
        key.alias("app_id"), F.col("o_orderdate").alias("apply_time"), F.col("o_totalprice").alias("total_price"),
        F.when(key % 20 != 0, F.col("c_acctbal")).alias("acct_bal"), F.coalesce("n", F.lit(0)).alias("n_items"), "sum_qty", "avg_disc",
        (F.lit(0.95) * F.col("o_totalprice") + (key % 97)).alias("price_copy"),
        ((key % 100) / F.lit(100.0) + F.when(F.col("o_orderdate") >= F.lit(DRIFT_FROM).cast("timestamp_ntz"), 5.0).otherwise(0.0)).alias("drifting"),
        F.when(key % 50 != 0, F.col("c_mktsegment")).alias("channel"), F.col("o_orderpriority").alias("priority"), F.col("r_name").alias("region"),
        (F.lit(100.0) * tp * tp * tp + qty / F.lit(10.0) + ((key * 7919) % 1000) / F.lit(12.0) > 105).cast("int").alias("label"),
        F.round(1 / (1 + F.exp(-(F.lit(10.0) * tp + qty / F.lit(200.0) - F.lit(9.0)))), 12).alias("model_score"),
    )
    return stratified_split(settled(apps), "label", (F.col("app_id") * 7919) % 100003, "app_id")


#: The same table for DuckDB, as the head of every query's SQL.
APPS_SQL = f"""
WITH items AS (
  SELECT l_orderkey, CAST(count(*) AS INTEGER) AS n, sum(l_quantity) AS sum_qty, avg(l_discount) AS avg_disc FROM lineitem GROUP BY 1
), base AS (
  SELECT o_orderkey AS app_id, o_orderdate AS apply_time, o_totalprice AS total_price,
    CASE WHEN o_orderkey % 20 <> 0 THEN c_acctbal END AS acct_bal, coalesce(n, 0) AS n_items, sum_qty, avg_disc,
    CAST(0.95 AS DOUBLE) * o_totalprice + (o_orderkey % 97) AS price_copy,
    (o_orderkey % 100) / CAST(100 AS DOUBLE) + CASE WHEN o_orderdate >= TIMESTAMP '{DRIFT_FROM} 00:00:00' THEN CAST(5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS drifting,
    CASE WHEN o_orderkey % 50 <> 0 THEN c_mktsegment END AS channel, o_orderpriority AS priority, r_name AS region,
    CAST(CASE WHEN CAST(100 AS DOUBLE) * (o_totalprice / CAST(500000 AS DOUBLE)) * (o_totalprice / CAST(500000 AS DOUBLE)) * (o_totalprice / CAST(500000 AS DOUBLE))
      + coalesce(sum_qty, 0) / CAST(10 AS DOUBLE) + ((o_orderkey * 7919) % 1000) / CAST(12 AS DOUBLE) > 105 THEN 1 ELSE 0 END AS INTEGER) AS label,
    round(1 / (1 + exp(-(CAST(10 AS DOUBLE) * (o_totalprice / CAST(500000 AS DOUBLE)) + coalesce(sum_qty, 0) / CAST(200 AS DOUBLE) - CAST(9 AS DOUBLE)))), 12) AS model_score
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN items ON o_orderkey = l_orderkey
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY (app_id * 7919) % 100003, app_id) AS rn, count(*) OVER (PARTITION BY label) AS cn FROM base
), apps AS (
  SELECT * EXCLUDE (rn, cn), CASE WHEN rn <= floor(cn * CAST(0.7 AS DOUBLE)) THEN 'train' WHEN rn <= floor(cn * CAST(0.85 AS DOUBLE)) THEN 'test' ELSE 'valid' END AS split FROM ranked
)
"""
