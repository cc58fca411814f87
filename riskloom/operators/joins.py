"""Rows met with a table of one row a key, whatever the size of the table and however often a key stands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.session import settled

#: Rows of a table that is sent to all executors at most; their keys are bounded by KEY_BYTES.
SMALL, KEY_BYTES = 100_000, 256
#: Keys treated apart at most, and rows that a key has at least to be one.
HOT_KEYS, HOT_ROWS = 1000, 1000


def _key(c: Column) -> Column:
    return F.struct(c.isNull().alias("none"), F.coalesce(c.cast("string"), F.lit("")).alias("text"))


def looked_up(rows: DataFrame, table: DataFrame, key: Column, on: str, name: str) -> DataFrame:
    """`rows` with the row of `table` that has their key as a struct `name`, null where there is none; null keys meet null.

    A table that is counted to be small goes to all executors. With a larger one, rows of a key that
    very many rows have stay where they are and get theirs by broadcast (there are fewer than HOT_KEYS
    such keys), the rest meet by shuffle. Streams can't be counted and meet by Spark's own choice.
    """
    keyed = rows.withColumn("_key", _key(key))
    other = table.select(_key(F.col(on)).alias("_key"), F.struct(*(c for c in table.columns if c != on)).alias(name))
    if rows.isStreaming:
        return keyed.join(other, "_key", "left").drop("_key")
    size = table.agg(F.count("*").alias("n"), F.max(F.octet_length(F.col(on).cast("string"))).alias("b")).first()
    if size["n"] <= SMALL and (size["b"] or 0) <= KEY_BYTES:
        return keyed.join(F.broadcast(other), "_key", "left").drop("_key")
    counts = settled(keyed.groupBy("_key").agg(F.count("*").alias("_n")))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    hot = settled(counts.where(F.col("_n") > max(HOT_ROWS, total // HOT_KEYS)).select("_key"))
    few = other.join(F.broadcast(hot), "_key", "left_semi")
    stay = keyed.join(F.broadcast(hot), "_key", "left_semi").join(F.broadcast(few), "_key", "left")
    rest = keyed.join(F.broadcast(hot), "_key", "left_anti").join(other.hint("merge"), "_key", "left")
    return rest.unionByName(stay).drop("_key")
