"""Global order without one task that sees all rows.

Ranks, cumulative sums and exact quantiles over a whole table work in two levels: rows are summed
by value, values fall into range buckets, bucket totals (bounded in number) give every bucket its
offset, and windows run inside a bucket only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.functions.expressions import no_nan
from riskloom.session import settled

#: Range buckets of values; their borders are approximate quantiles, so outliers don't crowd the rest into one.
BUCKETS = 256
#: Rows of a bucket above which it may be parted, into how many parts, and rows that the borders are taken from.
LARGE_BUCKET, PARTS, PART_SAMPLE = 1_000_000, 64, 4096


def _meet(rows: DataFrame, offsets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with their bucket's offsets; null keys meet null keys, so no row is lost."""
    named = offsets.select(*(F.col(k).alias(f"_at_{i}") for i, k in enumerate(keys)), *(c for c in offsets.columns if c not in keys))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_at_{i}")) for i, k in enumerate(keys)])
    return rows.join(named, same).drop(*(f"_at_{i}" for i in range(len(keys))))


def _parted(rows: DataFrame, hot: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows with the buckets in `hot` split, as (none, at, part): parts lie between borders taken from a share of the
    bucket's rows, picked by hash; rows that are equal in the order stay together."""
    place = F.struct(*(c for o in order for c in (F.col(o).isNull().alias(f"n_{o}"), F.col(o).alias(f"v_{o}"))))
    keys = [*by, "_bucket"]
    held = hot.select(*keys, "_n")
    sample = _meet(rows.select(*keys, place.alias("_place"), *(F.col(o).alias(f"_o{i}") for i, o in enumerate(order))), F.broadcast(held), keys)
    sample = sample.where(F.pmod(F.xxhash64(*(f"_o{i}" for i in range(len(order)))), F.col("_n")) < PART_SAMPLE)
    listed = sample.groupBy(*keys).agg(F.array_sort(F.collect_set("_place")).alias("_all"))
    steps = F.sequence(F.lit(1), F.lit(PARTS - 1))
    borders = F.array_distinct(F.transform(steps, lambda i: F.element_at("_all", F.greatest(F.lit(1), F.ceil(F.size("_all") * i / PARTS)).cast("int"))))
    borders = settled(listed.select(*keys, borders.alias("_borders")))
    # as many rows as hot buckets, fewer than BUCKETS in all
    named = borders.select(*(F.col(k).alias(f"_at_{i}") for i, k in enumerate(keys)), "_borders")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_at_{i}")) for i, k in enumerate(keys)])
    met = rows.join(F.broadcast(named), same, "left")
    part = F.coalesce(F.size(F.filter("_borders", lambda b: b < place)), F.lit(0))
    return met.withColumn("_bucket", F.struct("_bucket.none", "_bucket.at", part.alias("part"))).drop("_borders", *(f"_at_{i}" for i in range(len(keys))))


def bucketed_rank(df: DataFrame, by: Sequence[str], bucket: Column, order: Sequence[str], name: str = "rank", size: str | None = None) -> DataFrame:
    """Adds the 1-based position by (bucket, order) within `by`, and the group's size if named; nulls come last.

    `bucket` must be monotone in the wanted order and of bounded number; only bucket counts meet in
    one place. A bucket of very many rows (a hot day) is parted again at borders in `order`. Rows with
    a null in `by` are a group of their own.
    """
    rows = df.withColumn("_bucket", F.struct(bucket.isNull().alias("none"), bucket.alias("at")))
    counts = settled(rows.groupBy(*by, "_bucket").agg(F.count("*").alias("_n")))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    hot = counts.where(F.col("_n") > max(LARGE_BUCKET, total // BUCKETS))
    if not hot.isEmpty():
        rows = _parted(rows, hot, by, order)
        counts = settled(rows.groupBy(*by, "_bucket").agg(F.count("*").alias("_n")))
    up = W.partitionBy(*by).orderBy("_bucket")
    offsets = counts.select(*by, "_bucket", (F.sum("_n").over(up) - F.col("_n")).alias("_before"), F.sum("_n").over(W.partitionBy(*by)).alias("_all"))
    inside = F.row_number().over(W.partitionBy(*by, "_bucket").orderBy(*map(F.asc_nulls_last, order)))
    out = _meet(rows.withColumn("_inside", inside), offsets, [*by, "_bucket"]).withColumn(name, F.col("_before") + F.col("_inside"))
    if size:
        out = out.withColumn(size, F.col("_all"))
    return out.drop("_bucket", "_before", "_all", "_inside")


#: Types whose values come back the same from their text, and groups whose borders are written into an expression at most.
PLAIN_TYPES, MOST_GROUPS = ("tinyint", "smallint", "int", "bigint", "string", "date", "timestamp_ntz"), 50


def before_borders(df: DataFrame, by: str | None, bucket: Column, order: Sequence[str], positions: Sequence[Column]) -> list[Column] | None:
    """For each of `positions` (over `_size`, the rows of the group) whether a row's place by (bucket, order) within its group
    is no later, as an expression over the row: rows need no rank, and only the buckets of the borders are ordered.

    `bucket` and `order` are those of bucketed_rank(). None where an expression can't tell: many groups, a border that is null, in
    a bucket of very many rows or equal to the row after it, or another type.
    """
    kinds = dict(df.select(bucket.alias("_at"), *order).dtypes)
    if any(k not in PLAIN_TYPES for k in kinds.values()):
        return None
    rows = df.select((F.col(by) if by else F.lit(1)).alias("_by"), bucket.alias("_at"), *order)
    counts = settled(rows.groupBy("_by", "_at").agg(F.count("*").alias("_n")))
    if counts.select("_by").distinct().limit(MOST_GROUPS + 1).count() > MOST_GROUPS:
        return None
    up, whole = W.partitionBy("_by").orderBy(F.asc_nulls_last("_at")), W.partitionBy("_by")
    placed = counts.select("_by", "_at", "_n", (F.sum("_n").over(up) - F.col("_n")).alias("_before"), F.sum("_n").over(whole).alias("_size"))
    asked = F.array(*[F.struct(F.lit(i).alias("i"), p.cast("long").alias("p")) for i, p in enumerate(positions)])
    held = placed.select("*", F.inline(asked)).where("p > _before AND p <= _before + _n").collect()
    total = counts.agg(F.sum("_n")).first()[0] or 0
    if any(h["_at"] is None or h["_n"] > max(LARGE_BUCKET, total // BUCKETS) for h in held):
        return None
    if not held:
        return [F.lit(False) for _ in positions]
    spots = df.sparkSession.createDataFrame([tuple(h) for h in held], placed.select("*", F.inline(asked)).schema)
    few = spots.select(F.col("_by").alias("_by2"), F.col("_at").alias("_at2")).distinct()
    turn = W.partitionBy("_by", "_at").orderBy(*map(F.asc_nulls_last, order))
    place = F.struct(*order)
    inside = rows.join(F.broadcast(few), F.col("_by").eqNullSafe(F.col("_by2")) & (F.col("_at") == F.col("_at2"))).select("_by", "_at", *order, F.row_number().over(turn).alias("_inside"), F.lead(place).over(turn).eqNullSafe(place).alias("_twice"))
    wanted = spots.select(F.col("_by").alias("_by2"), F.col("_at").alias("_at2"), "i", (F.col("p") - F.col("_before")).alias("_in"))
    found = inside.join(F.broadcast(wanted), F.col("_by").eqNullSafe(F.col("_by2")) & (F.col("_at") == F.col("_at2")) & (F.col("_inside") == F.col("_in")))
    texts = found.select("_by", "i", "_twice", *(F.col(c).cast("string").alias(f"_c{k}") for k, c in enumerate(["_at", *order]))).collect()
    if any(t["_twice"] or any(t[f"_c{k}"] is None for k in range(len(order) + 1)) for t in texts):
        return None
    out = [F.lit(False) for _ in positions]
    for t in texts:
        below = F.lit(True)
        for k, c in reversed(list(enumerate([bucket, *map(F.col, order)]))):
            at = F.lit(t[f"_c{k}"]).cast(kinds["_at" if k == 0 else order[k - 1]])
            below = (c < at) | ((c == at) & below)
        mine = F.col(by).eqNullSafe(F.lit(t["_by"])) if by else F.lit(True)
        out[t["i"]] = F.when(mine, F.coalesce(below, F.lit(False))).otherwise(out[t["i"]])
    return out


def _by_bucket(df: DataFrame, by: Sequence[str], value: str, sums: dict[str, Column], buckets: int) -> DataFrame:
    """by, value, each sum, and the range bucket of the value, whose borders split the distinct values evenly; nulls are below all.

    The sums are written once; borders, totals and windows read them, so the rows are read once. At
    most `buckets` borders pass through the driver.
    """
    flat = settled(df.groupBy(*by, value).agg(*(c.alias(n) for n, c in sums.items())))
    v = no_nan(F.col(value).cast("double"))
    points = [i / buckets for i in range(1, buckets)]
    found = flat.agg(F.percentile_approx(v, points, 4 * buckets)).first()[0] or []
    borders = sorted(set(found) - {-math.inf, math.inf})
    if not borders:
        return flat.withColumn("_bucket", F.when(F.col(value).isNotNull(), 0).otherwise(-1))
    cut = Bucketizer(splits=[-math.inf, *borders, math.inf], inputCol="_v", outputCol="_in", handleInvalid="keep")
    placed = cut.transform(flat.withColumn("_v", F.col(value).cast("double")))
    return placed.withColumn("_bucket", F.when(F.col(value).isNull(), -1).otherwise(F.col("_in").cast("int"))).drop("_v", "_in")


def cumulative_by_value(df: DataFrame, by: Sequence[str], value: str, sums: dict[str, Column], descending: bool = False, buckets: int = BUCKETS) -> DataFrame:
    """by, value, each sum, its running total `cum_<name>` over distinct values in order and the whole `all_<name>`; null keys are a group."""
    flat = _by_bucket(df, by, value, sums, buckets)
    turn = F.desc if descending else F.asc
    totals = flat.groupBy(*by, "_bucket").agg(*(F.sum(n).alias(f"_{n}") for n in sums))
    over = W.partitionBy(*by).orderBy(turn("_bucket"))
    whole = W.partitionBy(*by)
    offsets = totals.select(*by, "_bucket", *((F.sum(f"_{n}").over(over) - F.col(f"_{n}")).alias(f"_{n}") for n in sums), *(F.sum(f"_{n}").over(whole).alias(f"all_{n}") for n in sums))
    inside = W.partitionBy(*by, "_bucket").orderBy(turn(value)).rowsBetween(W.unboundedPreceding, 0)
    out = _meet(flat.withColumns({f"cum_{n}": F.sum(n).over(inside) for n in sums}), offsets, [*by, "_bucket"])
    return out.select(*by, value, *sums, *((F.col(f"cum_{n}") + F.col(f"_{n}")).alias(f"cum_{n}") for n in sums), *(f"all_{n}" for n in sums))


def quantiles(df: DataFrame, value: str, probabilities: Sequence[float], by: Sequence[str] = (), distributed: bool = True) -> DataFrame:
    """by..., q: exact quantiles with linear interpolation, as an array.

    Only range buckets that hold an asked position are ordered, each in its own task. The plain form
    gives the same numbers and keeps a group's distinct values in one aggregate: for tables known to be small.
    """
    if not distributed:
        return df.groupBy(*by).agg(F.percentile(value, F.array(*map(F.lit, map(float, probabilities)))).alias("q"))
    flat = _by_bucket(df.where(F.col(value).isNotNull()), by, value, {"n": F.count("*")}, BUCKETS)
    asked = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(probabilities)])
    place = lambda w: (F.col("_all") - 1) * w["p"]
    holds = lambda r, start, end: (start <= r) & (r < end)
    either = lambda w, start, end: holds(F.floor(place(w)), start, end) | holds(F.ceil(place(w)), start, end)
    totals = flat.groupBy(*by, "_bucket").agg(F.sum("n").alias("_n"))
    offsets = totals.select(*by, "_bucket", "_n", (F.sum("_n").over(W.partitionBy(*by).orderBy("_bucket")) - F.col("_n")).alias("_before"), F.sum("_n").over(W.partitionBy(*by)).alias("_all"))
    # a bucket, then a value, meets only the probabilities whose two neighbours it holds
    wanted = offsets.select(*by, "_bucket", "_before", "_all", F.filter(asked, lambda w: either(w, F.col("_before"), F.col("_before") + F.col("_n"))).alias("_asked")).where(F.size("_asked") > 0)
    inside = W.partitionBy(*by, "_bucket").orderBy(value).rowsBetween(W.unboundedPreceding, 0)
    cum = _meet(flat, wanted, [*by, "_bucket"]).select(*by, F.col(value).cast("double").alias("_v"), "_all", "_asked", (F.col("_before") + F.sum("n").over(inside)).alias("_end"), "n")
    start, end = F.col("_end") - F.col("n"), F.col("_end")
    at = cum.select("*", F.explode(F.filter("_asked", lambda w: either(w, start, end))).alias("w")).withColumn("_at", place(F.col("w")))
    low, high = F.floor("_at"), F.ceil("_at")
    pair = at.groupBy(*by, F.col("w.i").alias("i")).agg(F.max(F.when(holds(low, start, end), F.col("_v"))).alias("_lo"), F.max(F.when(holds(high, start, end), F.col("_v"))).alias("_hi"), F.first(F.col("_at") - low).alias("_f"))
    one = pair.withColumn("_q", F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_f"))
    return one.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "_q"))), lambda s: s["_q"]).alias("q"))


def average_rank(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """by, value, n, rank: the mean position of each distinct value."""
    cum = cumulative_by_value(df, by, value, {"n": F.count("*")})
    return cum.select(*by, value, "n", (F.col("cum_n") - F.col("n") + (F.col("n") + 1) / 2).alias("rank"))
