"""Exploration: data quality, monotonicity, rank correlation, collinearity, half-split stability, summary."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.expressions import no_nan, share
from riskloom.operators.joins import HOT_KEYS, HOT_ROWS, SMALL
from riskloom.operators.metrics import psi_report
from riskloom.operators.ordered import before_borders, bucketed_rank, cumulative_by_value
from riskloom.session import settled

#: Patterns of missing values that pairs of features are grouped by at most.
MOST_PATTERNS = 10_000
#: Triangular factors that are stacked and factored at once.
FAN = 64


def numeric_columns(df: DataFrame, besides: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in besides]


def data_quality(df: DataFrame, features: Sequence[str], high_missing: float = 0.5) -> DataFrame:
    """feature, dtype, missing_count, missing_pct, unique_count (nulls apart), is_high_missing.

    Values are counted in long form, so distinct counts of all features share one shuffle.
    """
    kinds = dict(df.dtypes)
    text = lambda f: no_nan(f).cast("string") if kinds[f] in ("double", "float") else F.col(f).cast("string")
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(kinds[f]).alias("dtype"), text(f).alias("value")) for f in features])
    values = df.select(F.inline(pairs)).groupBy("feature", "dtype", "value").agg(F.count("*").alias("n"))
    out = values.groupBy("feature", "dtype").agg(F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("missing_count"), F.sum("n").alias("n"), F.count("value").alias("unique_count"))
    return out.select("feature", "dtype", "missing_count", F.round(share(F.col("missing_count"), F.col("n")), 4).alias("missing_pct"), "unique_count", (share(F.col("missing_count"), F.col("n")) > high_missing).alias("is_high_missing"))


def eligible_features(quality: DataFrame, rows: int) -> DataFrame:
    """Features with more than one distinct value and fewer than half as many as rows."""
    return quality.where((F.col("unique_count") > 1) & (F.col("unique_count") < 0.5 * rows)).select("feature", "unique_count")


def dataset_profile(df: DataFrame, label: str = "label", time: str | None = "apply_time", by: str = "split") -> DataFrame:
    ends = [F.min(time).alias("time_min"), F.max(time).alias("time_max")] if time else []
    return df.groupBy(F.col(by).alias("dataset")).agg(F.count("*").alias("n"), F.round(F.avg(F.col(label).cast("double")), 6).alias("bad_rate"), *ends)


def validation_counts(df: DataFrame, label: str = "label", features: Sequence[str] = ()) -> DataFrame:
    """One row: rows, label nulls, classes, the rarer class's share, features of one value."""
    constant = sum((F.min(f).eqNullSafe(F.max(f)).cast("int") for f in features), F.lit(0))
    out = df.agg(F.count("*").alias("n"), F.count_if(F.col(label).isNull()).alias("label_nulls"), F.count_distinct(label).alias("classes"), F.count_if(F.col(label) == 1).alias("bad"), F.count_if(F.col(label) == 0).alias("good"), constant.alias("constant_features"))
    return out.withColumn("minority_rate", F.round(share(F.least("bad", "good"), F.col("n")), 6))


class InputError(ValueError):
    """The input can't be modelled."""


def validate_inputs(df: DataFrame, label: str, features: Sequence[str]) -> list[str]:
    """Warnings about a table; raises InputError where nothing can be done with it."""
    missing = [f for f in (label, *features) if f not in df.columns]
    if missing:
        raise InputError(f"missing columns: {missing}")
    if not [f for f in features if f in numeric_columns(df)]:
        raise InputError("no numeric feature")
    r = validation_counts(df, label, features).first()
    if r["classes"] < 2:
        raise InputError(f"{label} has {r['classes']} class(es)")
    notes = []
    if r["n"] < 100:
        notes.append(f"only {r['n']} rows")
    if r["classes"] > 10:
        notes.append(f"{label} has {r['classes']} distinct values")
    if r["minority_rate"] < 0.01:
        notes.append(f"the rarer class has {r['minority_rate']:.2%} of the rows")
    elif r["minority_rate"] > 0.45:
        notes.append("the classes are about even")
    if r["label_nulls"]:
        notes.append(f"{r['label_nulls']} rows have no {label}; no figure counts them")
    if r["constant_features"]:
        notes.append(f"{r['constant_features']} feature(s) have one value")
    return notes


def monotonicity(stats: DataFrame, least: float = 0.6, bin_: str = "bin") -> DataFrame:
    """feature, n_bins, spearman of bin order and woe, is_monotone; the missing bin doesn't count; under 3 bins: not monotone."""
    rows = stats.where(F.col(bin_) >= 0).select("feature", F.col(bin_).cast("double").alias("b"), "woe")
    w = W.partitionBy("feature")
    ranked = rows.select("feature", (F.rank().over(w.orderBy("b"))).cast("double").alias("rb"), (F.rank().over(w.orderBy("woe")) + (F.count("*").over(W.partitionBy("feature", "woe")) - 1) / 2).alias("rw"))
    out = ranked.groupBy("feature").agg(F.count("*").alias("n_bins"), F.corr("rb", "rw").alias("c"))
    value = F.when(F.col("n_bins") >= 3, F.round(F.coalesce("c", F.lit(0.0)), 6))
    return out.select("feature", "n_bins", value.alias("spearman")).withColumn("is_monotone", F.coalesce(F.abs("spearman") >= least, F.lit(False)))


def spearman_pairs(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """feature_a, feature_b, correlation for each pair in column order, over the rows where both are known.

    Pairs that share the same known rows share one ranking of them. All rankings are columns of one table by feature and value;
    each feature's part of it meets the rows once.
    """
    pairs = list(combinations(features, 2))
    rows = settled(df.select(*(no_nan(f).alias(f"v{i}") for i, f in enumerate(features))))
    at = {f: i for i, f in enumerate(features)}
    hole = lambda i: F.col(f"v{i}").isNull()
    patterns = rows.groupBy(*(hole(i).alias(f"h{i}") for i in range(len(features)))).count().drop("count").limit(MOST_PATTERNS + 1).collect()
    if len(patterns) <= MOST_PATTERNS:
        known = {(a, b): frozenset(k for k, p in enumerate(patterns) if not (p[at[a]] or p[at[b]])) for a, b in pairs}
    else:
        known = {p: frozenset(p) for p in pairs}
    groups = {g: k for k, g in enumerate(sorted(set(known.values()), key=sorted))}
    sample = {groups[known[p]]: p for p in reversed(pairs)}  # a pair of each group
    long = rows.select(*((~hole(at[a]) & ~hole(at[b])).cast("int").alias(f"g{k}") for k, (a, b) in sorted(sample.items())), F.inline(F.array(*[F.struct(F.lit(i).alias("f"), F.col(f"v{i}").alias("value")) for i in range(len(features))])))
    sums = {f"g{k}": F.sum(f"g{k}") for k in sample}
    cum = cumulative_by_value(long.where("value IS NOT NULL"), ["f"], "value", {"n": F.count("*"), **sums})
    ranks = settled(cum.select("f", "value", "n", *((F.col(f"cum_g{k}") - F.col(f"g{k}") + (F.col(f"g{k}") + 1) / 2).alias(f"g{k}") for k in sample)))
    size = {r["f"]: (r["d"], r["n"]) for r in ranks.groupBy("f").agg(F.count("*").alias("d"), F.sum("n").alias("n")).collect()}
    met = rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(1000)).cast("int") + 1)
    for i, f in enumerate(features):
        used = sorted({groups[known[p]] for p in pairs if f in p})
        table = ranks.where(F.col("f") == i).select(F.col("value").alias("_k"), "n", F.struct(*(F.col(f"g{k}").alias(f"g{k}") for k in used)).alias(f"r{i}"))
        distinct, n = size.get(i, (0, 0))
        if distinct <= SMALL:
            met = met.join(F.broadcast(table.drop("n")), F.col(f"v{i}") == F.col("_k"), "left").drop("_k")
            continue
        # values of very many rows get theirs by broadcast; they and missing ones spread by salt in the join of the rest
        often = F.col("n") > max(HOT_ROWS, n // HOT_KEYS)
        hot = F.broadcast(table.where(often).select("_k", F.col(f"r{i}").alias("_hot")))
        met = met.join(hot, F.col(f"v{i}") == F.col("_k"), "left").drop("_k").withColumn("_cold", F.when(F.col("_hot").isNull(), F.col(f"v{i}")))
        met = met.withColumn("_s", F.when(F.col("_cold").isNull(), F.col("_salt")).otherwise(0))
        rest = table.where(~often).select("_k", F.lit(0).alias("_s2"), f"r{i}")
        met = met.join(rest, (F.col("_cold") == F.col("_k")) & (F.col("_s") == F.col("_s2")), "left")
        met = met.withColumn(f"r{i}", F.coalesce("_hot", f"r{i}")).drop("_k", "_s", "_s2", "_hot", "_cold")
    rank = lambda f, p: F.col(f"r{at[f]}")[f"g{groups[known[p]]}"]
    got = met.agg(*[F.round(F.corr(rank(p[0], p), rank(p[1], p)), 6).alias(f"c{k}") for k, p in enumerate(pairs)]).first() if pairs else ()
    return df.sparkSession.createDataFrame([(*p, c) for p, c in zip(pairs, got)], "feature_a string, feature_b string, correlation double")


def high_correlations(pairs: DataFrame, threshold: float = 0.7) -> DataFrame:
    return pairs.where(F.abs("correlation") >= threshold)


def triangular_factor(rows: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """R of the QR decomposition of the rows' matrix: tasks factor their rows block by block, and factors are stacked and
    factored again in a tree, so that no task and no driver sees more than FAN of them at once."""
    k = len(columns)
    kinds = "part long, r array<double>"

    def packed(part: int, r: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([r.ravel().tolist()], pa.list_(pa.float64()))], names=["part", "r"])

    def factor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        r = np.zeros((0, k))
        for b in batches:
            r = np.linalg.qr(np.vstack([r, np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns], axis=1)]), mode="r")
        if len(r):
            yield packed(TaskContext.get().partitionId(), r)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, first = np.zeros((0, k)), None
        for b in batches:
            for part, x in zip(b.column("part").to_pylist(), b.column("r").to_pylist()):
                first = part // FAN if first is None else first
                r = np.linalg.qr(np.vstack([r, np.array(x).reshape(-1, k)]), mode="r")
        if first is not None:
            yield packed(first, r)

    factors = settled(rows.select(*(F.col(c).cast("double").alias(c) for c in columns)).mapInArrow(factor, kinds))
    while (last := factors.agg(F.max("part")).first()[0] or 0) >= FAN:
        groups = last // FAN + 1
        factors = settled(factors.repartitionById(groups, F.expr(f"CAST(part div {FAN} AS INT)")).mapInArrow(merge, kinds))
    parts = [np.array(r["r"]).reshape(-1, k) for r in factors.orderBy("part").collect()]
    return np.linalg.qr(np.vstack([np.zeros((k, k)), *parts]), mode="r")


def inflation(r: np.ndarray) -> np.ndarray:
    """1 / (1 - R^2) of each column on the others, without intercept; infinite where the others make it up."""
    length = np.sqrt((r * r).sum(axis=0))
    unit = r / np.where(length > 0, length, 1.0)
    sizes = np.linalg.svd(unit, compute_uv=False)
    if sizes[-1] > 1e-12 * sizes[0]:
        return (np.linalg.inv(unit) ** 2).sum(axis=1)
    out = []
    for j in range(len(unit)):
        others = np.delete(unit, j, axis=1)
        left = unit[:, j] - others @ np.linalg.lstsq(others, unit[:, j], rcond=1e-12)[0]
        out.append(np.inf if length[j] == 0 or (left @ left) < 1e-24 else 1 / (left @ left))
    return np.array(out)


def vif_table(df: DataFrame, features: Sequence[str], threshold: float = 10.0) -> DataFrame:
    """feature, vif, high_vif over rows without nulls, by a QR decomposition, which unlike the matrix of products keeps
    nearly collinear columns apart; the uncentred form (no intercept). Without rows and for made-up columns infinite."""
    spark, k = df.sparkSession, len(features)
    schema = "feature string, vif double, high_vif boolean"
    if k < 2:
        return spark.createDataFrame([], schema)
    r = triangular_factor(df.select(*(no_nan(f).alias(f) for f in features)).dropna(), features)
    return spark.createDataFrame([(f, float(x), bool(x > threshold)) for f, x in zip(features, inflation(r))], schema).orderBy(F.desc("vif"), "feature")


def half_split_psi(df: DataFrame, features: Sequence[str], time: str | None, key: str, bins: int = 10) -> DataFrame:
    """psi_report() of the earlier against the later half of the rows (by hash of the key without a time)."""
    bucket = F.to_date(time) if time else F.pmod(F.xxhash64(key), F.lit(100_003))
    order = [time, key] if time else [key]
    half = before_borders(df, None, bucket, order, [F.floor(F.col("_size") / 2)])
    if half is not None:
        return psi_report(df, features, half[0], ~half[0], bins)
    ranked = bucketed_rank(df.withColumn("_one", F.lit(1)), ["_one"], bucket, order, "_rank", "_size")
    early = F.col("_rank") <= F.floor(F.col("_size") / 2)
    return psi_report(ranked, features, early, ~early, bins)


def feature_summary(iv: DataFrame, monotone: DataFrame, psi: DataFrame, pairs: DataFrame, vif: DataFrame, psi_stable: float = 0.1) -> DataFrame:
    """One row a feature: iv, label, monotonicity, psi, collinearity and a recommendation."""
    ivs = iv.select("feature", "iv")
    both = pairs.join(ivs.select(F.col("feature").alias("feature_a"), F.col("iv").alias("iv_a")), "feature_a", "left").join(ivs.select(F.col("feature").alias("feature_b"), F.col("iv").alias("iv_b")), "feature_b", "left")
    drop = both.select(F.when(F.coalesce("iv_a", F.lit(0.0)) >= F.coalesce("iv_b", F.lit(0.0)), F.col("feature_b")).otherwise(F.col("feature_a")).alias("feature")).distinct().withColumn("high_corr", F.lit(True))
    out = iv.select("feature", "iv", "iv_label").join(monotone.select("feature", "spearman", "is_monotone"), "feature", "left").join(psi.select("feature", "psi"), "feature", "left").join(drop, "feature", "left").join(vif.select("feature", "high_vif"), "feature", "left")
    out = out.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("high_corr", "high_vif")})
    issues = F.array_compact(F.array(
        F.when(F.col("high_corr"), "highly correlated, drop"), F.when(F.col("high_vif"), "high VIF"), F.when(~F.coalesce("is_monotone", F.lit(True)), "WOE not monotone"),
        F.when(F.col("psi") > psi_stable, F.concat(F.lit("PSI="), F.format_string("%.3f", "psi"), F.lit(" unstable"))), F.when(F.col("iv") < 0.02, "IV too low"),
    ))
    return out.withColumn("is_monotone", F.coalesce("is_monotone", F.lit(False))).withColumn("recommendation", F.when(F.size(issues) == 0, "OK").otherwise(F.concat(F.lit("WARN: "), F.concat_ws(", ", issues))))
