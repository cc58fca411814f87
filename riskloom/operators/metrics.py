"""Discrimination, stability and score-bin reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.functions.expressions import bin_left_closed, bin_right_closed, floored, psi_label, share
from riskloom.operators.binning import Cuts, cuts_map, long_form
from riskloom.operators.ordered import average_rank, cumulative_by_value, quantiles


def ks(df: DataFrame, score: str = "model_score", label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """by..., ks: the largest distance between the cumulative shares of bad and good, high scores first."""
    by = list(by)
    df = df.where(F.col(label).isNotNull())
    cum = cumulative_by_value(df.withColumn("_g", F.lit(1)), ["_g", *by], score, {"bad": F.sum(label), "n": F.count("*")}, descending=True)
    totals = df.withColumn("_g", F.lit(1)).groupBy("_g", *by).agg(F.sum(label).alias("_bad"), F.count("*").alias("_n"))
    gap = share(F.col("cum_bad"), F.col("_bad")) - share(F.col("cum_n") - F.col("cum_bad"), F.col("_n") - F.col("_bad"))
    return cum.join(F.broadcast(totals), ["_g", *by]).groupBy("_g", *by).agg(F.greatest(F.lit(0.0), F.max(gap)).alias("ks")).drop("_g")


def auc(df: DataFrame, score: str = "model_score", label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """by..., auc, gini: the rank-sum statistic, ties counting half; null with one class."""
    by = list(by)
    rows = df.where(F.col(label).isNotNull()).withColumn("_g", F.lit(1))
    ranks = average_rank(rows, ["_g", *by], score)
    bads = rows.groupBy("_g", *by, score).agg(F.sum(label).alias("bad"))
    sums = ranks.join(bads, ["_g", *by, score]).groupBy("_g", *by).agg(F.sum(F.col("rank") * F.col("bad")).alias("r"), F.sum("bad").cast("double").alias("p"), F.sum("n").cast("double").alias("n"))
    area = F.try_divide(F.col("r") - F.col("p") * (F.col("p") + 1) / 2, F.col("p") * (F.col("n") - F.col("p")))
    return sums.select(*by, area.alias("auc"), (2 * area - 1).alias("gini"))


def lift(mask: Column, label: str = "label") -> Column:
    """An aggregate: the bad rate where `mask` holds over the whole bad rate, 0 where undefined."""
    y = F.col(label).cast("double")
    return share(F.avg(F.when(mask, y)), F.avg(y))


def model_metrics(df: DataFrame, score: str = "model_score", label: str = "label", by: Sequence[str] = ("split",)) -> DataFrame:
    """by..., auc, ks, gini, rounded to four places; as auc() and ks(), from one running total over the scores."""
    by = list(by)
    rows = df.where(F.col(label).isNotNull()).withColumn("_g", F.lit(1))
    cum = cumulative_by_value(rows, ["_g", *by], score, {"n": F.count("*"), "bad": F.sum(label)})
    rank = F.col("cum_n") - F.col("n") + (F.col("n") + 1) / 2
    # high scores first: what stands at this score and above
    bad, n = F.col("all_bad") - F.col("cum_bad") + F.col("bad"), F.col("all_n") - F.col("cum_n") + F.col("n")
    gap = share(bad, F.col("all_bad")) - share(n - bad, F.col("all_n") - F.col("all_bad"))
    known = lambda x: F.sum(F.when(F.col(score).isNotNull(), x)).cast("double")
    sums = cum.groupBy("_g", *by).agg(known(rank * F.col("bad")).alias("r"), known(F.col("bad")).alias("p"), known(F.col("n")).alias("n"), F.greatest(F.lit(0.0), F.max(gap)).alias("ks"))
    area = F.try_divide(F.col("r") - F.col("p") * (F.col("p") + 1) / 2, F.col("p") * (F.col("n") - F.col("p")))
    out = sums.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in by], F.lit(True))).select(*by, area.alias("auc"), "ks", (2 * area - 1).alias("gini"))
    return out.select(*by, *(F.round(c, 4).alias(c) for c in ("auc", "ks", "gini")))


def overfit(metrics: DataFrame, by: str = "split") -> DataFrame:
    """train_test_ks_gap and test_valid_ks_gap from model_metrics()."""
    at = lambda name: F.max(F.when(F.col(by) == name, F.col("ks")))
    return metrics.agg(F.round(at("train") - at("test"), 4).alias("train_test_ks_gap"), F.round(at("test") - at("valid"), 4).alias("test_valid_ks_gap"))


def psi_edges(expected: DataFrame, features: Sequence[str], bins: int = 10) -> Cuts:
    """Distinct quantiles of each feature, ends included."""
    found = quantiles(long_form(expected, features, ()), "value", [i / bins for i in range(bins + 1)], ["feature"]).collect()
    return {f: [] for f in features} | {r["feature"]: sorted({x for x in r["q"] or [] if x is not None}) for r in found}


def psi_report(df: DataFrame, features: Sequence[str], expected: Column, actual: Column, bins: int = 10, edges: Cuts | None = None) -> DataFrame:
    """feature, psi, psi_label between two parts of one table.

    Bins are [a, b), the last one closed. A value beyond the expected range falls in no bin and
    stays in the denominator. Either part empty: null; fewer than two edges: 0.
    """
    edges = edges or psi_edges(df.where(expected), features, bins)
    rows = long_form(df.select(*features, expected.alias("_e"), actual.alias("_a")), features, ("_e", "_a")).where("value IS NOT NULL")
    cuts = F.element_at(cuts_map(edges), F.col("feature"))
    top = F.try_element_at(cuts, F.size(cuts))
    at = F.least(bin_left_closed(F.col("value"), cuts), F.size(cuts) - 1)
    inside = (F.size(cuts) >= 2) & (F.col("value") >= F.try_element_at(cuts, F.lit(1))) & (F.col("value") <= top)
    counts = rows.withColumn("bin", F.when(inside, at)).groupBy("feature", "bin").agg(F.count_if("_e").alias("e"), F.count_if("_a").alias("a"))
    names = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(len(c)).alias("edges")) for f, c in edges.items()]))
    spark = df.sparkSession
    bins_of = spark.range(1).select(names.alias("x")).select("x.feature", "x.edges", F.explode(F.sequence(F.lit(1), F.greatest(F.col("x.edges") - 1, F.lit(1)))).alias("bin"))
    totals = counts.groupBy("feature").agg(F.sum("e").alias("ne"), F.sum("a").alias("na"))
    full = bins_of.join(counts, ["feature", "bin"], "left").join(totals, "feature", "left")
    pe, pa = (floored(share(F.coalesce(c, F.lit(0)), F.col(n))) for c, n in ((F.col("e"), "ne"), (F.col("a"), "na")))
    psi = F.sum((pa - pe) * F.log(pa / pe))
    out = full.groupBy("feature").agg(psi.alias("psi"), F.max("edges").alias("edges"), F.max("ne").alias("ne"), F.max("na").alias("na"))
    value = F.when((F.coalesce("ne", F.lit(0)) == 0) | (F.coalesce("na", F.lit(0)) == 0), F.lit(None)).when(F.col("edges") < 2, 0.0).otherwise(F.round("psi", 6))
    return out.select("feature", value.alias("psi")).withColumn("psi_label", psi_label(F.col("psi")))


def stability_report(df: DataFrame, features: Sequence[str], by: str = "split", base: str = "train", bins: int = 10) -> DataFrame:
    """dataset, feature, psi of every other part against the base; edges are computed once."""
    edges = psi_edges(df.where(F.col(by) == base), features, bins)
    out = None
    for other in ("test", "valid"):
        one = psi_report(df, features, F.col(by) == base, F.col(by) == other, bins, edges).select(F.lit(other).alias("dataset"), "feature", "psi")
        out = one if out is None else out.unionByName(one)
    return out


def smoothed_rates(bins: DataFrame, by: Sequence[str], order: str, rate: str, weight: str, name: str) -> DataFrame:
    """Adds the non-increasing rates closest to `rate` in weighted squares.

    fit(i) = min over j <= i of max over k >= i of the weighted mean of j..k; a report has few bins.
    """
    few = [*by, order]
    a = bins.select(*by, F.col(order).alias("_j"), F.col(rate).alias("_r"), F.col(weight).alias("_w"))
    ends = bins.select(*by, F.col(order).alias("_k"), F.col(rate).alias("_r2"), F.col(weight).alias("_w2"))
    run = W.partitionBy(*by, "_j").orderBy("_k")
    spans = a.select(*by, "_j").join(ends, list(by)).where("_k >= _j").select(*by, "_j", "_k", (F.sum(F.col("_r2") * F.col("_w2")).over(run) / F.sum("_w2").over(run)).alias("_m"))
    at = bins.select(*by, F.col(order).alias("_i")).join(spans, list(by)).where("_j <= _i AND _k >= _i")
    fit = at.groupBy(*by, "_i", "_j").agg(F.max("_m").alias("_m")).groupBy(*by, "_i").agg(F.min("_m").alias(name))
    return bins.join(fit.withColumnRenamed("_i", order), few)


def running_minimum(bins: DataFrame, by: Sequence[str], order: str, rate: str, name: str) -> DataFrame:
    """Adds the least rate so far: the plain form of smoothed_rates(), without weights."""
    return bins.withColumn(name, F.min(rate).over(W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, 0)))


def score_bins(df: DataFrame, score: str = "model_score", label: str = "label", by: str = "split", base: str = "train", bins: int = 10) -> DataFrame:
    """Report by score bin, cut at the base's quantiles, highest scores first."""
    cuts = quantiles(df.where(F.col(by) == base), score, [i / bins for i in range(bins + 1)]).first()["q"]
    inner = sorted(set(cuts))[1:-1]
    edges = F.array(*map(F.lit, inner)) if inner else F.array().cast("array<double>")
    rows = df.select(F.col(by).alias("dataset"), F.col(score).alias("s"), F.col(label).alias("y")).withColumn("score_bin", bin_right_closed(F.col("s"), edges))
    flat = rows.groupBy("dataset", "score_bin").agg(F.count("*").alias("count"), F.sum("y").cast("long").alias("bad_count"), F.min("s").alias("score_min"), F.max("s").alias("score_max"))
    high = W.partitionBy("dataset").orderBy(F.desc("score_bin"))
    whole = W.partitionBy("dataset")
    out = flat.withColumn("bin_order", F.row_number().over(high)).withColumn("raw_bad_rate", share(F.col("bad_count"), F.col("count")))
    overall = share(F.sum("bad_count").over(whole), F.sum("count").over(whole))
    out = out.withColumns({"overall": overall, "cum_bad_capture": share(F.sum("bad_count").over(high), F.sum("bad_count").over(whole)), "_before": F.lag("raw_bad_rate").over(high)})
    out = out.withColumn("raw_bad_rate_monotone", F.every(F.coalesce(F.col("raw_bad_rate") <= F.col("_before"), F.lit(True))).over(whole)).drop("_before")
    out = smoothed_rates(out, ["dataset"], "bin_order", "raw_bad_rate", "count", "monotone_bad_rate")
    out = out.withColumns({"lift": share(F.col("raw_bad_rate"), F.col("overall")), "monotone_lift": share(F.col("monotone_bad_rate"), F.col("overall"))}).drop("overall")
    train = out.where(F.col("dataset") == base).select("score_bin", F.col("raw_bad_rate").alias("train_bad_rate"), F.col("monotone_bad_rate").alias("train_monotone_bad_rate"))
    out = out.join(F.broadcast(train), "score_bin", "left")
    return out.withColumns({"bad_rate_gap_vs_train": F.col("raw_bad_rate") - F.col("train_bad_rate"), "monotone_bad_rate_gap_vs_train": F.col("monotone_bad_rate") - F.col("train_monotone_bad_rate")})


def score_bin_stability(report: DataFrame) -> DataFrame:
    gap = lambda c: F.max(F.abs(F.col(c)))
    return report.groupBy("dataset").agg(F.count("*").alias("n_bins"), F.bool_and("raw_bad_rate_monotone").alias("raw_bad_rate_monotone"), gap("bad_rate_gap_vs_train").alias("max_abs_bad_rate_gap_vs_train"), gap("monotone_bad_rate_gap_vs_train").alias("max_abs_monotone_bad_rate_gap_vs_train"))


def score_deciles(df: DataFrame, score: str, by: str, bins: int = 10, name: str = "decile") -> DataFrame:
    """Adds each row's bin among its own part's quantiles."""
    found = quantiles(df, score, [i / bins for i in range(1, bins)], [by]).collect()
    cuts = cuts_map({r[by]: sorted(set(r["q"])) for r in found})
    return df.withColumn(name, bin_right_closed(F.col(score), F.element_at(cuts, F.col(by))))


def calibration_report(df: DataFrame, raw: str, calibrated: str, label: str = "label", by: str = "split") -> DataFrame:
    rows = score_deciles(df, raw, by)
    out = rows.groupBy(F.col(by).alias("dataset"), "decile").agg(F.count("*").alias("count"), F.avg(raw).alias("raw_prob_mean"), F.avg(calibrated).alias("calibrated_prob_mean"), F.avg(F.col(label).cast("double")).alias("actual_bad_rate"))
    return out.withColumns({f"{k}_abs_error": F.abs(F.col(f"{k}_prob_mean") - F.col("actual_bad_rate")) for k in ("raw", "calibrated")})
