"""Score thresholds: evaluation, grids over all rows and by segment, comparison and recommendation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.functions.expressions import share
from riskloom.operators.joins import looked_up
from riskloom.operators.ordered import quantiles
from riskloom.operators.rules import Rule, any_rule

REJECT_RATES, REVIEW_RATES, SEGMENT_RATES = (0.03, 0.05, 0.08, 0.10), (0.05, 0.10, 0.15), (0.03, 0.05, 0.08)
DATASETS = ("train", "test", "valid")
ACTIONS = ("reject", "review", "approve")
SEGMENT_TABLE = "position long, segment_feature string, segment_value string, reject_threshold double, review_threshold double"
#: Policies that one aggregate evaluates.
CHUNK = 40


def thresholds(df: DataFrame, probabilities: Sequence[float], score: str = "model_score") -> list[float]:
    return list(quantiles(df, score, probabilities).first()["q"])


def action_masks(score: Column, reject: Column, review: Column) -> dict[str, Column]:
    """Three masks, not one case: with reject below review they overlap, and figures are for each alone."""
    return {"reject": score >= reject, "review": (score >= review) & (score < reject), "approve": score < review}


def evaluate(df: DataFrame, policies: Sequence[dict], policy_type: str = "global", score: str = "model_score", label: str = "label", by: str = "split") -> DataFrame:
    """policy_id, dataset, action and figures: every policy, part and action from one scan a chunk."""
    out = None
    for at in range(0, len(policies), CHUNK):
        part = policies[at : at + CHUNK]
        aggregates, rows = [F.count("*").alias("n"), F.sum(label).alias("b")], []
        for i, p in enumerate(part):
            for action, mask in action_masks(F.col(score), F.lit(p["reject"]), F.lit(p["review"])).items():
                aggregates += [F.count_if(mask).alias(f"h{i}{action}"), F.sum(F.when(mask, F.col(label)).otherwise(0)).alias(f"b{i}{action}")]
                rows.append(F.struct(F.lit(p["policy_id"]).alias("policy_id"), F.lit(action).alias("action"), F.lit(float(p["reject"])).alias("reject_threshold"), F.lit(float(p["review"])).alias("review_threshold"), F.col(f"h{i}{action}").alias("count"), F.col(f"b{i}{action}").alias("hb")))
        sums = df.groupBy(F.col(by).alias("dataset")).agg(*aggregates).select("dataset", "n", "b", F.inline(F.array(*rows)))
        out = sums if out is None else out.unionByName(sums)
    return _figures(out).withColumn("policy_type", F.lit(policy_type))


def _figures(sums: DataFrame) -> DataFrame:
    bad, overall = share(F.col("hb"), F.col("count")), share(F.col("b"), F.col("n"))
    figures = {"rate": share(F.col("count"), F.col("n")), "bad_rate": bad, "overall_bad_rate": overall, "lift": share(bad, overall)}
    return sums.withColumns({k: F.round(v, 6) for k, v in figures.items()}).drop("n", "b", "hb")


def score_policy(df: DataFrame, reject_at: float = 0.95, review_at: float = 0.85, score: str = "model_score", label: str = "label", by: str = "split") -> DataFrame:
    """The three actions with thresholds at the train part's quantiles."""
    review, reject = thresholds(df.where(F.col(by) == "train"), (review_at, reject_at), score)
    rows = evaluate(df, [{"policy_id": "score", "reject": reject, "review": review}], "global", score, label, by)
    low = F.when(F.col("action") == "reject", F.col("reject_threshold")).when(F.col("action") == "review", F.col("review_threshold"))
    high = F.when(F.col("action") == "review", F.col("reject_threshold")).when(F.col("action") == "approve", F.col("review_threshold"))
    return rows.select("dataset", "action", low.alias("threshold_low"), high.alias("threshold_high"), "count", "rate", "bad_rate", "overall_bad_rate", "lift")


def global_grid(df: DataFrame, reject_rates: Sequence[float] = REJECT_RATES, review_rates: Sequence[float] = REVIEW_RATES, score: str = "model_score", label: str = "label", by: str = "split") -> DataFrame:
    """Every pair of reject and review rate; thresholds are quantiles of the train part."""
    pairs = [(r, v) for r in reject_rates for v in review_rates]
    at = thresholds(df.where(F.col(by) == "train"), [1 - r for r, _ in pairs] + [max(0.0, 1 - r - v) for r, v in pairs], score)
    policies = [{"policy_id": f"global_r{r:.3f}_v{v:.3f}", "reject": at[i], "review": at[len(pairs) + i]} for i, (r, v) in enumerate(pairs)]
    return evaluate(df, policies, "global", score, label, by)


def pick_global(grid: DataFrame) -> DataFrame:
    """All rows of the policy with the best reject lift on test, then bad rate, then lower rate, then name."""
    rows = grid.where("dataset = 'test' AND action = 'reject'")
    best = rows.agg(F.min_by("policy_id", F.struct(-F.col("lift"), -F.col("bad_rate"), "rate", "policy_id"))).scalar()
    return grid.where(F.col("policy_id") == best)


def segments_of(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """keep..., segment_feature, segment_value: one row a feature; a null value is a segment."""
    return df.select(*keep, F.inline(F.array(*[F.struct(F.lit(f).alias("segment_feature"), F.col(f).cast("string").alias("segment_value")) for f in features])))


def segment_report(df: DataFrame, rules: Sequence[Rule], features: Sequence[str], least: int = 50, label: str = "label", by: str = "split") -> DataFrame:
    """What the rules together reject in each segment with at least `least` rows."""
    rows = segments_of(df.withColumn("_hit", any_rule(rules, df.columns)), features, (F.col(by).alias("dataset"), F.col(label).alias("y"), "_hit"))
    sums = rows.groupBy("dataset", "segment_feature", "segment_value").agg(F.count("*").alias("segment_count"), F.sum("y").alias("b"), F.count_if("_hit").alias("reject_count"), F.sum(F.when(F.col("_hit"), F.col("y")).otherwise(0)).alias("hb")).where(F.col("segment_count") >= least)
    bad, all_bad = share(F.col("hb"), F.col("reject_count")), share(F.col("b"), F.col("segment_count"))
    return sums.select("dataset", "segment_feature", "segment_value", "segment_count", F.round(all_bad, 4).alias("segment_bad_rate"), "reject_count", F.round(share(F.col("reject_count"), F.col("segment_count")), 4).alias("reject_rate"), F.round(bad, 4).alias("reject_bad_rate"), F.round(share(bad, all_bad), 4).alias("lift_vs_segment"))


def segment_discrimination(df: DataFrame, features: Sequence[str], least_share: float = 0.10, most_share: float = 0.60, most_gap: float = 0.45, least_bad_gap: float = 0.03, stable_order: bool = False, label: str = "label", by: str = "split") -> DataFrame:
    """Per feature and part the spread of shares and bad rates, and whether the feature serves as a segment."""
    rows = segments_of(df, features, (F.col(by).alias("dataset"), F.col(label).alias("y")))
    stat = rows.groupBy("dataset", "segment_feature", "segment_value").agg(F.count("*").alias("n"), F.avg(F.col("y").cast("double")).alias("bad"))
    stat = stat.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy("dataset", "segment_feature")))
    named = F.coalesce("segment_value", F.lit("null"))
    values = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("segment_value").isNull().alias("z"), named.alias("v")))), lambda s: s["v"]), "|")
    sums = stat.groupBy("segment_feature", "dataset").agg(
        F.count("*").alias("n_segments"), F.round(F.min("share"), 6).alias("min_share"), F.round(F.max("share"), 6).alias("max_share"), F.round(F.max("share") - F.min("share"), 6).alias("share_gap"),
        F.round(F.min("bad"), 6).alias("min_bad_rate"), F.round(F.max("bad"), 6).alias("max_bad_rate"), F.round(F.max("bad") - F.min("bad"), 6).alias("bad_rate_gap"), values.alias("segment_values"),
        F.min_by(named, F.struct(-F.col("bad"), named)).alias("riskiest"),
    )
    figures = ("n_segments", "min_share", "max_share", "share_gap", "min_bad_rate", "max_bad_rate", "bad_rate_gap", "segment_values", "riskiest")
    wide = sums.groupBy("segment_feature").agg(*(F.max(F.when(F.col("dataset") == d, F.col(c))).alias(f"{d}_{c}") for d in DATASETS for c in figures))
    every = lambda f: F.coalesce(reduce(lambda a, b: a & b, [f(d) for d in DATASETS]), F.lit(False))
    shares = every(lambda d: (F.col(f"{d}_min_share") >= least_share) & (F.col(f"{d}_max_share") <= most_share) & (F.col(f"{d}_share_gap") <= most_gap))
    wide = wide.withColumns({"stable_order": F.coalesce((F.col("train_riskiest") == F.col("test_riskiest")) & (F.col("test_riskiest") == F.col("valid_riskiest")), F.lit(False)), "share_pass": shares & (F.coalesce("train_n_segments", F.lit(0)) >= 2), "bad_rate_gap_pass": every(lambda d: F.col(f"{d}_bad_rate_gap") >= least_bad_gap)})
    wide = wide.withColumn("stable_order_pass", F.col("stable_order") | F.lit(not stable_order))
    return wide.withColumn("recommend_as_segment_feature", F.col("share_pass") & F.col("bad_rate_gap_pass") & F.col("stable_order_pass")).drop(*(f"{d}_riskiest" for d in DATASETS))


def segment_features_of(discrimination: DataFrame, wanted: Sequence[str]) -> list[str]:
    """Those of the wanted features, in their order, that segment_discrimination() recommends."""
    good = {r["segment_feature"] for r in discrimination.where("recommend_as_segment_feature").select("segment_feature").collect()}
    return [f for f in wanted if f in good]


def segment_grid(df: DataFrame, features: Sequence[str], review: float, rates: Sequence[float] = SEGMENT_RATES, least: int = 50, score: str = "model_score", label: str = "label", by: str = "split") -> DataFrame:
    """Reject thresholds at each segment's own train quantiles, for segments with enough train and valid rows.

    Thresholds are a small table; rows meet it by segment, so all segments share one scan.
    """
    rows = segments_of(df, features, (F.col(by).alias("dataset"), F.col(label).alias("y"), F.col(score).alias("s")))
    rows = rows.withColumn("segment", F.concat_ws("=", "segment_feature", F.coalesce("segment_value", F.lit("\0"))))
    sizes = rows.groupBy("segment").agg(F.count_if(F.col("dataset") == "train").alias("nt"), F.count_if(F.col("dataset") == "valid").alias("nv")).where((F.col("nt") >= least) & (F.col("nv") >= least)).select("segment")
    cuts = quantiles(rows.where("dataset = 'train'"), "s", [1 - r for r in rates], ["segment"]).join(sizes, "segment")
    grid = cuts.select("segment", F.inline(F.array(*[F.struct(F.lit(f"r{r:.3f}").alias("rate_name"), F.element_at("q", i + 1).alias("reject_threshold")) for i, r in enumerate(rates)])))
    grid = grid.groupBy("segment").agg(F.collect_list(F.struct("rate_name", "reject_threshold")).alias("g"))
    # sums by threshold array keep the scan at one row a row: each action's mask is counted per position
    met = rows.join(grid, "segment")
    flat = met.select("dataset", "segment_feature", "segment_value", "y", "s", F.inline("g"))
    masks = action_masks(F.col("s"), F.col("reject_threshold"), F.lit(float(review)))
    sums = flat.groupBy("dataset", "segment_feature", "segment_value", "rate_name", "reject_threshold").agg(F.count("*").alias("n"), F.sum("y").alias("b"), *(c for a, m in masks.items() for c in (F.count_if(m).alias(f"h{a}"), F.sum(F.when(m, F.col("y")).otherwise(0)).alias(f"b{a}"))))
    names = F.concat(F.lit("segment_"), "segment_feature", F.lit("_"), F.when(F.col("segment_value") == "null", "'null'").otherwise(F.coalesce("segment_value", F.lit("null"))), F.lit("_"), "rate_name")
    actions = F.inline(F.array(*[F.struct(F.lit(a).alias("action"), F.col(f"h{a}").alias("count"), F.col(f"b{a}").alias("hb")) for a in ACTIONS]))
    long = sums.select(names.alias("policy_id"), "dataset", "segment_feature", "segment_value", "reject_threshold", F.lit(float(review)).alias("review_threshold"), "n", "b", actions)
    return _figures(long).withColumn("policy_type", F.lit("segment"))


def pick_segments(grid: DataFrame, least_hits: int = 10, least_lift: float = 2.0, most_gap: float = 0.5) -> DataFrame:
    """One policy a segment: recommended ones first, then valid lift, bad rate and name; its rows with the verdict."""
    at = lambda d: grid.where((F.col("dataset") == d) & (F.col("action") == "reject"))
    rows = at("valid").join(at("test").select("policy_id", F.col("lift").alias("test_lift")), "policy_id", "left").withColumn("lift_gap_test_valid", F.round(F.col("test_lift") - F.col("lift"), 6))
    rows = rows.withColumn("abs_lift_gap_test_valid", F.abs("lift_gap_test_valid"))
    good = (F.col("count") >= least_hits) & (F.col("lift") >= least_lift) & (F.col("abs_lift_gap_test_valid") <= most_gap)
    rows = rows.withColumn("recommend_segment_strategy", F.coalesce(good, F.lit(False)))
    order = F.struct(~F.col("recommend_segment_strategy"), -F.col("lift"), -F.col("bad_rate"), "policy_id")
    best = rows.groupBy("segment_feature", "segment_value").agg(F.min_by(F.struct("policy_id", "recommend_segment_strategy", "lift_gap_test_valid", "abs_lift_gap_test_valid"), order).alias("w")).select("w.*")
    return grid.join(best, "policy_id").withColumn("fallback_to_global", ~F.col("recommend_segment_strategy"))


def segment_table(spark: SparkSession, overrides: Sequence[dict]) -> DataFrame:
    """Segments' thresholds as a table; `position` is their order, in which later ones win."""
    rows = [(i, o["segment_feature"], None if o["segment_value"] is None else str(o["segment_value"]), float(o["reject_threshold"]), float(o["review_threshold"])) for i, o in enumerate(overrides)]
    return spark.createDataFrame(rows, SEGMENT_TABLE)


def with_segments(df: DataFrame, segments: DataFrame) -> tuple[DataFrame, list[str]]:
    """`df` with a column for each segment feature: position and thresholds of the row's segment, null where it has none."""
    names = []
    for r in segments.select("segment_feature").distinct().orderBy("segment_feature").collect():  # as many as the policy has features
        feature, name = r[0], f"_segment_{len(names)}"
        own = segments.where(F.col("segment_feature") == feature)
        last = own.groupBy("segment_value").agg(F.max(F.struct("position", "reject_threshold", "review_threshold")).alias("t")).select("segment_value", "t.*")
        df = looked_up(df, last, F.col(feature), "segment_value", name)
        names.append(name)
    return df, names


def table_thresholds(overall: dict | None, names: Sequence[str]) -> tuple[Column, Column]:
    """Reject and review thresholds of a row of with_segments(): those of its latest segment, else the global ones."""
    met = F.greatest(*names) if len(names) > 1 else F.col(names[0]) if names else None
    base = {n: F.lit(None if overall is None else float(overall[n])).cast("double") for n in ("reject", "review")}
    if met is None:
        return base["reject"], base["review"]
    return tuple(F.when(met.isNull(), base[n]).otherwise(met[f"{n}_threshold"]) for n in ("reject", "review"))


def segment_masks(picked: Sequence[dict], score: str = "model_score") -> tuple[Column, Column]:
    """Reject and review masks of the recommended segments' thresholds."""
    reject = review = F.lit(False)
    for p in picked:
        value = F.col(p["segment_feature"]).cast("string")
        here = value.isNull() if p["segment_value"] is None else F.coalesce(value == p["segment_value"], F.lit(False))
        masks = action_masks(F.col(score), F.lit(p["reject_threshold"]), F.lit(p["review_threshold"]))
        reject, review = reject | (here & masks["reject"]), review | (here & masks["review"])
    return reject, review


def table_masks(names: Sequence[str], score: str = "model_score") -> tuple[Column, Column]:
    """segment_masks() of the columns of with_segments()."""
    reject = review = F.lit(False)
    for n in names:
        masks = action_masks(F.col(score), F.col(f"{n}.reject_threshold"), F.col(f"{n}.review_threshold"))
        reject, review = (a | F.coalesce(F.col(n).isNotNull() & masks[k], F.lit(False)) for a, k in ((reject, "reject"), (review, "review")))
    return reject, review


def compare_strategies(df: DataFrame, rules: Sequence[Rule], overall: dict, picked: Sequence[dict] | DataFrame, score: str = "model_score", label: str = "label", by: str = "split", replace: bool = False) -> DataFrame:
    """global, segment, and both with rules: what each rejects, reviews and approves on each part.

    `replace` adds a fourth row for thresholds as decisions use them: a segment's replace the global.
    The segments may be a table of any size.
    """
    if isinstance(picked, DataFrame):
        df, names = with_segments(df, picked)
        seg_reject, seg_review = table_masks(names, score)
        thresholds = table_thresholds(overall, names)
    else:
        seg_reject, seg_review = segment_masks(picked, score)
        thresholds = decision_thresholds(overall, picked)
    g = action_masks(F.col(score), F.lit(overall["reject"]), F.lit(overall["review"]))
    rule = any_rule(rules, df.columns)
    mixed = g["reject"] | rule | seg_reject
    named = {"global_strategy": (g["reject"], g["review"]), "segment_strategy": (seg_reject, seg_review), "global_plus_segment_rules": (mixed, (g["review"] | seg_review) & ~mixed)}
    if replace:
        reject, review = thresholds
        hit = rule | (F.col(score) >= reject)
        named["decisions"] = (hit, (F.col(score) >= review) & ~hit)
    flat = df.select(F.col(by).alias("dataset"), F.col(label).alias("y"), *(F.coalesce(m, F.lit(False)).alias(f"{k}{i}") for i, pair in enumerate(named.values()) for k, m in zip("jv", pair)))
    aggregates = []
    for i in range(len(named)):
        reject, review = F.col(f"j{i}"), F.col(f"v{i}") & ~F.col(f"j{i}")
        approve = ~(reject | review)
        aggregates += [F.count_if(reject).alias(f"nr{i}"), F.count_if(review).alias(f"nv{i}"), F.count_if(approve).alias(f"na{i}"), F.sum(F.when(reject, F.col("y")).otherwise(0)).alias(f"br{i}"), F.sum(F.when(approve, F.col("y")).otherwise(0)).alias(f"ba{i}")]
    sums = flat.groupBy("dataset").agg(F.count("*").alias("n"), F.sum("y").alias("b"), *aggregates)
    rows = F.inline(F.array(*[F.struct(F.lit(name).alias("strategy_name"), F.col(f"nr{i}").alias("reject_count"), F.col(f"nv{i}").alias("review_count"), F.col(f"na{i}").alias("na"), F.col(f"br{i}").alias("br"), F.col(f"ba{i}").alias("ba")) for i, name in enumerate(named)]))
    long = sums.select("dataset", "n", "b", rows)
    bad, all_bad = share(F.col("br"), F.col("reject_count")), share(F.col("b"), F.col("n"))
    r6 = lambda c: F.round(c, 6)
    return long.select("strategy_name", "dataset", "reject_count", r6(share(F.col("reject_count"), F.col("n"))).alias("reject_rate"), "review_count", r6(share(F.col("review_count"), F.col("n"))).alias("review_rate"), r6(share(F.col("na"), F.col("n"))).alias("approve_rate"), r6(bad).alias("reject_bad_rate"), r6(F.try_divide(F.col("ba").cast("double"), F.col("na").cast("double"))).alias("approve_bad_rate"), r6(all_bad).alias("overall_bad_rate"), r6(share(bad, all_bad)).alias("lift"))


def leaderboard(comparison: DataFrame) -> DataFrame:
    """One row a strategy: its figures by part, lift gaps, stability and score."""
    figures = ("reject_rate", "review_rate", "approve_rate", "reject_bad_rate", "approve_bad_rate", "overall_bad_rate", "lift")
    wide = comparison.groupBy("strategy_name").agg(*(F.max(F.when(F.col("dataset") == d, F.col(c))).alias(f"{d}_{c}") for d in DATASETS for c in figures))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    gap = zero("test_lift") - zero("valid_lift")
    score = zero("valid_lift") + zero("valid_reject_bad_rate") - F.abs(gap) - 0.2 * zero("valid_reject_rate")
    return wide.withColumns({"train_test_lift_gap": F.round(zero("train_lift") - zero("test_lift"), 6), "test_valid_lift_gap": F.round(gap, 6), "valid_stability": F.round(1 / (1 + F.abs(gap)), 6), "leaderboard_score": F.round(score, 6)})


def recommend(board: DataFrame, least_lift: float = 2.0) -> DataFrame:
    """Conservative, balanced and aggressive picks among strategies of enough valid lift, or among all if none has it."""
    some = board.agg(F.max((F.coalesce("valid_lift", F.lit(0.0)) >= least_lift).cast("int"))).scalar()
    pool = board.where((F.coalesce("valid_lift", F.lit(0.0)) >= least_lift) | (some == 0))
    orders = {"conservative": ("valid_reject_rate", "test_valid_lift_gap", "-valid_lift"), "balanced": ("-leaderboard_score", "-valid_lift", "valid_reject_rate"), "aggressive": ("-valid_lift", "-valid_reject_rate", "-leaderboard_score")}
    out = None
    for name, order in orders.items():
        one = pool.orderBy(*(F.desc(c[1:]) if c[0] == "-" else F.asc(c) for c in order), "strategy_name").limit(1).withColumn("recommendation_type", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out.select("recommendation_type", *board.columns)


def decision_thresholds(overall: dict, overrides: Sequence[dict]) -> tuple[Column, Column]:
    """Reject and review thresholds of a row: the last fitting override's, else the global ones."""
    out = []
    for name in ("reject", "review"):
        value = None
        for o in reversed(list(overrides)):
            x = F.col(o["segment_feature"]).cast("string")
            here = x.isNull() if o["segment_value"] is None else F.coalesce(x == str(o["segment_value"]), F.lit(False))
            t = F.lit(float(o[f"{name}_threshold"]))
            value = F.when(here, t) if value is None else value.when(here, t)
        base = F.lit(None if overall is None else float(overall[name])).cast("double")
        out.append(base if value is None else value.otherwise(base))
    return out[0], out[1]
