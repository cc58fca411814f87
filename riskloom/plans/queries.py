"""The registered queries: operators applied to the application table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.expressions import score_points
from riskloom.operators import binning, eda, metrics, policy, rules, scoring, splits
from riskloom.operators.rules import Condition, Rule
from riskloom.session import settled
from riskloom.sources.apps import CATEGORICAL, NUMERIC, load_apps

WOE_FEATURES = ("total_price", "acct_bal")
CATEGORIES = ("channel", "priority", "n_items")
SEGMENTS = ("channel", "region")
RULES = (
    Rule((Condition("total_price", ">=", 450000.0),), "single", 0),
    Rule((Condition("sum_qty", ">=", 230.0),), "single", 1),
    Rule((Condition("total_price", ">", 380000.0), Condition("channel", "==", "BUILDING")), "tree", 2),
    Rule((Condition("total_price", ">=", 460000.0), Condition("n_items", ">=", 2.0)), "tree", 3),
)
POLICY = {"score_thresholds": {"reject": 0.75, "review": 0.55}, "segment_overrides": [
    {"segment_feature": "channel", "segment_value": "BUILDING", "reject_threshold": 0.7, "review_threshold": 0.5},
    {"segment_feature": "channel", "segment_value": None, "reject_threshold": 0.6, "review_threshold": 0.4},
    {"segment_feature": "region", "segment_value": "ASIA", "reject_threshold": 0.8, "review_threshold": 0.6},
], "reject_rules": [r.document() for r in RULES[:2]]}
#: Two small trees, as a fitted booster writes them, with a category and a feature met twice on a path.
FIXED_BOOSTER = {
    "cuts": {"total_price": [150000.0, 250000.0, 380000.0], "acct_bal": [0.0, 4000.0], "sum_qty": [60.0, 120.0], "channel": [-0.05, 0.03]},
    "base": -0.25,
    "woe": {"channel": {"AUTOMOBILE": -0.1, "BUILDING": 0.0, "FURNITURE": 0.0, "HOUSEHOLD": 0.05, "MACHINERY": 0.1}},
    "trees": [
        {"feature": "total_price", "bin": 1, "missing_left": False, "gain": 9.0, "cover": 100.0,
         "left": {"feature": "acct_bal", "bin": 0, "missing_left": True, "gain": 3.0, "cover": 64.0, "left": {"leaf": -0.3, "cover": 24.0}, "right": {"leaf": -0.1, "cover": 40.0}},
         "right": {"feature": "total_price", "bin": 2, "missing_left": False, "gain": 4.0, "cover": 36.0, "left": {"leaf": 0.2, "cover": 30.0}, "right": {"leaf": 0.7, "cover": 6.0}}},
        {"feature": "sum_qty", "bin": 1, "missing_left": True, "gain": 5.0, "cover": 90.0,
         "left": {"feature": "channel", "bin": 0, "missing_left": False, "gain": 2.0, "cover": 50.0, "left": {"leaf": 0.15, "cover": 10.0}, "right": {"leaf": -0.05, "cover": 40.0}},
         "right": {"feature": "acct_bal", "bin": 1, "missing_left": False, "gain": 2.5, "cover": 40.0, "left": {"leaf": 0.25, "cover": 15.0}, "right": {"leaf": 0.05, "cover": 25.0}}},
    ],
}
TRANSFORM_CUTS = {"total_price": [100000.0, 200000.0, 300000.0], "acct_bal": [0.0, 5000.0]}


def _train(apps: DataFrame) -> DataFrame:
    return apps.where("split = 'train'")


def _round(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(*(F.round(F.col(f.name), places).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name) for f in df.schema))


WOE_COLUMNS = ("feature", "bin_label", "bin_interval", "total", "bad", "good", "bad_pct", "good_pct", "woe", "bad_rate", "iv_bin", "iv")


def woe_iv_quantile(apps):
    return _round(binning.woe_numeric(apps, WOE_FEATURES, "quantile").select("bin", *(c for c in WOE_COLUMNS if c != "bin_label")))


def woe_iv_uniform(apps):
    return _round(binning.woe_numeric(apps, WOE_FEATURES, "uniform").select("bin", *(c for c in WOE_COLUMNS if c != "bin_label")))


def woe_iv_categorical(apps):
    return _round(binning.woe_categories(apps, CATEGORIES).select(*(c for c in WOE_COLUMNS if c != "bin_interval")))


def _iv(apps):
    return binning.woe_iv(apps, [*NUMERIC, *CATEGORICAL])


def iv_ranking(apps):
    return binning.iv_ranking(_iv(apps))


def woe_bin_report(apps):
    stats = settled(_iv(apps))
    return _round(stats.join(F.broadcast(binning.iv_ranking(stats).select("feature", "iv_rank")), "feature").select("iv_rank", "feature", "bin_label", "total", "bad", "good", "bad_rate", "woe", "iv_bin"))


def data_quality(apps):
    return eda.data_quality(apps, [*NUMERIC, *CATEGORICAL])


def eligible_features(apps):
    return eda.eligible_features(eda.data_quality(apps, [*NUMERIC, *CATEGORICAL]), apps.count())


def dataset_profile(apps):
    return eda.dataset_profile(apps)


def validate_counts(apps):
    return eda.validation_counts(apps, "label", NUMERIC)


def ks(apps):
    return _round(metrics.ks(apps, by=["split"]), 8)


def auc_gini(apps):
    return _round(metrics.auc(apps, by=["split"]), 8)


def lift(apps):
    return apps.groupBy("split").agg(*(F.round(metrics.lift(F.col("model_score") >= t), 6).alias(f"lift_{n}") for n, t in (("50", 0.5), ("70", 0.7), ("none", 2.0))))


def model_comparison(apps):
    return metrics.model_metrics(apps).withColumnRenamed("split", "dataset")


def overfit_diagnostics(apps):
    return metrics.overfit(metrics.model_metrics(apps))


def psi_feature(apps):
    return metrics.psi_report(apps, NUMERIC, F.col("split") == "train", F.col("split") == "valid")


def psi_half_split(apps):
    return eda.half_split_psi(apps, ("total_price", "drifting", "acct_bal"), "apply_time", "app_id")


def stability_report(apps):
    return metrics.stability_report(apps, ("model_score", "total_price", "sum_qty"))


SCORE_BIN_COLUMNS = ("dataset", "score_bin", "bin_order", "count", "bad_count", "raw_bad_rate", "monotone_bad_rate", "raw_bad_rate_monotone", "lift", "monotone_lift", "cum_bad_capture", "score_min", "score_max", "train_bad_rate", "bad_rate_gap_vs_train", "monotone_bad_rate_gap_vs_train")


def score_bins(apps):
    return _round(metrics.score_bins(apps).select(*SCORE_BIN_COLUMNS))


def score_bin_stability(apps):
    return _round(metrics.score_bin_stability(metrics.score_bins(apps)))


def calibration_bins(apps):
    return _round(metrics.calibration_report(apps.withColumn("p", F.col("model_score") * 0.9 + 0.05), "model_score", "p"))


def spearman_matrix(apps):
    return eda.spearman_pairs(apps, ("total_price", "acct_bal", "sum_qty", "avg_disc", "price_copy"))


def high_corr_pairs(apps):
    return eda.high_correlations(spearman_matrix(apps))


def monotonicity(apps):
    return eda.monotonicity(binning.woe_numeric(apps, ("total_price", "acct_bal", "sum_qty"), "quantile"))


def vif(apps):
    return eda.vif_table(apps, ("total_price", "sum_qty", "avg_disc", "price_copy"))


def feature_summary(apps):
    pairs = eda.high_correlations(spearman_matrix(apps))
    stats = settled(binning.woe_numeric(apps, ("total_price", "acct_bal", "sum_qty", "avg_disc", "price_copy", "drifting")))
    psi = eda.half_split_psi(apps, ("total_price", "acct_bal", "sum_qty", "avg_disc", "price_copy", "drifting"), "apply_time", "app_id")
    return _round(eda.feature_summary(binning.iv_ranking(stats), eda.monotonicity(stats), psi, pairs, vif(apps)))


def split_stratified(apps):
    return apps.select("app_id", "split")


def split_time(apps):
    return splits.time_split(apps.drop("split"), "apply_time", "app_id").select("app_id", "split")


def split_recent_valid(apps):
    return splits.recent_valid_split(apps.drop("split"), "apply_time", "label", (F.col("app_id") * 7919) % 100003, "app_id").select("app_id", "split")


def rule_single_candidates(apps):
    return _round(rules.single_candidates(_train(apps), ("total_price", "acct_bal"), ("channel",)), 6)


def rule_single_mined(apps):
    return rules.mine_single(_train(apps), ("total_price", "acct_bal", "sum_qty"), ("channel", "priority"), most_coverage=0.1)


def rule_backtest(apps):
    return rules.backtest(apps, RULES)


def rule_combined(apps):
    return rules.combined_effect(apps, RULES)


def rule_overlap(apps):
    return rules.overlap_matrix(apps, RULES)


def rule_stability(apps):
    return rules.rule_stability(rules.backtest(apps, RULES))


def rule_marginal(apps):
    return rules.marginal_contribution(apps, RULES)


def score_policy(apps):
    return _round(policy.score_policy(apps), 6)


def global_grid(apps):
    return _round(policy.global_grid(apps), 6)


def global_pick(apps):
    return _round(policy.pick_global(policy.global_grid(apps)), 6)


def segment_report(apps):
    return policy.segment_report(apps, RULES, SEGMENTS)


def segment_discrimination(apps):
    return policy.segment_discrimination(apps, SEGMENTS)


def segment_grid(apps):
    return _round(policy.segment_grid(apps, SEGMENTS, 0.5), 6)


def segment_pick(apps):
    return _round(policy.pick_segments(policy.segment_grid(apps, SEGMENTS, 0.5)), 6)


PICKED = tuple(POLICY["segment_overrides"][:2])
OVERALL = {"reject": 0.75, "review": 0.55}


def final_comparison(apps):
    return policy.compare_strategies(apps, RULES[:2], OVERALL, PICKED)


def leaderboard(apps):
    return policy.leaderboard(final_comparison(apps))


def recommendation_tiers(apps):
    return policy.recommend(leaderboard(apps)).select("recommendation_type", "strategy_name", "leaderboard_score")


def prob_to_score(apps):
    return apps.select("app_id", F.round(score_points(F.col("model_score")), 4).alias("out_credit_score"))


def woe_transform(apps):
    from riskloom.operators.encoder import WoeEncoder

    encoder = WoeEncoder.fit(_train(apps), ("total_price", "acct_bal"), ("channel",), cuts=TRANSFORM_CUTS, least_missing=50)
    return _round(encoder.transform(apps.select("app_id", "total_price", "acct_bal", "channel")))


def score_decisions(apps):
    return scoring.apply_policy(apps, POLICY).select("app_id", "decision", "reject_by_rule", "reject_by_score", "hit_rules", "reject_threshold", "review_threshold")


def score_decisions_by_table(apps):
    segments = policy.segment_table(apps.sparkSession, POLICY["segment_overrides"])
    return scoring.apply_policy(apps, POLICY, segments=segments).select("app_id", "decision", "reject_by_rule", "reject_by_score", "hit_rules", "reject_threshold", "review_threshold")


def final_comparison_by_table(apps):
    return policy.compare_strategies(apps, RULES[:2], OVERALL, policy.segment_table(apps.sparkSession, PICKED))


def decision_counts(apps):
    return scoring.apply_policy(apps, POLICY).groupBy("split", "decision").agg(F.count("*").alias("n"))


def drift_baseline(apps):
    base = scoring.drift_baseline(_train(apps), ("total_price", "acct_bal", "drifting"))
    return base.select("feature", "missing_rate", F.posexplode("expected_pct").alias("bin", "expected_pct")).select("feature", "bin", F.round("expected_pct", 6).alias("expected_pct"), "missing_rate")


def drift_check(apps):
    base = scoring.drift_baseline(_train(apps), ("total_price", "acct_bal", "drifting"))
    return scoring.drift_check(apps.where("split = 'valid'"), base)


def run_diff(apps):
    a = apps.groupBy("split").agg(F.count("*").cast("double").alias("n_total"), F.avg(F.col("label").cast("double")).alias("bad_rate"), F.avg("model_score").alias("mean_score"))
    long = a.select("split", F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("n_total", "bad_rate", "mean_score")])))
    run = lambda s, name: long.where(F.col("split") == s).select("metric", F.col("value").alias(name))
    return _round(run("train", "run_a").join(run("valid", "run_b"), "metric", "full_outer").withColumn("delta_b_minus_a", F.col("run_b") - F.col("run_a")))


def runs_compared(apps):
    """Two runs' summaries, of scores as they are and of scores cut to a decimal, by the run diff."""
    def summary(score: str) -> dict:
        rows = metrics.model_metrics(apps, score).collect()
        return {"n_total": apps.count(), "model_metrics": {"lr": {r["split"]: {"KS": r["ks"], "AUC": r["auc"]} for r in sorted(rows, key=lambda r: r["split"])}}}

    apps = apps.withColumn("coarse", F.round("model_score", 1))
    found = scoring.diff_runs(summary("model_score"), summary("coarse"))
    return apps.sparkSession.createDataFrame([(d["metric"], float(d["run_a"]), float(d["run_b"]), float(d["delta_b_minus_a"])) for d in found], "metric string, run_a double, run_b double, delta_b_minus_a double")


def tree_cuts(apps):
    cuts = binning.tree_cuts(_train(apps), ("total_price", "acct_bal", "sum_qty"))
    return apps.sparkSession.createDataFrame([(f, i, c) for f, x in sorted(cuts.items()) for i, c in enumerate(x)], "feature string, position int, cut double")


def variable_selection(apps):
    from riskloom.operators.selection import select_variables

    return select_variables(_train(apps), NUMERIC, CATEGORICAL, "label", "apply_time", "app_id")


def lr_scorecard(apps):
    from riskloom.operators.models import scorecard_model

    return _round(scorecard_model(apps, ("total_price", "acct_bal", "sum_qty"), ("channel", "priority")).scorecard())


def isotonic_calibration(apps):
    from riskloom.operators.models import Calibrator

    return _round(Calibrator.fit(apps.where("split = 'test'"), "model_score").apply(apps, "model_score", "calibrated_prob").groupBy("split").agg(F.avg("calibrated_prob").alias("mean_calibrated"), F.min("calibrated_prob").alias("low"), F.max("calibrated_prob").alias("high"), F.avg(F.col("label").cast("double")).alias("bad_rate")))


def gbt_scores(apps):
    from riskloom.operators.boosting import Booster

    model = Booster.fit(_train(apps), ("total_price", "acct_bal", "sum_qty", "n_items"), "label", monotone={"total_price": 1, "sum_qty": 1})
    return _round(metrics.model_metrics(model.score(apps, "gbt_score"), "gbt_score").withColumnRenamed("split", "dataset"))


def gbt_importance(apps):
    from riskloom.operators.boosting import Booster, BoosterParams

    model = Booster.fit(_train(apps), ("total_price", "acct_bal", "sum_qty", "n_items"), "label", BoosterParams(trees=4))
    return apps.sparkSession.createDataFrame(sorted(model.importance().items()), "feature string, importance double")


def gbt_fixed_scores(apps):
    from riskloom.operators.boosting import Booster

    return _round(Booster(**FIXED_BOOSTER).score(apps, "gbt_score").select("app_id", "gbt_score"))


def shap_values(apps):
    from riskloom.operators.attribution import attributions
    from riskloom.operators.boosting import Booster

    return _round(attributions(Booster(**FIXED_BOOSTER), apps, ["app_id"]))


def shap_importance(apps):
    from riskloom.operators import attribution
    from riskloom.operators.boosting import Booster

    return _round(attribution.shap_importance(Booster(**FIXED_BOOSTER), apps))


def gbt_categories(apps):
    """A booster over numbers and a category, fitted on the train part: what it attributes to each on the test part."""
    from riskloom.operators import attribution
    from riskloom.operators.boosting import Booster, BoosterParams
    from riskloom.operators.encoder import WoeEncoder

    part = _train(apps)
    woe = WoeEncoder.fit(part, (), ("channel", "priority")).categories
    model = Booster.fit(part, ("total_price", "sum_qty", "channel", "priority"), "label", BoosterParams(trees=4, depth=3, least_hessian=1, gamma=0), {"channel": -1, "priority": -1}, "app_id", woe)
    return _round(attribution.shap_importance(model, apps.where("split = 'test'")))


def tree_rules(apps):
    from riskloom.operators.tree_rules import mine_tree_rules

    found = mine_tree_rules(_train(apps), ("total_price", "acct_bal", "sum_qty"), "label", most_coverage=0.3, least_lift=1.5)
    return apps.sparkSession.createDataFrame([(r.rule_id, r.text, r.stats["coverage"], r.stats["hit_count"], r.stats["bad_rate"], r.stats["lift"]) for r in found], "rule_id int, condition_str string, coverage double, hit_count long, bad_rate double, lift double")


_BUILDERS: tuple[Callable[[DataFrame], DataFrame], ...] = (
    woe_iv_quantile, woe_iv_uniform, woe_iv_categorical, iv_ranking, woe_bin_report, data_quality, eligible_features, dataset_profile, validate_counts,
    ks, auc_gini, lift, model_comparison, overfit_diagnostics, psi_feature, psi_half_split, stability_report, score_bins, score_bin_stability, calibration_bins,
    spearman_matrix, high_corr_pairs, monotonicity, vif, feature_summary, split_stratified, split_time, split_recent_valid,
    rule_single_candidates, rule_single_mined, rule_backtest, rule_combined, rule_overlap, rule_stability, rule_marginal,
    score_policy, global_grid, global_pick, segment_report, segment_discrimination, segment_grid, segment_pick, final_comparison, leaderboard, recommendation_tiers,
    prob_to_score, woe_transform, score_decisions, score_decisions_by_table, final_comparison_by_table, decision_counts, drift_baseline, drift_check, run_diff, runs_compared,
    tree_cuts, variable_selection, lr_scorecard, isotonic_calibration, gbt_scores, gbt_importance, gbt_fixed_scores, shap_values, shap_importance, gbt_categories, tree_rules,
)


def _query(build: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(load_apps(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {b.__name__: _query(b) for b in _BUILDERS} | {"apps": load_apps}
