"""From a table to a run, from a run to decisions in batch and on a stream."""

from pyspark.sql import functions as F

from riskloom.config import Config
from riskloom.plans import runs
from riskloom.sources import files
from riskloom.sources.apps import load_apps
from riskloom.streaming.scorer import score_stream

REPORTS = (
    "split_profile", "quality", "woe_bin_report", "iv_table", "psi_table", "vif_table", "variable_selection", "scorecard", "model_comparison", "feature_importance",
    "calibration_report", "score_bins", "score_bin_stability", "stability_report", "rules_merged", "rule_backtest", "rule_stability", "score_policy", "global_policy_grid",
    "segment_discrimination", "segment_policy_grid", "segment_recommendation", "final_strategy_comparison", "strategy_leaderboard", "strategy_recommendation", "overfit_diagnostics", "shap_importance", "lr_trials", "gbt_trials",
)
FEATURES = (("total_price", "sum_qty"), ("channel",))


def test_train_score_promote_compare(spark, tmp_path):
    apps = load_apps(spark, "/root/testdata/sf0.001").drop("model_score", "split").persist()
    config = Config().override({"split": {"valid_months": 12}, "model": {"tune": True, "trials": 2, "cv_folds": 2, "tune_trees": [1, 2]}, "strategy": {"segment_features": ["channel"], "rule_max_coverage": 0.1, "rule_min_lift": 1.5, "rule_max_lift_drop": 2.0, "segment_use_discrimination_filter": False}})
    summary = runs.train(apps, *FEATURES, str(tmp_path / "a"), config=config, time="apply_time")
    assert summary["best_model"] in ("lr", "gbt") and summary["n_total"] == 1500 and min(summary["model_metrics"][m]["test"]["AUC"] for m in ("lr", "gbt")) > 0.7
    assert summary["n_selected_vars"] >= 1 and summary["n_single_rules"] >= 1 and summary["best_strategy"]["best_strategy"]
    for name in REPORTS:
        assert spark.read.parquet(str(tmp_path / "a" / "reports" / name)).count() > 0, name
    scored = spark.read.parquet(str(tmp_path / "a" / "scored"))
    assert scored.count() == 1500 and scored.where("calibrated_prob < 0 OR calibrated_prob > 1 OR credit_score IS NULL").count() == 0
    assert "wrote iv_table" in (tmp_path / "a" / "run.log").read_text() and "<svg" in (tmp_path / "a" / "dashboard.html").read_text()
    files.promote(tmp_path / "a", tmp_path / "pointer")
    new = apps.select("app_id", *FEATURES[0], *FEATURES[1])
    decided, drift = runs.score(new, files.production_run(tmp_path / "pointer"))
    assert decided.count() == 1500 and drift.count() == 2 and decided.select("decision").distinct().count() >= 2
    diff = {r["metric"]: r for r in runs.compare(tmp_path / "a", tmp_path / "a")}
    assert diff["n_total"]["delta_b_minus_a"] == 0 and diff["policy_reject_threshold"]["delta_b_minus_a"] == 0 and "strategy_valid_lift" in diff
    split = {r["split"]: (r["n"], r["low"], r["high"]) for r in spark.read.parquet(str(tmp_path / "a" / "split")).groupBy("split").agg(F.count("*").alias("n"), F.min("apply_time").alias("low"), F.max("apply_time").alias("high")).collect()}
    assert sum(n for n, _, _ in split.values()) == 1500 and split["valid"][1] > max(split["train"][2], split["test"][2]) and 4 < split["train"][0] / split["test"][0] < 5.5
    report = runs.compare_to(tmp_path / "a", tmp_path / "a", str(tmp_path / "diff"), spark)
    assert report.count() == len(diff) and report.where("metric = 'n_total'").first()["run_a"] == "1500"
    runs.score_to(new, tmp_path / "a", str(tmp_path / "batch"), "app_id")
    assert spark.read.parquet(str(tmp_path / "batch" / "scored")).columns[:5] == ["app_id", "model_score", "credit_score", "calibrated_prob", "decision"]
    assert spark.read.parquet(str(tmp_path / "batch" / "drift")).count() == 2
    new.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(new.schema).parquet(str(tmp_path / "in"))
    score_stream(stream, tmp_path / "a", str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(60)
    a = spark.read.parquet(str(tmp_path / "out")).groupBy("decision").count().collect()
    assert sorted(a) == sorted(decided.groupBy("decision").agg(F.count("*").alias("count")).collect())


def test_split_without_a_time_is_by_label(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 4 == 0).cast("int").alias("y"))
    config = Config().override({"split": {"train_ratio": 0.6, "test_ratio": 0.2, "holdout_ratio": 0.2}})
    got = {(r["part"], r["y"]): r["count"] for r in runs.split_rows(df, "y", "part", config, None, "k").groupBy("part", "y").count().collect()}
    assert got == {("train", 0): 450, ("train", 1): 150, ("test", 0): 150, ("test", 1): 50, ("valid", 0): 150, ("valid", 1): 50}
