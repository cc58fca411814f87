"""Training a run, scoring new data with it, comparing runs."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from riskloom.config import Config
from riskloom.functions.expressions import score_points
from riskloom.operators import binning, eda, metrics, models, policy, rules, scoring, splits
from riskloom.operators.attribution import shap_importance
from riskloom.operators.boosting import Booster, BoosterParams, booster_space, monotone_constraints, tune_booster
from riskloom.operators.encoder import WoeEncoder
from riskloom.operators.search import Search
from riskloom.operators.selection import select_variables
from riskloom.operators.tree_rules import mine_tree_rules
from riskloom.plans.dashboard import render
from riskloom.session import settled
from riskloom.sources import files

log = logging.getLogger(__name__)
#: Segments with thresholds of their own that the policy's document lists; of more it names the table.
MOST_SEGMENTS = 1000
SEGMENTS, CATEGORIES = "segment_thresholds", "woe_categories"
Save = Callable[[str, DataFrame], DataFrame]


def train(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], out: str, label: str = "label", by: str = "split", config: Config | None = None, algorithms: Sequence[str] = ("lr", "gbt"), time: str | None = None, key: str = "app_id") -> dict:
    """Split (unless the table has its parts in `by`), explore, select, fit, calibrate, mine and search.

    Writes reports, scored rows, documents, the log and the page below `out`. Rows without a label
    are noted and left out of all figures.
    """
    config = config or Config()
    root = Path(out)
    root.mkdir(parents=True, exist_ok=True)
    mirror = logging.FileHandler(root / "run.log", encoding="utf-8")
    mirror.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
    above, engine = logging.getLogger("riskloom"), logging.getLogger("riskloom").level
    above.addHandler(mirror)
    above.setLevel(logging.INFO)
    try:
        return _train(df, numeric, categorical, root, label, by, config, algorithms, time, key)
    except Exception:
        log.exception("the run failed")
        raise
    finally:
        above.setLevel(engine)
        above.removeHandler(mirror)
        mirror.close()


def _train(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], root: Path, label: str, by: str, config: Config, algorithms: Sequence[str], time: str | None, key: str) -> dict:
    notes = eda.validate_inputs(df, label, [*numeric, *categorical])
    for n in notes:
        log.warning(n)
    df, time = df.where(F.col(label).isNotNull()), time or config.split.time_col
    if by not in df.columns:
        split_rows(df, label, by, config, time, key).write.mode("overwrite").partitionBy(by).parquet(f"{root}/split")
        df = df.sparkSession.read.parquet(f"{root}/split")
        log.info("split by %s", f"the last {config.split.valid_months} months of {time}" if time else "label")
    part = df.where(F.col(by) == "train")

    def save(name: str, report: DataFrame) -> DataFrame:
        files.write_report(report, f"{root}/reports/{name}")
        log.info("wrote %s", name)
        return df.sparkSession.read.parquet(f"{root}/reports/{name}")

    explore(part, df, numeric, categorical, label, by, config, time, key, save)
    chosen = save("variable_selection", select_variables(part, numeric, categorical, label, time, key, config.eda.corr_threshold, config.eda.monotone_spearman_min, config.eda.psi_stable))
    selected = {r["feature"] for r in chosen.where("status = 'kept'").collect()}
    card, booster = fit_models(part, numeric, categorical, label, config, algorithms, key, save)
    save("scorecard", card.scorecard())
    fitted = {"lr": card.score} | ({"gbt": booster.score} if booster else {})
    tables = {name: metrics.model_metrics(score(df, "model_score"), "model_score", label, (by,)).collect() for name, score in fitted.items()}
    results = {name: {r[by]: {"KS": r["ks"], "AUC": r["auc"]} for r in rows} for name, rows in tables.items()}
    save("model_comparison", df.sparkSession.createDataFrame([(name, r[by], r["auc"], r["ks"], r["gini"]) for name, rows in tables.items() for r in rows], "model string, dataset string, auc double, ks double, gini double"))
    best = max(results, key=lambda n: results[n].get("test", {}).get(config.model.primary_metric.upper()) or 0.0)
    if config.model.importance:
        if booster:
            save("shap_importance", shap_importance(booster, df.where(F.col(by) == "test")))
        save("feature_importance", models.permutation_importance(df.where(F.col(by) == "test"), numeric, lambda x: fitted[best](x, "model_score"), label, key))
    scored = settled(fitted[best](df, "model_score"))
    calibrator = models.Calibrator.fit(scored.where(F.col(by) == "test"), "model_score", label)
    calibrator.save(f"{root}/calibrator")
    judge(scored, calibrator, numeric, label, by, key, config, root, save)
    mined, stable = find_rules(scored, [f for f in numeric if f in selected], [f for f in categorical if f in selected], label, by, config, save)
    overall, segments, leader = find_policy(scored, stable, label, by, config, save)
    base = scoring.drift_baseline(part, numeric).collect()
    document = scoring.policy_document(overall, listed_segments(segments), stable, label)
    if segments is not None and not document["segment_overrides"]:
        document["segment_table"] = f"reports/{SEGMENTS}"
    files.write_json(document, root / "policy.json")
    meta = {"best_algo": best, "label_col": label, "features": [*numeric, *categorical], "scorecard": config.model.scorecard, "lr": card.dumps(), "gbt": booster.dumps() if booster else None, "drift_baseline": {r["feature"]: {"breakpoints": r["breakpoints"], "expected_pct": r["expected_pct"], "missing_rate": r["missing_rate"]} for r in base}}
    files.write_json(meta, root / "model_meta.json")
    gaps = {d: results[best].get(d, {}).get("KS") or 0.0 for d in ("train", "test", "valid")}
    overfit = {"train_test_ks_gap": round(gaps["train"] - gaps["test"], 4), "test_valid_ks_gap": round(gaps["test"] - gaps["valid"], 4)}
    save("overfit_diagnostics", df.sparkSession.createDataFrame([tuple(overfit.values())], "train_test_ks_gap double, test_valid_ks_gap double"))
    leading = {"best_strategy": leader["strategy_name"]} | {f"strategy_{c}": leader[c] for c in ("valid_reject_rate", "valid_reject_bad_rate", "valid_lift", "leaderboard_score")}
    summary = {"run_time": datetime.now().isoformat(timespec="seconds"), "label_col": label, "n_total": scored.count(), "best_model": best, "n_selected_vars": len(selected), "model_metrics": results, "overfit_diagnostics": overfit, "best_strategy": leading, "n_single_rules": sum(r.rule_type == "single" for r in mined), "n_tree_rules": sum(r.rule_type == "tree" for r in mined), "n_stable_rules": len(stable), "config": config.snapshot(), "notes": notes}
    files.write_json(summary, root / "run_summary.json")
    reports = {n: first_rows(df.sparkSession, f"{root}/reports/{n}") for n in ("split_profile", "iv_table", "score_bins", "strategy_leaderboard", "final_strategy_comparison")}
    (root / "dashboard.html").write_text(render(summary, reports), encoding="utf-8")
    log.info("the run ended")
    return summary


def split_rows(df: DataFrame, label: str, by: str, config: Config, time: str | None, key: str) -> DataFrame:
    """The parts by configuration: with a time the latest months are valid and the rest is split by label, else all are split by label."""
    s, order = config.split, splits.shuffled(key, config.split.random_state)
    if time:
        return splits.recent_valid_split(df, time, label, order, key, s.valid_months, s.test_ratio / (s.train_ratio + s.test_ratio), s.min_valid_samples, by)
    return splits.stratified_split(df, label, order, key, (s.train_ratio, s.test_ratio, s.holdout_ratio), by)


def explore(part: DataFrame, df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str, by: str, config: Config, time: str | None, key: str, save: Save) -> None:
    """Reports on the table before any model."""
    save("split_profile", eda.dataset_profile(df, label, time, by))
    save("quality", eda.data_quality(part, [*numeric, *categorical], config.eda.missing_threshold))
    stats = save("woe_bin_report", binning.woe_iv(part, [*numeric, *categorical], bins=config.eda.woe_bins, label=label))
    save("iv_table", binning.iv_ranking(stats))
    save("psi_table", eda.half_split_psi(part, numeric, time, key))
    save("vif_table", eda.vif_table(part, numeric, config.eda.vif_threshold))


def fit_models(part: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str, config: Config, algorithms: Sequence[str], key: str, save: Save) -> tuple[models.Scorecard, Booster | None]:
    """The scorecard and, if asked for, the booster over numbers and the encoder's categories; with `tune` their parameters
    are searched on the train part only, and the trials are reports."""
    m, seed = config.model, config.split.random_state
    spark = part.sparkSession
    encoder = WoeEncoder.fit(part, numeric, categorical, label, least_missing=m.woe_missing_min_samples)
    if encoder.large:
        encoder.table = save(CATEGORIES, encoder.table)
        log.info("features of very many categories, which only the scorecard uses: %s", encoder.large)
    c = m.lr_c
    if m.tune:
        search = Search(models.PENALTY_SPACE, seed)
        c = models.tune_logistic(part, encoder, encoder.features, key, label, m.trials, m.cv_folds, seed, search)
        save("lr_trials", search.table(spark))
    card = models.fit_logistic(part, encoder, encoder.features, label, c)
    if "gbt" not in algorithms:
        return card, None
    woe = encoder.categories
    features = [*numeric, *woe]
    ways = monotone_constraints(part, numeric, label, m.monotone_min_abs_corr) | dict.fromkeys(woe, -1) if m.monotone else {}
    params = BoosterParams(**m.booster)
    if m.tune:
        outer, inner = splits.inner_split(part, label, key, seed=seed)
        search = Search(booster_space(m.tune_trees), seed)
        params = tune_booster(outer, inner, features, label, m.trials, seed, ways, woe=woe, search=search)
        save("gbt_trials", search.table(spark))
    return card, Booster.fit(part, features, label, params, ways, key, woe)


def judge(scored: DataFrame, calibrator: models.Calibrator, numeric: Sequence[str], label: str, by: str, key: str, config: Config, root: Path, save: Save) -> None:
    """Calibration, score bins and stability of the chosen model, and the scored rows by part."""
    both = calibrator.apply(scored, "model_score")
    save("calibration_report", metrics.calibration_report(both, "model_score", "calibrated_prob", label, by))
    binned = metrics.score_deciles(both, "model_score", by, name="model_score_bin")
    points = score_points(F.col("model_score"), **config.model.scorecard).alias("credit_score")
    binned.select(key, label, by, "model_score", "model_score_bin", "calibrated_prob", points).write.mode("overwrite").partitionBy(by).parquet(f"{root}/scored")
    bins = save("score_bins", metrics.score_bins(scored, label=label, by=by))
    save("score_bin_stability", metrics.score_bin_stability(bins))
    save("stability_report", metrics.stability_report(scored, ["model_score", *numeric], by))


def find_rules(scored: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str, by: str, config: Config, save: Save) -> tuple[list[rules.Rule], list[rules.Rule]]:
    """Single and tree rules over the selected features, merged, without overlaps: all mined, and the stable ones."""
    s, part = config.strategy, scored.where(F.col(by) == "train")
    limits = (s.rule_max_coverage, s.rule_min_lift, s.rule_min_hit_count)
    single = rules.rules_of(rules.mine_single(part, numeric, categorical, label, *limits)) if numeric or categorical else []
    tree = mine_tree_rules(part, numeric, label, s.tree_max_depth, s.tree_max_features, s.tree_min_samples_leaf, *limits) if numeric else []
    mined = rules.merge_rules(single, tree)
    listed = [(r.rule_id, r.rule_type, r.text, float(r.stats["coverage"]), int(r.stats["hit_count"]), float(r.stats["bad_rate"]), float(r.stats["lift"])) for r in mined]
    save("rules_merged", scored.sparkSession.createDataFrame(listed, "rule_id int, rule_type string, condition string, coverage double, hit_count long, bad_rate double, lift double"))
    if not mined:
        return [], []
    kept = rules.drop_overlapping(part, mined, s.rule_overlap_threshold)
    tested = save("rule_backtest", rules.backtest(scored, kept, label, by))
    steady = save("rule_stability", rules.rule_stability(tested, *limits, s.rule_max_lift_drop))
    good = {r["rule_id"] for r in steady.where("stable_pass").collect()}
    stable = [r for r in kept if r.rule_id in good]
    if stable:
        save("rule_combined_effect", rules.combined_effect(scored, stable, label, by))
        save("rule_marginal_contribution", rules.marginal_contribution(scored, stable, label, by))
    return mined, stable


def find_policy(scored: DataFrame, stable: Sequence[rules.Rule], label: str, by: str, config: Config, save: Save) -> tuple[dict, DataFrame | None, Row]:
    """Global thresholds, the table of those of segments that discriminate, and the strategies compared; the best strategy's row."""
    s = config.strategy
    save("score_policy", policy.score_policy(scored, s.score_reject_quantile, s.score_review_quantile, label=label, by=by))
    grid = save("global_policy_grid", policy.global_grid(scored, s.reject_rate_grid, s.review_rate_grid, label=label, by=by))
    picked = policy.pick_global(grid).first()
    overall = {"reject": picked["reject_threshold"], "review": picked["review_threshold"]}
    features = [f for f in s.segment_features if f in scored.columns]
    if features:
        if stable:
            save("segment_report", policy.segment_report(scored, stable, features, s.segment_min_samples, label, by))
        spread = save("segment_discrimination", policy.segment_discrimination(scored, features, label=label, by=by))
        if s.segment_use_discrimination_filter:
            features = policy.segment_features_of(spread, features)
    segments = None
    if features:
        cut = save("segment_policy_grid", policy.segment_grid(scored, features, overall["review"], s.segment_reject_rate_grid, s.segment_min_samples, label=label, by=by))
        chosen = save("segment_recommendation", policy.pick_segments(cut, s.segment_min_valid_hits, s.segment_min_lift, s.segment_max_lift_gap))
        position = F.array_position(F.array(*map(F.lit, features)), F.col("segment_feature")).alias("position")
        good = chosen.where("recommend_segment_strategy AND dataset = 'valid' AND action = 'reject'")
        segments = save(SEGMENTS, good.select(position, "segment_feature", "segment_value", "reject_threshold", "review_threshold"))
    comparison = save("final_strategy_comparison", policy.compare_strategies(scored, stable, overall, [] if segments is None else segments, label=label, by=by, replace=True))
    board = save("strategy_leaderboard", policy.leaderboard(comparison))
    save("strategy_recommendation", policy.recommend(board, s.segment_min_lift))
    return overall, segments, board.orderBy(F.desc("leaderboard_score"), "strategy_name").first()


def listed_segments(segments: DataFrame | None) -> list[dict]:
    """The segments for the policy's document, if they are few enough; in the order in which later ones win."""
    if segments is None:
        return []
    few = segments.limit(MOST_SEGMENTS + 1).collect()
    return sorted((r.asDict() for r in few), key=lambda r: (r["position"], r["segment_value"] is None, r["segment_value"] or "")) if len(few) <= MOST_SEGMENTS else []


def first_rows(spark: SparkSession, path: str, most: int = 200) -> list[dict]:
    """What the page shows of a report: its first rows by rank, else in the order of its columns."""
    report = spark.read.parquet(path)
    order = [c for c in report.columns if c.endswith("rank")] or report.columns
    return [r.asDict() for r in report.orderBy(*order).limit(most).collect()]


def load_model(run: Path, spark: SparkSession):
    """The scoring function of a run; an unknown algorithm is an error."""
    meta = files.read_json(run / "model_meta.json")
    if meta["best_algo"] == "lr":
        card = models.Scorecard.loads(meta["lr"], spark)
        if card.encoder.large:
            card.encoder.table = spark.read.parquet(f"{run}/reports/{CATEGORIES}")
        return meta, card.score
    if meta["best_algo"] == "gbt":
        return meta, Booster.loads(meta["gbt"]).score
    raise ValueError(f"unknown algorithm {meta['best_algo']}")


def score(df: DataFrame, run: str | Path) -> tuple[DataFrame, DataFrame]:
    """New rows with model_score, out_credit_score, calibrated_prob (if the run has a calibrator) and decision, and their drift; works on streams for the first part."""
    run = Path(run)
    meta, apply = load_model(run, df.sparkSession)
    if missing := [f for f in meta["features"] if f not in df.columns]:
        raise eda.InputError(f"missing columns: {missing}")
    out = apply(df, "model_score").withColumn("out_credit_score", F.round(score_points(F.col("model_score"), **meta["scorecard"]), 1))
    document = files.read_json(run / "policy.json")
    segments = df.sparkSession.read.parquet(f"{run}/{document['segment_table']}") if "segment_table" in document else None
    decided = scoring.apply_policy(out.withColumnRenamed("out_credit_score", "_points"), document, segments=segments).withColumnRenamed("_points", "out_credit_score")
    if (run / "calibrator").exists():
        decided = models.Calibrator.load(str(run / "calibrator")).apply(decided, "model_score")
    if df.isStreaming:
        return decided, None
    base = df.sparkSession.createDataFrame([(f, [float(x) for x in b["breakpoints"]], [float(x) for x in b["expected_pct"]], float(b["missing_rate"])) for f, b in meta["drift_baseline"].items()], "feature string, breakpoints array<double>, expected_pct array<double>, missing_rate double")
    return decided, scoring.drift_check(df, base)


def score_to(df: DataFrame, run: str | Path, out: str, key: str | None = None) -> None:
    """Writes the decisions, in the order key, score, points, calibrated probability, reasons, and the drift report."""
    decided, drift = score(df, run)
    first = [F.col(key)] if key else []
    calibrated = [F.col("calibrated_prob")] if "calibrated_prob" in decided.columns else []
    given = [c for c in ("decision", "reject_by_rule", "reject_by_score", "hit_rules", "reject_threshold", "review_threshold") if c in decided.columns]
    decided.select(*first, "model_score", F.col("out_credit_score").alias("credit_score"), *calibrated, *given).write.mode("overwrite").parquet(f"{out}/scored")
    files.write_report(drift, f"{out}/drift")


def compare(run_a: str | Path, run_b: str | Path) -> list[dict]:
    a, b = ({n: files.read_json(Path(r) / f"{n}.json") for n in ("run_summary", "policy")} for r in (run_a, run_b))
    return scoring.diff_runs(a["run_summary"], b["run_summary"], a["policy"], b["policy"])


def compare_to(run_a: str | Path, run_b: str | Path, out: str, spark: SparkSession) -> DataFrame:
    """The diff of two runs as a report: metric, run_a, run_b (as text), delta_b_minus_a, in the order of the diff."""
    text = lambda x: None if x is None else str(x)
    rows = [(i, d["metric"], text(d["run_a"]), text(d["run_b"]), None if d["delta_b_minus_a"] is None else float(d["delta_b_minus_a"])) for i, d in enumerate(compare(run_a, run_b))]
    files.write_report(spark.createDataFrame(rows, "position int, metric string, run_a string, run_b string, delta_b_minus_a double"), out)
    return spark.read.parquet(out)
