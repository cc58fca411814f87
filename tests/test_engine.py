"""Invariants of the credit-risk operators on small frames."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.config import Config
from riskloom.functions.expressions import psi_label, score_points
from riskloom.operators import binning, eda, metrics, policy, rules, scoring, splits
from riskloom.operators.boosting import Booster, BoosterParams, tune_booster
from riskloom.operators.encoder import WoeEncoder
from riskloom.operators.models import Calibrator, assemble, fit_logistic, permutation_importance, tune_logistic
from riskloom.operators.ordered import cumulative_by_value, quantiles
from riskloom.operators.rules import Condition, Rule
from riskloom.operators.selection import drop_correlated
from riskloom.operators.tree_rules import mine_tree_rules
from riskloom.plans import dashboard
from riskloom.sources import files


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(1200):
        x, c = float(rng.normal()), ["a", "b", None][i % 3]
        y = int(rng.random() < 1 / (1 + math.exp(-(2 * x - 1.5 + (c == "a")))))
        rows.append((i, x if i % 11 else None, float(rng.random()), c, y, ["train", "train", "test", "valid"][i % 4]))
    return spark.createDataFrame(rows, "app_id long, x double, z double, c string, label int, split string").persist()


def test_quantiles_equal_numpy(frame):
    p = [0.0, 0.1, 0.5, 0.77, 1.0]
    known = [r[0] for r in frame.select("x").dropna().collect()]
    for distributed in (False, True):
        assert np.allclose(quantiles(frame.where("x IS NOT NULL"), "x", p, (), distributed).first()["q"], np.quantile(known, p))
    few = frame.withColumn("few", F.col("app_id") % 4)
    for by in (["c"], ["split", "c"]):
        a, b = ({tuple(r[k] for k in by): r["q"] for r in quantiles(few, v, p, by, d).collect()} for v, d in (("few", False), ("few", True)))
        assert a == b


def test_ks_and_auc(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0), (0.8, 1), (0.9, 1)], "model_score double, label int")
    assert metrics.ks(df).first()["ks"] == 1 and metrics.auc(df).first()["auc"] == 1
    tied = spark.createDataFrame([(0.5, 0), (0.5, 1)], "model_score double, label int")
    assert metrics.auc(tied).first()["auc"] == 0.5 and metrics.ks(tied).first()["ks"] == 0


def test_psi(spark):
    df = spark.createDataFrame([(float(i), i % 2) for i in range(1000)] + [(float(i + 700), 2) for i in range(500)], "v double, part int")
    same = metrics.psi_report(df, ["v"], F.col("part") == 0, F.col("part") == 1).first()
    moved = metrics.psi_report(df, ["v"], F.col("part") == 0, F.col("part") == 2).first()
    none = metrics.psi_report(df, ["v"], F.col("part") == 0, F.col("part") == 9).first()
    assert same["psi"] < 0.02 and moved["psi_label"] == "unstable" and none["psi"] is None


def test_woe_counts_and_direction(frame):
    stats = binning.woe_numeric(frame, ["x"], "quantile").collect()
    assert sum(r["total"] for r in stats) == 1200 and any(r["bin"] == -1 for r in stats)
    assert all(math.isfinite(r["woe"]) for r in stats) and stats[0]["iv"] > 0
    by = sorted((r["bin"], r["woe"]) for r in stats if r["bin"] >= 0)
    assert by[0][1] > by[-1][1]
    mono = eda.monotonicity(binning.woe_numeric(frame, ["x"])).first()
    assert mono["is_monotone"] and mono["spearman"] < -0.6


def test_tree_cuts(frame):
    cuts = binning.tree_cuts(frame, ["x", "z"])
    assert cuts == binning.tree_cuts(frame.repartition(7), ["x", "z"])
    assert len(cuts["x"]) <= 9 and cuts["x"] == sorted(cuts["x"])
    assert binning.best_first_cuts(np.arange(4.0), np.arange(4.0), np.full(4, 60), np.array([0, 0, 60, 60]), 2, 50) == [1.5]


def test_no_row_is_lost_to_nulls(spark):
    rows = [(i, None if i % 10 == 0 else f"2024-01-{1 + i % 28:02d}", None if i % 7 == 0 else i % 2, float(i % 13)) for i in range(100)]
    df = spark.createDataFrame(rows, "k long, t string, label int, x double").withColumn("t", F.to_timestamp("t"))
    timed = splits.time_split(df, "t", "k").collect()
    assert len(timed) == 100 and {r["split"] for r in timed if r["t"] is None} == {"valid"}
    assert [sum(r["split"] == p for r in timed) for p in ("train", "test", "valid")] == [70, 15, 15]
    parts = splits.stratified_split(df, "label", splits.shuffled("k"), "k").collect()
    assert len(parts) == 100 and {r["split"] for r in parts if r["label"] is None} == {"train", "test", "valid"}
    known = [r for r in rows if r[2] is not None]
    stats = binning.woe_numeric(df, ["x"], cuts={"x": [6.0]}).collect()
    assert sum(r["total"] for r in stats) == len(known) and sum(r["bad"] for r in stats) == sum(r[2] for r in known)
    scored = df.withColumn("model_score", F.col("x") / 13)
    only = scored.where("label IS NOT NULL")
    assert metrics.ks(scored).collect() == metrics.ks(only).collect() and metrics.auc(scored).collect() == metrics.auc(only).collect()
    assert any("no label" in n for n in eda.validate_inputs(df, "label", ["x"]))


def test_order_holds_with_outliers(spark):
    """One far value leaves the others spread over buckets; figures don't change."""
    rows = [(float(i % 997), 1) for i in range(4000)] + [(1e12, 1), (-1e12, 1)]
    df = spark.createDataFrame(rows, "v double, n int")
    got = {r["v"]: r["cum_n"] for r in cumulative_by_value(df, [], "v", {"n": F.sum("n")}).collect()}
    values = sorted(v for v, _ in rows)
    assert all(got[v] == np.searchsorted(values, v, "right") for v in set(values))


def test_tree_cuts_by_ranges(spark, monkeypatch):
    """With fewer ranges than rows the cut is still where the label changes."""
    monkeypatch.setattr(binning, "TREE_RANGES", 100)
    df = spark.createDataFrame([(i / 7, int(i >= 1500)) for i in range(4000)], "x double, label int")
    assert abs(binning.tree_cuts(df, ["x"], bins=2)["x"][0] - 1500 / 7) <= 40 / 7


def test_encoder_round_trip(frame):
    e = WoeEncoder.fit(frame, ["x"], ["c"])
    again = WoeEncoder.loads(e.dumps())
    a, b = (m.transform(frame).select("x", "c").collect() for m in (e, again))
    assert a == b and all(r["c"] == 0 for r, s in zip(a, frame.collect()) if s["c"] is None)


def test_logistic_equals_newton(frame):
    e = WoeEncoder.fit(frame, ["x"], ["c"])
    card = fit_logistic(frame, e, ["x", "c"])
    rows = e.transform(frame).select("x", "c", "label").toPandas()
    a, y = rows[["x", "c"]].to_numpy(), rows["label"].to_numpy()
    s = (a - a.mean(0)) / a.std(0)
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    s1, beta = np.hstack([s, np.ones((len(s), 1))]), np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-s1 @ beta))
        g = s1.T @ (w * (p - y)) + np.array([1, 1, 0]) * beta
        beta -= np.linalg.solve((s1 * (w * p * (1 - p))[:, None]).T @ s1 + np.diag([1, 1, 0]), g)
    assert np.allclose(np.array(card.coefficients) * a.std(0), beta[:2], atol=1e-3)


def test_calibration_is_monotone(frame):
    scored = frame.withColumn("p", 1 / (1 + F.exp(-F.coalesce("x", F.lit(0.0)))))
    got = Calibrator.fit(scored, "p").apply(scored, "p").orderBy("p").select("calibrated_prob").collect()
    v = [r[0] for r in got]
    assert all(b >= a - 1e-12 for a, b in zip(v, v[1:])) and 0 <= v[0] and v[-1] <= 1


def test_booster_is_monotone_and_learns(frame):
    m = Booster.fit(frame, ["x", "z"], "label", BoosterParams(trees=6, rate=0.3, least_hessian=1, gamma=0), {"x": 1}, "app_id")
    scored = m.score(frame)
    assert metrics.auc(scored).first()["auc"] > 0.75
    line = m.score(frame.sparkSession.createDataFrame([(float(v) / 10, 0.5) for v in range(-30, 31)], "x double, z double")).collect()
    v = [r["model_score"] for r in line]
    assert all(b >= a - 1e-12 for a, b in zip(v, v[1:]))
    assert Booster.loads(m.dumps()).score(frame).select("model_score").first() == scored.select("model_score").first()
    assert max(m.importance(), key=m.importance().get) == "x"


def test_spearman_equals_pandas(frame):
    want = frame.select("x", "z", "label").toPandas().astype(float).corr("spearman")
    for r in eda.spearman_pairs(frame, ["x", "z", "label"]).collect():
        assert abs(r["correlation"] - want.loc[r["feature_a"], r["feature_b"]]) < 2e-6


def test_vif_equals_least_squares(frame):
    df = frame.select("z", F.coalesce("x", F.lit(0.0)).alias("x")).withColumn("both", F.col("z") * 2 + F.col("x") * 0.1)
    a = df.toPandas()
    for r in eda.vif_table(df.select("z", "both"), ["z", "both"]).collect():
        other = "both" if r["feature"] == "z" else "z"
        fit = a[[other]].to_numpy() @ np.linalg.lstsq(a[[other]].to_numpy(), a[r["feature"]].to_numpy(), rcond=None)[0]
        want = (a[r["feature"]] ** 2).sum() / ((a[r["feature"]] - fit) ** 2).sum()
        assert abs(r["vif"] - want) < 1e-6 * want


def test_splits(frame):
    s = splits.stratified_split(frame.drop("split"), "label", splits.shuffled("app_id"), "app_id")
    n = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert abs(n["train"] - 840) <= 2 and abs(n["test"] - 180) <= 2
    assert sorted(s.collect()) == sorted(splits.stratified_split(frame.drop("split").repartition(5), "label", splits.shuffled("app_id"), "app_id").collect())
    with pytest.raises(ValueError):
        splits.stratified_split(frame, "label", splits.shuffled("app_id"), "app_id", (0.5, 0.1, 0.1))


RULES = [Rule((Condition("x", ">=", 1.0),), "single", 0), Rule((Condition("x", ">=", 1.1),), "single", 1), Rule((Condition("c", "==", "a"), Condition("z", "<", 0.2)), "tree", 2)]


def test_rules(frame):
    with pytest.raises(KeyError):
        rules.rule_mask(Rule((Condition("absent", ">", 1.0),)), frame.columns)
    with pytest.raises(ValueError):
        rules.rule_mask(Rule(()), frame.columns)
    tested = {(r["dataset"], r["rule_id"]): r for r in rules.backtest(frame, RULES).collect()}
    assert tested["train", 0]["hit_count"] == frame.where("split = 'train' AND x >= 1").count()
    assert [r.rule_id for r in rules.drop_overlapping(frame, RULES)] == [0, 2]
    rows = [r for r in rules.marginal_contribution(frame, RULES).collect() if r["dataset"] == "train"]
    assert rows[1]["marginal_hit_count"] == 0 and rows[2]["cumulative_hit_count"] == frame.where("split = 'train' AND (x >= 1 OR (c = 'a' AND z < 0.2))").count()
    assert Rule.of(RULES[2].document(), 2) == RULES[2]


def test_tree_rules_mean_the_same_everywhere(frame):
    for r in mine_tree_rules(frame, ["x", "z"], most_coverage=0.5, least_lift=1.2):
        assert frame.where(rules.rule_mask(r, frame.columns)).count() == r.stats["hit_count"]


def test_rules_merge_by_lift():
    a, b = (Rule((Condition("x", ">=", v),), kind, 7, {"lift": lift}) for v, kind, lift in ((1.0, "single", 2.0), (2.0, "tree", 3.0)))
    again = Rule(a.conditions, "tree", 3, {"lift": 2.0})
    assert [(r.rule_id, r.text, r.rule_type) for r in rules.merge_rules([a], [b, again])] == [(0, "x >= 2.0", "tree"), (1, "x >= 1.0", "single")]
    assert rules.merge_rules([], []) == []


def test_segment_features_keep_the_wanted_order(spark):
    spread = spark.createDataFrame([("a", True), ("b", False), ("c", True)], "segment_feature string, recommend_as_segment_feature boolean")
    assert policy.segment_features_of(spread, ["c", "b", "a", "d"]) == ["c", "a"]


def test_running_minimum(spark):
    df = spark.createDataFrame([("p", i, r) for i, r in enumerate([0.5, 0.3, 0.4, 0.1])], "d string, i int, r double")
    assert [x["m"] for x in metrics.running_minimum(df, ["d"], "i", "r", "m").orderBy("i").collect()] == [0.5, 0.3, 0.3, 0.1]


def test_tuning_on_the_inner_split(frame):
    a, b = splits.inner_split(frame, "label", "app_id")
    assert a.count() + b.count() == 1200 and abs(b.count() - 240) <= 2 and a.join(b, "app_id").count() == 0
    p = tune_booster(a, b, ["x", "z"], trials=2, trees=(1, 1))
    assert p.trees == 1 and 3 <= p.depth <= 7
    e = WoeEncoder.fit(frame, ["x"], ["c"])
    assert 1e-3 <= tune_logistic(frame, e, ["x"], "app_id", trials=1, folds=2) <= 10


def test_importance_finds_the_signal(frame):
    rows = frame.withColumn("x", F.coalesce("x", F.lit(0.0)))
    got = {r["feature"]: r["importance"] for r in permutation_importance(rows, ["x", "z"], lambda d: d.withColumn("model_score", 1 / (1 + F.exp(-F.col("x"))))).collect()}
    assert got["x"] > 0.2 and abs(got["z"]) < 1e-9


def test_vectors_keep_missing_values(frame):
    assert assemble(frame, ["x", "z"]).count() == 1200


def test_tables_and_reports(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,NaN\n2,0.5\n", encoding="utf-8")
    rows = files.read_table(spark, str(tmp_path / "t.csv"), "a int, b double").orderBy("a").collect()
    assert [tuple(r) for r in rows] == [(1, None), (2, 0.5)] and files.read_table(spark, str(tmp_path / "t.csv")).count() == 2
    files.write_report(spark.range(2), str(tmp_path / "r"))
    assert files.read_report(spark, str(tmp_path / "r"), "id long").count() == 2
    assert files.read_report(spark, str(tmp_path / "absent"), "id long").count() == 0


def test_policy_and_decisions(frame):
    scored = frame.withColumn("model_score", 1 / (1 + F.exp(-F.coalesce("x", F.lit(0.0)))))
    grid = policy.global_grid(scored)
    assert grid.count() == 4 * 3 * 3 * 3 and policy.pick_global(grid).select("policy_id").distinct().count() == 1
    over = [{"segment_feature": "c", "segment_value": None, "reject_threshold": 0.0, "review_threshold": 0.0}]
    document = scoring.policy_document({"reject": 0.9, "review": 0.5}, over, RULES[:1], "label")
    got = scoring.apply_policy(scored, document).collect()
    assert all(r["decision"] == "reject" for r in got if r["c"] is None)
    assert all(r["hit_rules"] == "x >= 1.0" for r in got if r["reject_by_rule"])
    assert {r["decision"] for r in got} == {"reject", "review", "approve"}
    assert scoring.apply_policy(scored, None) is scored
    board = policy.leaderboard(policy.compare_strategies(scored, RULES, {"reject": 0.9, "review": 0.5}, over))
    assert board.count() == 3 and policy.recommend(board).count() == 3


def test_drift(frame):
    base = scoring.drift_baseline(frame, ["x", "z"])
    same = {r["feature"]: r for r in scoring.drift_check(frame, base).collect()}
    moved = {r["feature"]: r for r in scoring.drift_check(frame.withColumn("x", F.col("x") + 3), base).collect()}
    assert same["x"]["psi"] < 1e-6 and same["x"]["missing_rate_delta"] == 0 and moved["x"]["psi_level"] == "unstable"


def test_score_scale(spark):
    p = lambda x: spark.range(1).select(score_points(F.lit(x)).alias("s")).first()["s"]
    odds = lambda o: p(o / (1 + o))
    assert abs(odds(0.1) - odds(0.2) - 20) < 1e-6 and math.isfinite(p(0.0)) and math.isfinite(p(1.0))
    assert spark.range(1).select(psi_label(F.lit(0.2))).first()[0] == "warning"


def test_correlation_drop():
    assert drop_correlated(["a", "b", "c"], [("a", "b", 0.9), ("b", "c", 0.9), ("a", "c", 0.1)], {"a": 1, "b": 1, "c": 2}) == {"b": "a"}


def test_config_and_documents(tmp_path):
    c = Config().override({"strategy": {"rule_min_lift": 3.0}, "model": {"scorecard": {"pdo": 40.0}}})
    assert c.strategy.rule_min_lift == 3.0 and c.model.scorecard["pdo"] == 40.0 and c.model.scorecard["base"] == 600.0
    with pytest.raises(KeyError):
        Config().override({"other": {}})
    with pytest.raises(ValueError):
        Config().override([])
    with pytest.raises(FileNotFoundError):
        files.promote(tmp_path, tmp_path / "p")
    for n in files.NEEDED:
        files.write_json({"a": np.int64(1)}, tmp_path / n)
    files.promote(tmp_path, tmp_path / "p")
    assert files.production_run(tmp_path / "p") == tmp_path.resolve() and files.read_json(tmp_path / "policy.json") == {"a": 1}
    assert scoring.diff_runs({"n_total": 1}, {"n_total": 3, "best_model": "lr"})[0]["delta_b_minus_a"] == 2
    assert "<h2>" in dashboard.render({}, {}) and "&lt;b&gt;" in dashboard.table([{"x": "<b>"}])


def test_validation(frame):
    with pytest.raises(eda.InputError):
        eda.validate_inputs(frame, "absent", ["x"])
    with pytest.raises(eda.InputError):
        eda.validate_inputs(frame.where("label = 1"), "label", ["x"])
    with pytest.raises(eda.InputError):
        eda.validate_inputs(frame, "label", ["c"])
