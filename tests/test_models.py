"""Attributions, parameter search and categories in the booster against plain versions."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import attribution
from riskloom.operators.boosting import MOST_BINS, Booster, BoosterParams, booster_space, category_cuts, tune_booster
from riskloom.operators.search import Dimension, Search


@pytest.fixture(scope="module")
def mixed(spark):
    """x and z are numbers with gaps, c a category whose bad rate falls from a to e, with nulls; a third of it is one value."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(1500):
        x, z = float(rng.normal()), float(rng.integers(0, 5))
        c = str(rng.choice(["a", "b", "c", "d", "e"], p=[0.15, 0.15, 0.34, 0.18, 0.18]))
        p = 1 / (1 + math.exp(-(1.2 * x + 0.6 * ("edcba".index(c) - 2) - 0.5)))
        rows.append((i, None if i % 11 == 0 else x, None if i % 17 == 0 else z, None if i % 13 == 0 else c, int(rng.random() < p)))
    return spark.createDataFrame(rows, "app_id long, x double, z double, c string, label int").repartition(4).cache()


@pytest.fixture(scope="module")
def model(mixed):
    from riskloom.operators.encoder import WoeEncoder

    woe = WoeEncoder.fit(mixed, (), ("c",)).categories
    return Booster.fit(mixed, ["x", "z", "c"], "label", BoosterParams(trees=5, depth=3, rate=0.3, least_hessian=1, gamma=0), {"x": 1, "c": -1}, "app_id", woe)


def plain_value(model, node, bins, known):
    if "leaf" in node:
        return node["leaf"]
    left, right = (plain_value(model, node[s], bins, known) for s in ("left", "right"))
    if node["feature"] not in known:
        a, b = node["left"]["cover"], node["right"]["cover"]
        return (a * left + b * right) / (a + b)
    b = bins[node["feature"]]
    return left if (node["missing_left"] if b < 0 else b <= node["bin"]) else right


def test_attributions_equal_all_coalitions_and_sum_to_the_margin(mixed, model):
    rows = attribution.attributions(model, mixed, ["app_id"]).join(model.binned(mixed).withColumn("m", model.margin()), "app_id").collect()
    assert len(rows) == 1500
    names = list(model.cuts)
    for r in rows:
        assert abs(sum(r[f"shap_{f}"] for f in names) + r["shap_base"] - r["m"]) < 1e-9
    for r in rows[::50]:
        bins = {f: r[f"_b_{f}"] for f in names}
        v = {frozenset(s): sum(plain_value(model, t, bins, s) for t in model.trees) for k in range(4) for s in itertools.combinations(names, k)}
        for f in names:
            plain = sum(math.factorial(len(s)) * math.factorial(2 - len(s)) / 6 * (v[s | {f}] - v[s]) for s in v if f not in s)
            assert abs(plain - r[f"shap_{f}"]) < 1e-9
    got = [(r["feature"], r["shap_importance"]) for r in attribution.shap_importance(model, mixed).collect()]
    means = {f: sum(abs(r[f"shap_{f}"]) for r in rows) / 1500 for f in names}
    assert [f for f, _ in got] == sorted(means, key=lambda f: (-means[f], f)) and all(abs(means[f] - v) < 1e-9 for f, v in got)


def test_attributions_of_no_rows_and_of_no_splits(mixed, model):
    assert attribution.attributions(model, mixed.limit(0), ["app_id"]).count() == 0
    assert {r["shap_importance"] for r in attribution.shap_importance(model, mixed.limit(0)).collect()} == {0.0}
    stump = Booster({"x": [0.0]}, 0.5, [{"leaf": 0.25, "cover": 3.0}])
    r = attribution.attributions(stump, mixed, ["app_id", "x"]).first()
    assert r["shap_x"] == 0.0 and r["shap_base"] == 0.75 and "label" not in r


def test_booster_of_categories_is_monotone_in_evidence(spark, mixed, model):
    order = sorted(model.woe["c"], key=model.woe["c"].get)
    assert len(order) == 5 and model.importance()["c"] > 0
    one = spark.createDataFrame([(0.3, 2.0, c) for c in [*order, None, "never seen"]], "x double, z double, c string")
    got = {r["c"]: r["model_score"] for r in model.score(one).collect()}
    line = [got[c] for c in order]
    assert all(b <= a + 1e-12 for a, b in zip(line, line[1:])) and line[0] > line[-1]
    assert got[None] == got["never seen"]
    assert Booster.loads(model.dumps()).score(mixed).agg(F.sum("model_score")).first() == model.score(mixed).agg(F.sum("model_score")).first()


def test_unseen_categories_go_where_no_evidence_goes(spark, mixed):
    known = mixed.where("c IS NOT NULL AND x IS NOT NULL AND z IS NOT NULL")
    woe = {"c": {"a": -1.0, "b": -0.5, "c": 0.0, "d": 0.5, "e": 1.0}}
    m = Booster.fit(known, ["c"], "label", BoosterParams(trees=3, depth=2, colsample=1, rate=0.3, least_hessian=1, gamma=0), {"c": -1}, "app_id", woe)
    got = {r["c"]: r["model_score"] for r in m.score(spark.createDataFrame([("c",), (None,), ("new",), ("a",)], "c string")).collect()}
    assert got[None] == got["new"] == got["c"] != got["a"]


def test_category_cuts_part_all_bins():
    assert category_cuts({"a": 1.0, "b": 2.0, "c": 1.0}) == [1.5]
    assert category_cuts({"a": 1.0}) == [] == category_cuts({})
    many = category_cuts({str(i): float(i) for i in range(1000)})
    assert len(many) == MOST_BINS - 1 == len(set(many)) and many == sorted(many)


SPACE = (Dimension("a", 1e-3, 10.0, log=True), Dimension("b", -5.0, 5.0), Dimension("n", 100, 500, whole=True, step=50))


def bowl(p):
    return -((math.log10(p["a"]) + 1) ** 2) - (p["b"] - 2) ** 2 / 4 - ((p["n"] - 300) / 100) ** 2


def test_search_beats_random_draws():
    found, drawn = [], []
    for seed in range(12):
        s = Search(SPACE, seed)
        s.run(bowl, 60)
        found.append(s.best[1])
        turn = random.Random(seed)
        drawn.append(max(bowl({d.name: d.outer(turn.uniform(*d.ends)) for d in SPACE}) for _ in range(60)))
        for p, _ in s.trials:
            assert 1e-3 <= p["a"] <= 10 and -5 <= p["b"] <= 5 and p["n"] in range(100, 501, 50)
    assert sum(found) / 12 > 0.5 * sum(drawn) / 12 and sum(a > b for a, b in zip(found, drawn)) >= 9


def test_search_repeats_and_resumes(spark):
    whole = Search(SPACE, 5)
    whole.run(bowl, 30)
    again = Search(SPACE, 5)
    again.run(bowl, 30)
    assert again.trials == whole.trials
    half = Search(SPACE, 5)
    half.run(bowl, 17)
    rest = Search(SPACE, 5).resume(half.table(spark))
    rest.run(bowl, 30)
    assert rest.trials == whole.trials and Search(SPACE, 6).ask() != whole.trials[0][0]
    odd = Search(SPACE, 1)
    odd.run(lambda p: float("nan") if p["b"] > -4.5 else 1.0, 40)
    assert odd.table(spark).where("value IS NULL").count() == sum(v == -math.inf for _, v in odd.trials) > 0
    with pytest.raises(ValueError):
        _ = Search(SPACE).best


def test_booster_search_keeps_its_trials(mixed):
    a, b = mixed.where("app_id % 5 <> 0"), mixed.where("app_id % 5 = 0")
    search = Search(booster_space((1, 2)), 3)
    p = tune_booster(a, b, ["x"], trials=2, seed=3, search=search)
    assert len(search.trials) == 2 and p.trees in (1, 2) and 0.5 <= p.positive <= 2 and search.best[1] > 0.1
    assert tune_booster(a, b, ["x"], trials=2, seed=3, search=search) == p  # all trials are there already
