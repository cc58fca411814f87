"""Toxicity: mining, voters, the label model, and what is found on held-out labels."""

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from riskloom.llm import toxicity as T  # noqa: E402


def test_held_out_toxic_documents_are_found_in_every_language(spark):
    folder = "/root/testdata/sf0.1"
    got = T.op3_toxicity(spark, folder)
    assert got.count() == 10_000 and got.where("score < 0 OR score > 1 OR score IS NULL OR predicted <> CAST(score >= 0.7 AS INT)").count() == 0
    labels, lang = spark.read.parquet(f"{folder}/labels.parquet"), spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    held = got.where("held_out").join(labels, "doc_id").join(lang, "doc_id").toPandas()
    toxic = held[held.toxic == 1]
    assert toxic.predicted.mean() >= 0.9
    assert toxic.groupby("lang").predicted.mean().min() >= 0.8
    assert toxic.predicted.sum() >= 0.95 * held.predicted.sum()


def test_beginnings_are_mined_where_their_words_are_dense():
    toxic = [tuple(sorted({f"bad{a}", f"bad{b}", *(f"w{i}{j}" for j in range(40))})) for i, (a, b) in enumerate(zip("abcdefghij", "klmnopqrst"))]
    stray = [tuple(sorted({"badz", *(f"v{i}{j}" for j in range(40))})) for i in range(40)]
    clean = [tuple(f"u{i}{j}" for j in range(40)) for i in range(200)]
    assert ("bad", True) in T.mine_units(toxic, stray + clean) and len(T.mine_units(toxic, stray + clean)) == 1
    assert T.mine_units([], clean) == []


def test_units_of_the_same_texts_share_a_group():
    units = [("a", False), ("b", False), ("c", True), ("d", True), ("e", False)]
    found = [{0: 1, 1: 2, 2: 1}] * 5 + [{3: 1, 4: 1}] * 4
    deal = T.voter_of(units, found)
    assert (deal // 2).tolist() == [0, 0, 0, 1, 1] and (deal % 2).tolist() == [0, 0, 1, 1, 0]
    folded = T.votes_of({0: 1, 3: 5}, 50, deal)
    assert T.unfolded([folded, 0])[:, [0, 3]].tolist() == [[T.CLEAN, T.TOXIC], [0, 0]]


def plain_posterior(model, votes):
    out = []
    for row in votes:
        odds = np.log(model.prior / (1 - model.prior))
        for v, said in enumerate(row):
            if said:
                odds += model.weight[v] * np.log(model.chance[1][v][said] / model.chance[0][v][said])
        out.append(1 / (1 + np.exp(-(odds if any(row) else model.silent))))
    return np.array(out)


def simulated(rng, n, copy):
    """Three voters that speak in half of the texts and are right in 0.9, 0.8 and 0.7; with `copy` a fourth repeats the third."""
    y = (rng.random(n) < 0.4).astype(int)
    votes = np.zeros((n, T.VOTERS), int)
    for v, right in enumerate((0.9, 0.8, 0.7)):
        speaks = rng.random(n) < 0.5
        says = np.where(rng.random(n) < right, y, 1 - y)
        votes[:, v] = np.where(speaks, np.where(says == 1, T.TOXIC, T.CLEAN), T.ABSTAIN)
    if copy:
        votes[:, 3] = votes[:, 2]
    return votes, y


def test_label_model_finds_accuracies_and_discounts_what_repeats():
    rng = np.random.default_rng(0)
    votes, y = simulated(rng, 20_000, True)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    known, known_y = simulated(rng, 300, True)
    m = T.fit_label_model(patterns, counts.astype(float), known, known_y)
    assert np.allclose(m.posterior(patterns), plain_posterior(m, patterns))
    right = m.chance[1][:3, T.TOXIC] / m.chance[1][:3, 1:].sum(axis=1)
    assert np.abs(right - [0.9, 0.8, 0.7]).max() < 0.06
    assert m.weight[2] < 0.65 and m.weight[3] < 0.65 and m.weight[:2].min() > 0.85
    spoken = votes.any(axis=1)
    assert ((m.posterior(votes) > 0.5) == y)[spoken].mean() > 0.75


def test_label_model_without_votes_or_labels():
    none = np.zeros((1, T.VOTERS), int)
    m = T.fit_label_model(none, np.array([5.0]), np.zeros((0, T.VOTERS), int), np.zeros(0, int))
    assert m.posterior(none)[0] < 0.5


def test_scores_of_odd_texts(spark):
    model = T.ToxicityModel([("scum", False), ("bad", True)], np.array([1.0, 1.0, 0.5, 1.0]), -3.0)
    rows = [(None, None, 0.5), (1, "", 0.5), (2, "x" * 300_000, 0.5), (3, "SCUM, scum! badly", 0.5), (3, "SCUM, scum! badly", 0.5), (4, "scumm abad", 0.5)]
    got = T.score_toxicity(spark.createDataFrame(rows, "doc_id long, text string, score double"), model, ("doc_id", "score")).collect()
    by = {r["doc_id"]: (r["score"], r["predicted"]) for r in got}
    assert len(got) == 6 and got[0].asDict().keys() == {"doc_id", "score", "predicted"}
    assert by[None] == by[1] == by[2] == by[4] and by[3][1] == 1 and by[1][1] == 0
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert T.score_toxicity(empty, model).count() == 0
    marks = spark.createDataFrame([], "doc_id long, toxic int")
    assert T.score_toxicity(empty, T.fit_toxicity(empty, marks)).count() == 0
