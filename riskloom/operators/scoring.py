"""Decisions for new data, and drift against the training data."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.expressions import bin_left_closed, floored, psi_label, share
from riskloom.operators.binning import cuts_map, long_form
from riskloom.operators.ordered import quantiles
from riskloom.operators.policy import decision_thresholds, segment_table, table_thresholds, with_segments
from riskloom.operators.rules import Rule, rule_mask

#: Segments of a policy that become branches of a plan; more are met as a table.
MOST_INLINE = 100
RESERVED = ("decision", "reject_by_rule", "reject_by_score", "hit_rules", "reject_threshold", "review_threshold", "out_credit_score", "calibrated_prob")


def policy_document(overall: dict, picked: Sequence[dict], rules: Sequence[Rule], label: str, now: datetime | None = None) -> dict:
    overrides = [{k: p[k] for k in ("segment_feature", "segment_value", "reject_threshold", "review_threshold")} for p in picked]
    return {"generated_at": (now or datetime.now()).isoformat(timespec="seconds"), "label_col": label, "score_thresholds": {k: float(overall[k]) for k in ("reject", "review")}, "segment_overrides": overrides, "reject_rules": [r.document() for r in rules]}


def apply_policy(df: DataFrame, policy: dict | None, score: str = "model_score", segments: DataFrame | None = None) -> DataFrame:
    """Adds decision, reasons and thresholds: reject before review before approve, later segments first.

    Segments' thresholds come from the policy, or from a table of any size (policy.segment_table()).

    Without a policy the rows pass as they are. Unknown columns are an error, as a rule that can't
    be read must not turn into one that hits everything or nothing.
    """
    if not policy:
        return df
    if taken := [c for c in RESERVED if c in df.columns and c != "calibrated_prob"]:
        raise ValueError(f"the input has columns that decisions write: {taken}")
    rules = [Rule.of(d, i) for i, d in enumerate(policy.get("reject_rules", []))]
    masks = [rule_mask(r, df.columns) for r in rules]
    overrides, names = policy.get("segment_overrides", []), []
    if segments is None and len(overrides) > MOST_INLINE:
        segments = segment_table(df.sparkSession, overrides)
    if segments is None:
        reject, review = decision_thresholds(policy.get("score_thresholds"), overrides)
    else:
        df, names = with_segments(df, segments)
        reject, review = table_thresholds(policy.get("score_thresholds"), names)
    out = df.withColumns({"reject_threshold": reject, "review_threshold": review}).drop(*names)
    by_rule = F.lit(False)
    for m in masks:
        by_rule = by_rule | m
    s = F.col(score)
    out = out.withColumns({"reject_by_rule": by_rule, "reject_by_score": F.coalesce(s >= F.col("reject_threshold"), F.lit(False)), "hit_rules": F.concat_ws("; ", *(F.when(m, F.lit(r.text)) for m, r in zip(masks, rules)))})
    decision = F.when(F.col("reject_by_rule") | F.col("reject_by_score"), "reject").when(F.coalesce(s >= F.col("review_threshold"), F.lit(False)), "review").otherwise("approve")
    return out.withColumn("decision", decision)


def drift_baseline(df: DataFrame, features: Sequence[str], bins: int = 10, least: int = 10) -> DataFrame:
    """feature, breakpoints, expected_pct, missing_rate for features with at least `least` values.

    Breakpoints are the distinct inner deciles; bins are [a, b) with open ends.
    """
    rows = long_form(df, features, ())
    q = quantiles(rows.where("value IS NOT NULL"), "value", [i / bins for i in range(bins + 1)], ["feature"])
    cuts = {r["feature"]: sorted(set(r["q"]))[1:-1] for r in q.collect()}
    edges = F.element_at(cuts_map(cuts), F.col("feature"))
    counts = rows.where(F.col("feature").isin(*cuts)).withColumn("bin", F.when(F.col("value").isNotNull(), bin_left_closed(F.col("value"), edges))).groupBy("feature", "bin").agg(F.count("*").alias("n"))
    sums = counts.groupBy("feature").agg(F.sum(F.when(F.col("bin").isNotNull(), F.col("n"))).alias("known"), F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.when(F.col("bin").isNotNull(), F.struct("bin", "n")))).alias("by"))
    at = F.transform(F.sequence(F.lit(0), F.size("breakpoints")), lambda i: F.round(share(F.coalesce(F.try_element_at("by", i), F.lit(0)), F.col("known")), 8))
    return sums.where(F.col("known") >= least).withColumn("breakpoints", edges).select("feature", "breakpoints", at.alias("expected_pct"), F.round(1 - share(F.col("known"), F.col("n")), 6).alias("missing_rate"))


def drift_check(df: DataFrame, baseline: DataFrame) -> DataFrame:
    """feature, psi, psi_level and missing rates of new data against a baseline, which is small."""
    base = {r["feature"]: r for r in baseline.collect()}
    features = [f for f in base if f in df.columns]
    edges = F.element_at(cuts_map({f: list(base[f]["breakpoints"]) for f in features}), F.col("feature"))
    rows = df.select(*(F.expr(f"try_cast(`{f}` AS double)").alias(f) for f in features), *(F.col(f).isNull().alias(f"_{f}") for f in features))
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.when(~F.isnan(f), F.col(f)).alias("value"), (F.col(f"_{f}")).alias("missing")) for f in features])
    flat = rows.select(F.inline(pairs)).withColumn("bin", F.when(F.col("value").isNotNull(), bin_left_closed(F.col("value"), edges)))
    counts = flat.groupBy("feature", "bin").agg(F.count("*").alias("n"), F.count_if("missing").alias("m"))
    spark = df.sparkSession
    want = spark.createDataFrame([(f, i, float(p), float(base[f]["missing_rate"])) for f in features for i, p in enumerate(base[f]["expected_pct"])], "feature string, bin int, expected double, train_missing_rate double")
    totals = counts.groupBy("feature").agg(F.sum(F.when(F.col("bin").isNotNull(), F.col("n"))).alias("known"), F.sum("n").alias("rows"), F.sum("m").alias("missing"))
    full = want.join(counts.select("feature", "bin", "n"), ["feature", "bin"], "left").join(totals, "feature")
    floor = lambda c: F.greatest(c, F.lit(1e-6))
    a, e = floor(share(F.coalesce("n", F.lit(0)), F.col("known"))), floor(F.col("expected"))
    out = full.groupBy("feature").agg(F.round(F.sum((a - e) * F.log(a / e)), 6).alias("psi"), F.max("train_missing_rate").alias("train_missing_rate"), F.round(share(F.max("missing"), F.max("rows")), 6).alias("new_missing_rate"))
    return out.select("feature", "psi", psi_label(F.col("psi")).alias("psi_level"), "train_missing_rate", "new_missing_rate", F.round(F.col("new_missing_rate") - F.col("train_missing_rate"), 6).alias("missing_rate_delta"))


def flatten_run(summary: dict, policy: dict | None = None) -> dict[str, object]:
    """A run's summary, best strategy and policy as metric names and values, in a fixed order."""
    out = {k: summary.get(k) for k in ("n_total", "best_model", "n_selected_vars", "n_stable_rules") if k in summary}
    for model, parts in (summary.get("model_metrics") or {}).items():
        for part, figures in parts.items():
            out |= {f"{model}_{part}_{k}": figures[k] for k in ("KS", "AUC") if k in figures}
    out |= dict(summary.get("overfit_diagnostics") or {}) | dict(summary.get("best_strategy") or {})
    if policy:
        at = policy.get("score_thresholds") or {}
        out |= {"policy_reject_threshold": at.get("reject"), "policy_review_threshold": at.get("review"), "policy_n_reject_rules": len(policy.get("reject_rules", [])), "policy_n_segment_overrides": len(policy.get("segment_overrides", []))}
    return out


def diff_runs(a: dict, b: dict, policy_a: dict | None = None, policy_b: dict | None = None) -> list[dict]:
    """metric, run_a, run_b, delta_b_minus_a for every metric of either run, first seen first."""
    fa, fb = flatten_run(a, policy_a), flatten_run(b, policy_b)
    rows = []
    for m in dict.fromkeys([*fa, *fb]):
        x, y = fa.get(m), fb.get(m)
        numbers = all(isinstance(v, (int, float)) and not isinstance(v, bool) for v in (x, y))
        rows.append({"metric": m, "run_a": x, "run_b": y, "delta_b_minus_a": round(y - x, 6) if numbers else None})
    return rows


def dump(document: dict) -> str:
    return json.dumps(document, ensure_ascii=False, indent=2, default=lambda x: x.item() if hasattr(x, "item") else str(x))
