"""Reject rules: compiling them to columns, mining them, testing them on every part at once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.expressions import bin_left_closed, bin_right_closed, share
from riskloom.operators.binning import cuts_map, long_form, long_text
from riskloom.operators.ordered import quantiles

#: Mask expressions in one aggregate; more are taken in turns over the same rows.
CHUNK = 150


@dataclass(frozen=True)
class Condition:
    feature: str
    op: str
    value: float | str
    #: What a missing value of the feature counts as; rules mined on imputed rows carry it.
    impute: float | None = None


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    rule_type: str = "single"
    rule_id: int = 0
    stats: dict = field(default_factory=dict, compare=False, hash=False)

    @property
    def text(self) -> str:
        return " and ".join(f"{c.feature} {c.op} {c.value}" for c in self.conditions)

    def document(self) -> dict:
        return {"rule_type": self.rule_type, "condition_str": self.text, "conditions": [asdict(c) for c in self.conditions]}

    @staticmethod
    def of(document: dict, rule_id: int = 0) -> Rule:
        return Rule(tuple(Condition(**c) for c in document["conditions"]), document.get("rule_type", "single"), rule_id)


def rule_mask(rule: Rule, columns: Sequence[str]) -> Column:
    """The rows that a rule hits; a comparison with a missing value is false, an unknown column an error."""
    parts = []
    for c in rule.conditions:
        if c.feature not in columns:
            raise KeyError(f"the rule '{rule.text}' needs the column {c.feature}")
        x = F.col(c.feature)
        if c.op == "==":
            hit = x.cast("string") == str(c.value)
        else:
            x = x.cast("double")
            x = F.when(F.isnan(x), None).otherwise(x)
            x = x if c.impute is None else F.coalesce(x, F.lit(float(c.impute)))
            v = F.lit(float(c.value))
            hit = {">=": x >= v, "<=": x <= v, ">": x > v, "<": x < v}[c.op]
        parts.append(F.coalesce(hit, F.lit(False)))
    if not parts:
        raise ValueError("a rule without conditions would hit every row")
    return reduce(lambda a, b: a & b, parts)


def any_rule(rules: Sequence[Rule], columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [rule_mask(r, columns) for r in rules], F.lit(False))


def hit_stats(hits: Column, bad: Column, n: Column, n_bad: Column) -> dict[str, Column]:
    """coverage, bad_rate, lift of counts."""
    return {"coverage": share(hits, n), "bad_rate": share(bad, hits), "lift": share(share(bad, hits), share(n_bad, n))}


def single_candidates(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str = "label") -> DataFrame:
    """feature, direction, threshold, value, hits, bad for every candidate of one condition.

    Numeric thresholds are the distinct 5th to 95th percentiles, each with >= and <=. Rows are
    counted once by their place among a feature's thresholds; a candidate's hits are sums of those
    counts, so the cost doesn't grow with the number of candidates.
    """
    out = None
    if numeric:
        rows = long_form(df, numeric, (F.col(label).alias("label"),)).where("value IS NOT NULL")
        found = quantiles(rows, "value", [i / 100 for i in range(5, 100, 5)], ["feature"]).collect()
        cuts = {r["feature"]: sorted(set(r["q"])) for r in found}
        edges = F.element_at(cuts_map(cuts), F.col("feature"))
        places = rows.select("feature", "label", bin_left_closed(F.col("value"), edges).alias("ge"), bin_right_closed(F.col("value"), edges).alias("gt"))
        counts = places.groupBy("feature", "ge", "gt").agg(F.count("*").alias("n"), F.sum("label").cast("long").alias("b"))
        points = counts.select(*counts.columns, F.posexplode(edges).alias("k", "threshold"))
        hit = lambda c, up: F.sum(F.when(F.col("ge") > F.col("k") if up else F.col("gt") <= F.col("k"), F.col(c)).otherwise(0))
        sums = points.groupBy("feature", "k", "threshold").agg(*(hit(c, up).alias(f"{c}{int(up)}") for c in ("n", "b") for up in (True, False)))
        both = F.inline(F.array(*[F.struct(F.lit(d).alias("direction"), F.col(f"n{i}").alias("hits"), F.col(f"b{i}").alias("bad")) for d, i in ((">=", 1), ("<=", 0))]))
        out = sums.select("feature", "threshold", F.lit(None).cast("string").alias("value"), both)
    if categorical:
        rows = long_text(df, categorical, (F.col(label).alias("label"),)).where("value IS NOT NULL")
        one = rows.groupBy("feature", "value").agg(F.count("*").alias("hits"), F.sum("label").cast("long").alias("bad")).select("feature", F.lit(None).cast("double").alias("threshold"), "value", F.lit("==").alias("direction"), "hits", "bad")
        out = one if out is None else out.unionByName(one)
    return out


def mine_single(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str = "label", most_coverage: float = 0.05, least_lift: float = 2.0, least_hits: int = 5) -> DataFrame:
    """The best candidate of each feature and direction that passes the limits, which hold for rounded figures.

    Ties of lift go to the smaller coverage, then the threshold or value.
    """
    n, n_bad = (df.agg(a).scalar() for a in (F.count("*"), F.sum(label)))
    rows = single_candidates(df, numeric, categorical, label).where("hits > 0").withColumns({"_n": n, "_b": n_bad})
    stats = hit_stats(F.col("hits"), F.col("bad"), F.col("_n"), F.col("_b"))
    rows = rows.select("feature", "direction", F.round("threshold", 6).alias("threshold"), "value", F.round(stats["coverage"], 4).alias("coverage"), F.col("hits").alias("hit_count"), F.round(stats["bad_rate"], 4).alias("bad_rate"), F.round(share(F.col("_b"), F.col("_n")), 4).alias("overall_bad_rate"), F.round(stats["lift"], 4).alias("lift"))
    good = rows.where((F.col("coverage") <= most_coverage) & (F.col("lift") >= least_lift) & (F.col("hit_count") >= least_hits))
    best = good.groupBy("feature", "direction").agg(F.min_by(F.struct("threshold", "value", "coverage", "hit_count", "bad_rate", "overall_bad_rate", "lift"), F.struct(-F.col("lift"), "coverage", "threshold", "value")).alias("r"))
    return best.select("feature", "direction", "r.*")


def rules_of(mined: DataFrame) -> list[Rule]:
    """Mined rows as rules, best lift first."""
    rows = sorted(mined.collect(), key=lambda r: (-r["lift"], r["feature"], r["direction"]))
    return [Rule((Condition(r["feature"], r["direction"], r["value"] if r["direction"] == "==" else r["threshold"]),), "single", i, r.asDict()) for i, r in enumerate(rows)]


def merge_rules(*mined: Sequence[Rule]) -> list[Rule]:
    """Rules of several miners in one list, best lift first and numbered anew; of rules with one text the first stays."""
    ordered = sorted((r for part in mined for r in part), key=lambda r: (-r.stats["lift"], r.text))
    once = list({r.text: r for r in reversed(ordered)}.values())[::-1]
    return [Rule(r.conditions, r.rule_type, i, r.stats) for i, r in enumerate(once)]


def _chunks(items: Sequence, size: int = CHUNK):
    return [items[i : i + size] for i in range(0, len(items), size)]


BACKTEST = T.StructType([T.StructField(n, k) for n, k in (("dataset", T.StringType()), ("rule_id", T.IntegerType()), ("condition", T.StringType()), ("coverage", T.DoubleType()), ("hit_count", T.LongType()), ("bad_rate", T.DoubleType()), ("lift", T.DoubleType()))])


def backtest(df: DataFrame, rules: Sequence[Rule], label: str = "label", by: str = "split") -> DataFrame:
    """dataset, rule_id, condition, coverage, hit_count, bad_rate, lift: all rules over all parts in one scan a chunk."""
    out = df.sparkSession.createDataFrame([], BACKTEST)
    for part in _chunks(rules):
        masks = [rule_mask(r, df.columns) for r in part]
        sums = df.groupBy(F.col(by).alias("dataset")).agg(F.count("*").alias("n"), F.sum(label).alias("b"), *(c for i, m in enumerate(masks) for c in (F.count_if(m).alias(f"h{i}"), F.sum(F.when(m, F.col(label)).otherwise(0)).alias(f"b{i}"))))
        rows = sums.select("dataset", "n", "b", F.inline(F.array(*[F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.text).alias("condition"), F.col(f"h{i}").alias("hit_count"), F.col(f"b{i}").alias("hb")) for i, r in enumerate(part)])))
        stats = hit_stats(F.col("hit_count"), F.col("hb"), F.col("n"), F.col("b"))
        out = out.unionByName(rows.select("dataset", "rule_id", "condition", F.round(stats["coverage"], 4).alias("coverage"), "hit_count", F.round(stats["bad_rate"], 4).alias("bad_rate"), F.round(stats["lift"], 4).alias("lift")))
    return out


def combined_effect(df: DataFrame, rules: Sequence[Rule], label: str = "label", by: str = "split") -> DataFrame:
    """What all rules together reject, and the bad rate of what passes (null if nothing does)."""
    hit = any_rule(rules, df.columns)
    sums = df.groupBy(F.col(by).alias("dataset")).agg(F.count("*").alias("n"), F.sum(label).alias("b"), F.count_if(hit).alias("hit_count"), F.sum(F.when(hit, F.col(label)).otherwise(0)).alias("hb"))
    stats = hit_stats(F.col("hit_count"), F.col("hb"), F.col("n"), F.col("b"))
    passed = F.try_divide((F.col("b") - F.col("hb")).cast("double"), (F.col("n") - F.col("hit_count")).cast("double"))
    return sums.select("dataset", F.lit(len(rules)).alias("rule_count"), F.round(stats["coverage"], 4).alias("reject_rate"), "hit_count", F.round(stats["bad_rate"], 4).alias("hit_bad_rate"), F.round(share(F.col("b"), F.col("n")), 4).alias("overall_bad_rate"), F.round(passed, 4).alias("passed_bad_rate"), F.round(stats["lift"], 4).alias("lift"))


def overlap_matrix(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """rule_a, rule_b, both, overlap: shared hits over the smaller of the two, 0 if either has none."""
    masks = [rule_mask(r, df.columns) for r in rules]
    flags = df.select(*(m.cast("int").alias(f"m{i}") for i, m in enumerate(masks)))
    pairs = [(i, j) for i in range(len(rules)) for j in range(i + 1, len(rules))]
    out = df.sparkSession.createDataFrame([], "rule_a int, rule_b int, both long, overlap double")
    for part in _chunks(pairs):
        sums = flags.agg(*(F.sum(f"m{i}").alias(f"n{i}") for i in {x for p in part for x in p}), *(F.sum(F.col(f"m{i}") * F.col(f"m{j}")).alias(f"x{k}") for k, (i, j) in enumerate(part)))
        rows = F.inline(F.array(*[F.struct(F.lit(rules[i].rule_id).alias("rule_a"), F.lit(rules[j].rule_id).alias("rule_b"), F.coalesce(f"x{k}", F.lit(0)).cast("long").alias("both"), F.round(share(F.col(f"x{k}"), F.least(f"n{i}", f"n{j}")), 6).alias("overlap")) for k, (i, j) in enumerate(part)]))
        out = out.unionByName(sums.select(rows))
    return out


def drop_overlapping(df: DataFrame, rules: Sequence[Rule], limit: float = 0.8) -> list[Rule]:
    """Greedy in the given order: a rule goes if it shares `limit` of the smaller one's hits with a kept rule."""
    near = {(r["rule_a"], r["rule_b"]) for r in overlap_matrix(df, rules).where(F.col("overlap") >= limit).collect()}
    kept: list[Rule] = []
    for r in rules:
        if not any((k.rule_id, r.rule_id) in near or (r.rule_id, k.rule_id) in near for k in kept):
            kept.append(r)
    return kept


def rule_stability(tested: DataFrame, most_coverage: float = 0.05, least_lift: float = 2.0, least_hits: int = 5, most_drop: float = 0.35) -> DataFrame:
    """backtest() turned wide, with the lift gap from test to valid and whether all parts pass the limits."""
    figures = ("coverage", "bad_rate", "lift", "hit_count")
    wide = tested.groupBy("rule_id", "condition").pivot("dataset", ["train", "test", "valid"]).agg(*(F.first(c).alias(c) for c in figures))
    named = wide.select("rule_id", "condition", *(F.col(f"{d}_{c}").alias(f"{c}_{d}") for d in ("train", "test", "valid") for c in figures))
    gap = F.round(F.col("lift_test") - F.col("lift_valid"), 4)
    ok = reduce(lambda a, b: a & b, [(F.col(f"coverage_{d}") <= most_coverage) & (F.col(f"lift_{d}") >= least_lift) & (F.col(f"hit_count_{d}") >= least_hits) for d in ("train", "test", "valid")])
    return named.withColumn("lift_gap_test_valid", gap).withColumn("stable_pass", F.coalesce(ok & (F.col("lift_gap_test_valid") <= most_drop), F.lit(False)))


def marginal_contribution(df: DataFrame, rules: Sequence[Rule], label: str = "label", by: str = "split") -> DataFrame:
    """What each rule adds in the given order: rows are counted by the first rule that hits them."""
    masks = [rule_mask(r, df.columns) for r in rules]
    first = reduce(lambda a, x: a.when(x[1], F.lit(x[0])), list(enumerate(masks))[1:], F.when(masks[0], F.lit(0))).otherwise(F.lit(-1))
    flat = df.select(F.col(by).alias("dataset"), F.col(label).alias("y"), first.alias("first"), *(m.alias(f"m{i}") for i, m in enumerate(masks)))
    sums = flat.groupBy("dataset").agg(F.count("*").alias("n"), F.sum("y").alias("b"), *(c for i in range(len(rules)) for c in (F.count_if(f"m{i}").alias(f"h{i}"), F.count_if(F.col("first") == i).alias(f"f{i}"), F.sum(F.when(F.col("first") == i, F.col("y")).otherwise(0)).alias(f"g{i}"))))
    total = lambda i: reduce(lambda a, b: a + b, [F.col(f"f{k}") for k in range(i + 1)])
    rows = F.inline(F.array(*[F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.text).alias("condition"), F.col(f"h{i}").alias("rule_hit_count"), F.col(f"f{i}").alias("marginal_hit_count"), F.col(f"g{i}").cast("long").alias("marginal_bad_count"), total(i).alias("cumulative_hit_count")) for i, r in enumerate(rules)]))
    out = sums.select("dataset", "n", "b", rows)
    rate = share(F.col("marginal_bad_count"), F.col("marginal_hit_count"))
    return out.select("dataset", "rule_id", "condition", "rule_hit_count", "marginal_hit_count", "marginal_bad_count", F.round(rate, 4).alias("marginal_bad_rate"), F.round(share(rate, share(F.col("b"), F.col("n"))), 4).alias("marginal_lift"), "cumulative_hit_count", F.round(share(F.col("cumulative_hit_count"), F.col("n")), 4).alias("cumulative_reject_rate"))
