"""DuckDB SQL for the registered queries, written independently of the operators."""

from __future__ import annotations

import itertools
import math
import re

from riskloom.plans.queries import FIXED_BOOSTER
from riskloom.sources.apps import APPS_SQL

D = "CAST({} AS DOUBLE)".format


def _with(body: str, *ctes: str) -> str:
    return APPS_SQL + "".join(f", {c}" for c in ctes) + "\n" + body


def _r(expr: str, name: str, places: int = 6) -> str:
    return f"round({expr}, {places}) AS {name}"


def _share(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0)"


def _long(features, keep="label", table="apps") -> str:
    return " UNION ALL ".join(f"SELECT {keep}, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM {table}" for f in features)


def _text(features, keep="label", table="apps", missing="'missing'") -> str:
    return " UNION ALL ".join(f"SELECT {keep}, '{f}' AS feature, coalesce(CAST({f} AS VARCHAR), {missing}) AS bin_label FROM {table}" for f in features)


def _quantiles(steps: int, inner: bool = False) -> str:
    points = range(1, steps) if inner else range(steps + 1)
    return "[" + ", ".join(D(i / steps) for i in points) + "]"


CUTS = "cuts AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, " + _quantiles(10) + "))) AS q FROM rows_ WHERE value IS NOT NULL GROUP BY 1), inner_ AS (SELECT feature, q[2:len(q) - 1] AS c FROM cuts)"
UNIFORM = "inner_ AS (SELECT feature, CASE WHEN min(value) = max(value) THEN CAST([] AS DOUBLE[]) ELSE list_transform([1,2,3,4,5,6,7,8,9], lambda k: min(value) + (max(value) - min(value)) * k / CAST(10 AS DOUBLE)) END AS c FROM rows_ GROUP BY 1)"
BINNED = "binned AS (SELECT feature, label, c, CASE WHEN value IS NULL THEN -1 ELSE len(list_filter(c, lambda t: t < value)) END AS bin FROM rows_ JOIN inner_ USING (feature))"


def _woe(by: str, table: str) -> str:
    """Counts, shares, woe and iv by feature and `by`."""
    return f"""sums AS (SELECT feature, {by}, CAST(sum(label) AS BIGINT) AS bad, count(*) AS total, CAST(count(*) - sum(label) AS BIGINT) AS good FROM {table} GROUP BY feature, {by}),
shares AS (SELECT *, CASE WHEN bad = 0 THEN CAST(1e-6 AS DOUBLE) ELSE bad / greatest(CAST(sum(bad) OVER (PARTITION BY feature) AS DOUBLE), CAST(1e-6 AS DOUBLE)) END AS bad_pct,
  CASE WHEN good = 0 THEN CAST(1e-6 AS DOUBLE) ELSE good / greatest(CAST(sum(good) OVER (PARTITION BY feature) AS DOUBLE), CAST(1e-6 AS DOUBLE)) END AS good_pct FROM sums),
woes AS (SELECT *, ln(good_pct / bad_pct) AS woe, bad / CAST(total AS DOUBLE) AS bad_rate, (good_pct - bad_pct) * ln(good_pct / bad_pct) AS iv_bin FROM shares),
stats AS (SELECT *, sum(iv_bin) OVER (PARTITION BY feature) AS iv FROM woes)"""


NUM_WOE_OUT = "feature, bin, total, bad, good, " + ", ".join(_r(c, c) for c in ("bad_pct", "good_pct", "woe", "bad_rate", "iv_bin", "iv"))
INTERVAL = """CASE WHEN bin < 0 THEN 'missing' ELSE '(' || CASE WHEN bin = 0 THEN '-inf' ELSE printf('%.6f', c[bin]) END || ', ' || CASE WHEN bin >= len(c) THEN 'inf' ELSE printf('%.6f', c[bin + 1]) END || ']' END AS bin_interval"""


def _woe_numeric(cuts: str) -> str:
    rows = f"rows_ AS ({_long(('total_price', 'acct_bal'))})"
    return _with(f"SELECT {NUM_WOE_OUT}, {INTERVAL} FROM stats JOIN inner_ USING (feature)", rows, cuts, BINNED, _woe("bin", "binned"))


NUMERIC = ("total_price", "acct_bal", "n_items", "sum_qty", "avg_disc", "price_copy", "drifting")
CATEGORICAL = ("channel", "priority", "region")
ALL_STATS = (f"rows_ AS ({_long(NUMERIC)})", CUTS, BINNED, f"allbins AS (SELECT feature, label, CAST(bin AS VARCHAR) AS bin_label FROM binned UNION ALL SELECT feature, label, bin_label FROM ({_text(CATEGORICAL)}))", _woe("bin_label", "allbins"))
RANKED = "ranking AS (SELECT feature, iv, CASE WHEN iv < 0.02 THEN 'useless' WHEN iv < 0.1 THEN 'weak' WHEN iv < 0.3 THEN 'medium' WHEN iv < 0.5 THEN 'strong' ELSE 'suspicious' END AS iv_label, row_number() OVER (ORDER BY iv DESC, feature) AS iv_rank FROM (SELECT feature, round(max(iv), 4) AS iv FROM stats GROUP BY 1))"

KINDS = {f: "double" for f in NUMERIC} | {"n_items": "int"} | {f: "string" for f in CATEGORICAL}
QUALITY = "quality AS (" + " UNION ALL ".join(f"SELECT '{f}' AS feature, '{k}' AS dtype, CAST(count(*) - count({f}) AS BIGINT) AS missing_count, {_r(_share(f'count(*) - count({f})', 'count(*)'), 'missing_pct', 4)}, count(DISTINCT {f}) AS unique_count, ({_share(f'count(*) - count({f})', 'count(*)')}) > 0.5 AS is_high_missing FROM apps" for f, k in KINDS.items()) + ")"

KS = """flat AS (SELECT split, model_score, sum(label) AS b, count(*) AS n FROM apps GROUP BY 1, 2),
cum AS (SELECT split, sum(b) OVER w AS cb, sum(n) OVER w AS cn FROM flat WINDOW w AS (PARTITION BY split ORDER BY model_score DESC)),
tot AS (SELECT split, sum(label) AS b, count(*) AS n FROM apps GROUP BY 1),
ks_ AS (SELECT split, greatest(0, max(cb / CAST(b AS DOUBLE) - (cn - cb) / CAST(n - b AS DOUBLE))) AS ks FROM cum JOIN tot USING (split) GROUP BY 1)"""
AUC = """pos AS (SELECT split, model_score, row_number() OVER (PARTITION BY split ORDER BY model_score) AS p, label FROM apps),
avgr AS (SELECT split, label, avg(p) OVER (PARTITION BY split, model_score) AS r FROM pos),
auc_ AS (SELECT split, (sum(r * label) - sum(label) * (sum(label) + 1) / CAST(2 AS DOUBLE)) / (CAST(sum(label) AS DOUBLE) * (count(*) - sum(label))) AS auc FROM avgr GROUP BY 1)"""
METRICS = "metrics AS (SELECT split AS dataset, round(auc, 4) AS auc, round(ks, 4) AS ks, round(2 * auc - 1, 4) AS gini FROM auc_ JOIN ks_ USING (split))"


def _psi(features, first: str, second: str, table: str = "apps") -> tuple[str, ...]:
    """psi_ with feature and psi of rows where `second` against `first`, edges from `first`."""
    keep = f"({first}) AS e, ({second}) AS a"
    return (
        f"rows_ AS ({_long(features, keep, table)})",
        f"edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, {_quantiles(10)}))) AS q FROM rows_ WHERE e AND value IS NOT NULL GROUP BY 1)",
        "placed AS (SELECT feature, e, a, q, CASE WHEN value >= q[1] AND value <= q[len(q)] THEN least(len(list_filter(q, lambda t: t <= value)), len(q) - 1) END AS bin FROM rows_ JOIN edges USING (feature) WHERE value IS NOT NULL)",
        "tots AS (SELECT feature, count(*) FILTER (WHERE e) AS ne, count(*) FILTER (WHERE a) AS na FROM placed GROUP BY 1)",
        "allb AS (SELECT feature, unnest(range(1, greatest(len(q), 2))) AS bin FROM edges)",
        "cnt AS (SELECT feature, bin, count(*) FILTER (WHERE e) AS e, count(*) FILTER (WHERE a) AS a FROM placed WHERE bin IS NOT NULL GROUP BY 1, 2)",
        "pct AS (SELECT b.feature, coalesce(c.e, 0) / CAST(ne AS DOUBLE) AS pe, coalesce(c.a, 0) / CAST(na AS DOUBLE) AS pa FROM allb b LEFT JOIN cnt c ON b.feature = c.feature AND b.bin = c.bin JOIN tots t ON b.feature = t.feature)",
        "floors AS (SELECT feature, CASE WHEN pe = 0 THEN CAST(1e-6 AS DOUBLE) ELSE pe END AS pe, CASE WHEN pa = 0 THEN CAST(1e-6 AS DOUBLE) ELSE pa END AS pa FROM pct)",
        "psi_ AS (SELECT feature, round(sum((pa - pe) * ln(pa / pe)), 6) AS psi FROM floors GROUP BY 1)",
    )


PSI_OUT = "SELECT feature, psi, CASE WHEN psi IS NULL THEN 'unknown' WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.25 THEN 'warning' ELSE 'unstable' END AS psi_label FROM psi_"
HALVES = "halves AS (SELECT *, row_number() OVER (ORDER BY apply_time, app_id) <= floor((SELECT count(*) FROM apps) / 2) AS early FROM apps)"

SCORE_BINS = (
    f"tq AS (SELECT list_sort(list_distinct(quantile_cont(model_score, {_quantiles(10)}))) AS q FROM apps WHERE split = 'train')",
    "sb AS (SELECT split AS dataset, len(list_filter(q[2:len(q) - 1], lambda t: t < model_score)) AS score_bin, label, model_score FROM apps, tq)",
    "sbc AS (SELECT dataset, score_bin, count(*) AS count, CAST(sum(label) AS BIGINT) AS bad_count, min(model_score) AS score_min, max(model_score) AS score_max FROM sb GROUP BY 1, 2)",
    "sbo AS (SELECT *, row_number() OVER w AS bin_order, bad_count / CAST(count AS DOUBLE) AS raw_bad_rate, sum(bad_count) OVER w / CAST(sum(bad_count) OVER (PARTITION BY dataset) AS DOUBLE) AS cum_bad_capture, sum(bad_count) OVER (PARTITION BY dataset) / CAST(sum(count) OVER (PARTITION BY dataset) AS DOUBLE) AS overall FROM sbc WINDOW w AS (PARTITION BY dataset ORDER BY score_bin DESC))",
    "sbm AS (SELECT *, coalesce(raw_bad_rate <= lag(raw_bad_rate) OVER (PARTITION BY dataset ORDER BY bin_order), true) AS step FROM sbo)",
    "spans AS (SELECT a.dataset, a.bin_order AS j, b.bin_order AS k, sum(b.raw_bad_rate * b.count) OVER w / sum(b.count) OVER w AS m FROM sbo a JOIN sbo b ON a.dataset = b.dataset AND b.bin_order >= a.bin_order WINDOW w AS (PARTITION BY a.dataset, a.bin_order ORDER BY b.bin_order))",
    "fit AS (SELECT dataset, i, min(m) AS monotone_bad_rate FROM (SELECT s.dataset, o.bin_order AS i, s.j, max(s.m) AS m FROM spans s JOIN sbo o ON s.dataset = o.dataset AND s.j <= o.bin_order AND s.k >= o.bin_order GROUP BY 1, 2, 3) GROUP BY 1, 2)",
    "sbr AS (SELECT sbm.*, monotone_bad_rate, bool_and(step) OVER (PARTITION BY sbm.dataset) AS raw_bad_rate_monotone FROM sbm JOIN fit ON sbm.dataset = fit.dataset AND sbm.bin_order = fit.i)",
    "report AS (SELECT r.*, raw_bad_rate / overall AS lift, monotone_bad_rate / overall AS monotone_lift, train_bad_rate, raw_bad_rate - train_bad_rate AS bad_rate_gap_vs_train, monotone_bad_rate - train_monotone AS monotone_bad_rate_gap_vs_train FROM sbr r LEFT JOIN (SELECT score_bin, raw_bad_rate AS train_bad_rate, monotone_bad_rate AS train_monotone FROM sbr WHERE dataset = 'train') t USING (score_bin))",
)

#: Masks of the query's rules, in order, and their texts.
RULES = (
    ("coalesce(total_price >= 450000, false)", "total_price >= 450000.0"),
    ("coalesce(sum_qty >= 230, false)", "sum_qty >= 230.0"),
    ("coalesce(total_price > 380000, false) AND coalesce(channel = 'BUILDING', false)", "total_price > 380000.0 and channel == BUILDING"),
    ("coalesce(total_price >= 460000, false) AND coalesce(n_items >= 2, false)", "total_price >= 460000.0 and n_items >= 2.0"),
)
HIT_ROWS = "hits AS (" + " UNION ALL ".join(f"SELECT split AS dataset, label, {i} AS rule_id, '{t}' AS condition, ({m}) AS hit FROM apps" for i, (m, t) in enumerate(RULES)) + ")"
BACKTEST = f"""tested AS (SELECT dataset, CAST(rule_id AS INTEGER) AS rule_id, condition, {_r(_share('count(*) FILTER (WHERE hit)', 'count(*)'), 'coverage', 4)}, count(*) FILTER (WHERE hit) AS hit_count,
  {_r(_share('sum(label) FILTER (WHERE hit)', 'count(*) FILTER (WHERE hit)'), 'bad_rate', 4)}, {_r(_share(_share('sum(label) FILTER (WHERE hit)', 'count(*) FILTER (WHERE hit)'), _share('sum(label)', 'count(*)')), 'lift', 4)} FROM hits GROUP BY 1, 2, 3)"""
ANY4 = " OR ".join(f"({m})" for m, _ in RULES)


def _policy_rows(grid: str, score: str = "model_score") -> str:
    """Figures of a grid (policy_id, reject_threshold, review_threshold) over all parts and actions."""
    return f"""acts AS (SELECT unnest(['reject', 'review', 'approve']) AS action),
masks AS (SELECT policy_id, split AS dataset, action, reject_threshold, review_threshold, label,
  CASE action WHEN 'reject' THEN {score} >= reject_threshold WHEN 'review' THEN {score} >= review_threshold AND {score} < reject_threshold ELSE {score} < review_threshold END AS hit FROM apps, {grid}, acts),
figures AS (SELECT policy_id, dataset, action, any_value(reject_threshold) AS reject_threshold, any_value(review_threshold) AS review_threshold, count(*) FILTER (WHERE hit) AS count, {_FIG})"""


_FIG = f"""{_r(_share('count(*) FILTER (WHERE hit)', 'count(*)'), 'rate')}, {_r(_share('sum(label) FILTER (WHERE hit)', 'count(*) FILTER (WHERE hit)'), 'bad_rate')}, {_r(_share('sum(label)', 'count(*)'), 'overall_bad_rate')},
  {_r(_share(_share('sum(label) FILTER (WHERE hit)', 'count(*) FILTER (WHERE hit)'), _share('sum(label)', 'count(*)')), 'lift')} FROM masks GROUP BY 1, 2, 3"""

GRID_POINTS = [(r, v) for r in (0.03, 0.05, 0.08, 0.10) for v in (0.05, 0.10, 0.15)]
GRID = (
    "grid AS (" + " UNION ALL ".join(f"SELECT 'global_r{r:.3f}_v{v:.3f}' AS policy_id, quantile_cont(model_score, {D(repr(1 - r))}) AS reject_threshold, quantile_cont(model_score, {D(repr(max(0.0, 1 - r - v)))}) AS review_threshold FROM apps WHERE split = 'train'" for r, v in GRID_POINTS) + ")",
    _policy_rows("grid"),
)
GRID_OUT = "policy_id, dataset, action, round(reject_threshold, 6) AS reject_threshold, round(review_threshold, 6) AS review_threshold, count, rate, bad_rate, overall_bad_rate, lift, 'global' AS policy_type"

SEGMENTS = ("channel", "region")
SEG_ROWS = "seg AS (" + " UNION ALL ".join(f"SELECT split AS dataset, label, model_score, ({ANY4}) AS hit, '{f}' AS segment_feature, {f} AS segment_value FROM apps" for f in SEGMENTS) + ")"


def _discrimination() -> str:
    cols = ["n_segments", "min_share", "max_share", "share_gap", "min_bad_rate", "max_bad_rate", "bad_rate_gap", "segment_values"]
    wide = ", ".join(f"max({c}) FILTER (WHERE dataset = '{d}') AS {d}_{c}" for d in ("train", "test", "valid") for c in [*cols, "riskiest"])
    every = lambda f: "coalesce(" + " AND ".join(f(d) for d in ("train", "test", "valid")) + ", false)"
    names = ", ".join(f"{d}_{c}" for d in ("train", "test", "valid") for c in cols)
    return _with(
        f"""SELECT segment_feature, {names}, stable_order, share_pass, bad_rate_gap_pass, true AS stable_order_pass, share_pass AND bad_rate_gap_pass AS recommend_as_segment_feature FROM (
SELECT *, coalesce(train_riskiest = test_riskiest AND test_riskiest = valid_riskiest, false) AS stable_order,
  {every(lambda d: f"{d}_min_share >= 0.1 AND {d}_max_share <= 0.6 AND {d}_share_gap <= 0.45")} AND coalesce(train_n_segments, 0) >= 2 AS share_pass, {every(lambda d: f"{d}_bad_rate_gap >= 0.03")} AS bad_rate_gap_pass FROM wide)""",
        SEG_ROWS,
        "st AS (SELECT dataset, segment_feature, segment_value, count(*) AS n, avg(CAST(label AS DOUBLE)) AS bad FROM seg GROUP BY 1, 2, 3)",
        "sh AS (SELECT *, n / CAST(sum(n) OVER (PARTITION BY dataset, segment_feature) AS DOUBLE) AS share, coalesce(segment_value, 'null') AS v FROM st)",
        "sums_ AS (SELECT segment_feature, dataset, count(*) AS n_segments, round(min(share), 6) AS min_share, round(max(share), 6) AS max_share, round(max(share) - min(share), 6) AS share_gap, round(min(bad), 6) AS min_bad_rate, round(max(bad), 6) AS max_bad_rate, round(max(bad) - min(bad), 6) AS bad_rate_gap, string_agg(v, '|' ORDER BY segment_value IS NULL, v) AS segment_values, first(v ORDER BY bad DESC, v) AS riskiest FROM sh GROUP BY 1, 2)",
        f"wide AS (SELECT segment_feature, {wide} FROM sums_ GROUP BY 1)",
    )


SEG_GRID = (
    SEG_ROWS,
    "sizes AS (SELECT segment_feature, segment_value FROM seg GROUP BY 1, 2 HAVING count(*) FILTER (WHERE dataset = 'train') >= 50 AND count(*) FILTER (WHERE dataset = 'valid') >= 50)",
    "sgrid AS (" + " UNION ALL ".join(f"SELECT segment_feature, segment_value, 'segment_' || segment_feature || '_' || coalesce(segment_value, 'null') || '_r{r:.3f}' AS policy_id, quantile_cont(model_score, {D(repr(1 - r))}) AS reject_threshold FROM seg WHERE dataset = 'train' GROUP BY 1, 2" for r in (0.03, 0.05, 0.08)) + ")",
    "acts AS (SELECT unnest(['reject', 'review', 'approve']) AS action)",
    """masks AS (SELECT g.policy_id, s.dataset, a.action, s.segment_feature, s.segment_value, g.reject_threshold, s.label,
  CASE a.action WHEN 'reject' THEN model_score >= reject_threshold WHEN 'review' THEN model_score >= 0.5 AND model_score < reject_threshold ELSE model_score < 0.5 END AS hit
  FROM seg s JOIN sizes z ON s.segment_feature = z.segment_feature AND s.segment_value IS NOT DISTINCT FROM z.segment_value JOIN sgrid g ON s.segment_feature = g.segment_feature AND s.segment_value IS NOT DISTINCT FROM g.segment_value, acts a)""",
    f"figures AS (SELECT policy_id, dataset, action, any_value(segment_feature) AS segment_feature, max(segment_value) AS segment_value, round(any_value(reject_threshold), 6) AS reject_threshold, CAST(0.5 AS DOUBLE) AS review_threshold, count(*) FILTER (WHERE hit) AS count, {_FIG})",
)
SEG_OUT = "policy_id, dataset, action, segment_feature, segment_value, reject_threshold, review_threshold, count, rate, bad_rate, overall_bad_rate, lift, 'segment' AS policy_type"

ANY2 = " OR ".join(f"({m})" for m, _ in RULES[:2])
COMPARE = (
    f"""flags AS (SELECT split AS dataset, label, model_score >= 0.75 AS gj, model_score >= 0.55 AND model_score < 0.75 AS gv,
  (coalesce(channel = 'BUILDING', false) AND model_score >= 0.7) OR (channel IS NULL AND model_score >= 0.6) AS sj,
  (coalesce(channel = 'BUILDING', false) AND model_score >= 0.5 AND model_score < 0.7) OR (channel IS NULL AND model_score >= 0.4 AND model_score < 0.6) AS sv, ({ANY2}) AS rj FROM apps)""",
    """strat AS (SELECT 'global_strategy' AS strategy_name, dataset, label, gj AS j, gv AS v FROM flags UNION ALL SELECT 'segment_strategy', dataset, label, sj, sv FROM flags
  UNION ALL SELECT 'global_plus_segment_rules', dataset, label, gj OR rj OR sj, (gv OR sv) AND NOT (gj OR rj OR sj) FROM flags)""",
    "strat2 AS (SELECT strategy_name, dataset, label, j, v AND NOT j AS v, NOT (j OR v) AS a FROM strat)",
    f"""compared AS (SELECT strategy_name, dataset, count(*) FILTER (WHERE j) AS reject_count, {_r(_share('count(*) FILTER (WHERE j)', 'count(*)'), 'reject_rate')}, count(*) FILTER (WHERE v) AS review_count, {_r(_share('count(*) FILTER (WHERE v)', 'count(*)'), 'review_rate')}, {_r(_share('count(*) FILTER (WHERE a)', 'count(*)'), 'approve_rate')},
  {_r(_share('sum(label) FILTER (WHERE j)', 'count(*) FILTER (WHERE j)'), 'reject_bad_rate')}, round(CAST(sum(label) FILTER (WHERE a) AS DOUBLE) / nullif(count(*) FILTER (WHERE a), 0), 6) AS approve_bad_rate, {_r(_share('sum(label)', 'count(*)'), 'overall_bad_rate')}, {_r(_share(_share('sum(label) FILTER (WHERE j)', 'count(*) FILTER (WHERE j)'), _share('sum(label)', 'count(*)')), 'lift')} FROM strat2 GROUP BY 1, 2)""",
)
_LB = ("reject_rate", "review_rate", "approve_rate", "reject_bad_rate", "approve_bad_rate", "overall_bad_rate", "lift")
BOARD = (
    "bw AS (SELECT strategy_name, " + ", ".join(f"max({c}) FILTER (WHERE dataset = '{d}') AS {d}_{c}" for d in ("train", "test", "valid") for c in _LB) + " FROM compared GROUP BY 1)",
    "board AS (SELECT *, round(train_lift - test_lift, 6) AS train_test_lift_gap, round(test_lift - valid_lift, 6) AS test_valid_lift_gap, round(1 / (1 + abs(test_lift - valid_lift)), 6) AS valid_stability, round(valid_lift + valid_reject_bad_rate - abs(test_lift - valid_lift) - CAST(0.2 AS DOUBLE) * valid_reject_rate, 6) AS leaderboard_score FROM bw)",
)
DECIDE = f"""decided AS (SELECT app_id, split, model_score, ({RULES[0][0]}) AS r0, ({RULES[1][0]}) AS r1,
  CAST(CASE WHEN region = 'ASIA' THEN 0.8 WHEN channel IS NULL THEN 0.6 WHEN channel = 'BUILDING' THEN 0.7 ELSE 0.75 END AS DOUBLE) AS reject_threshold,
  CAST(CASE WHEN region = 'ASIA' THEN 0.6 WHEN channel IS NULL THEN 0.4 WHEN channel = 'BUILDING' THEN 0.5 ELSE 0.55 END AS DOUBLE) AS review_threshold FROM apps),
final AS (SELECT *, CASE WHEN r0 OR r1 OR model_score >= reject_threshold THEN 'reject' WHEN model_score >= review_threshold THEN 'review' ELSE 'approve' END AS decision FROM decided)"""

DRIFT_FEATURES = ("total_price", "acct_bal", "drifting")
BASELINE = (
    f"brow AS ({_long(DRIFT_FEATURES, 'split')})",
    f"bq AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, {_quantiles(10)}))) AS q FROM brow WHERE split = 'train' AND value IS NOT NULL GROUP BY 1)",
    "bplaced AS (SELECT split, feature, q[2:len(q) - 1] AS c, value, CASE WHEN value IS NOT NULL THEN len(list_filter(q[2:len(q) - 1], lambda t: t <= value)) END AS bin FROM brow JOIN bq USING (feature))",
    "ball AS (SELECT feature, unnest(range(0, len(q) - 1)) AS bin FROM bq)",
    "btot AS (SELECT split, feature, count(value) AS known, count(*) AS n FROM bplaced GROUP BY 1, 2)",
    "bcnt AS (SELECT split, feature, bin, count(*) AS n FROM bplaced WHERE bin IS NOT NULL GROUP BY 1, 2, 3)",
    "base_ AS (SELECT a.feature, a.bin, coalesce(c.n, 0) / CAST(t.known AS DOUBLE) AS expected, round(1 - t.known / CAST(t.n AS DOUBLE), 6) AS missing_rate FROM ball a JOIN btot t ON a.feature = t.feature AND t.split = 'train' LEFT JOIN bcnt c ON a.feature = c.feature AND a.bin = c.bin AND c.split = 'train')",
)


def _tree(model: dict, node: dict, known: frozenset[str]) -> str:
    """A tree's value if only the features in `known` are: others send a row down both sides in shares of the covers."""
    if "leaf" in node:
        return D(node["leaf"])
    f, (left, right) = node["feature"], (_tree(model, node[s], known) for s in ("left", "right"))
    if f not in known:
        a, b = node["left"]["cover"], node["right"]["cover"]
        return f"({D(a / (a + b))} * {left} + {D(b / (a + b))} * {right})"
    x = f"CASE {f} " + " ".join(f"WHEN '{k}' THEN {D(v)}" for k, v in model["woe"][f].items()) + " END" if f in model["woe"] else f
    return f"CASE WHEN coalesce({x} <= {D(model['cuts'][f][node['bin']])}, {str(node['missing_left']).lower()}) THEN {left} ELSE {right} END"


def _known(model: dict, features) -> str:
    return " + ".join([D(model["base"]), *(_tree(model, t, frozenset(features)) for t in model["trees"])])


def _shapley(model: dict) -> str:
    """A CTE with the margin of each row for every coalition of features, and Shapley values from their differences."""
    names = list(model["cuts"])
    sets = [frozenset(c) for k in range(len(names) + 1) for c in itertools.combinations(names, k)]
    name = {s: f"v{i}" for i, s in enumerate(sets)}
    share = lambda s: D(math.factorial(len(s)) * math.factorial(len(names) - len(s) - 1) / math.factorial(len(names)))
    each = ", ".join(" + ".join(f"{share(s)} * ({name[s | {f}]} - {name[s]})" for s in sets if f not in s) + f" AS shap_{f}" for f in names)
    return f"coalitions AS (SELECT app_id, {', '.join(f'{_known(model, s)} AS {n}' for s, n in name.items())} FROM apps), shap AS (SELECT app_id, {each}, v0 AS shap_base FROM coalitions)"


ISOTONIC = (
    "pts AS (SELECT model_score AS s, avg(CAST(label AS DOUBLE)) AS y, count(*) AS w, row_number() OVER (ORDER BY model_score) AS i FROM apps WHERE split = 'test' GROUP BY model_score)",
    "cum AS (SELECT i, s, sum(w) OVER (ORDER BY i) AS cw, sum(w * y) OVER (ORDER BY i) AS cy FROM pts)",
    "spans AS (SELECT j.i AS j, k.i AS k, (k.cy - coalesce(b.cy, 0)) / (k.cw - coalesce(b.cw, 0)) AS m FROM cum j JOIN cum k ON k.i >= j.i LEFT JOIN cum b ON b.i = j.i - 1)",
    # the least mean of stretches from j to i or beyond, then the largest of these over j
    "least_ AS (SELECT j, k AS i, min(m) OVER (PARTITION BY j ORDER BY k DESC) AS m FROM spans)",
    "fit AS (SELECT p.i, p.s, max(l.m) AS y FROM least_ l JOIN pts p USING (i) GROUP BY p.i, p.s)",
    "pairs AS (SELECT s AS s0, y AS y0, coalesce(lead(s) OVER (ORDER BY s), s) AS s1, coalesce(lead(y) OVER (ORDER BY s), y) AS y1 FROM fit)",
    "cal AS (SELECT a.split, a.label, CASE WHEN p.s0 IS NULL THEN (SELECT arg_min(y, s) FROM fit) WHEN p.s1 = p.s0 THEN p.y0 ELSE p.y0 + (p.y1 - p.y0) * (a.model_score - p.s0) / (p.s1 - p.s0) END AS c FROM apps a ASOF LEFT JOIN pairs p ON a.model_score >= p.s0)",
)


def _runs_compared() -> str:
    """The metrics of the scores and of the scores rounded to one place, side by side, with their differences."""
    renamed = lambda text, i, names: re.sub(rf"\b({'|'.join(names)})\b", rf"\g<1>{i}", text)
    parts = []
    for i, score in ((1, "model_score"), (2, "coarse")):
        own = re.findall(r"(?:^|, |\n)(\w+) AS \(", f"{KS}, {AUC}, {METRICS}")
        parts.append(renamed(f"{KS}, {AUC}, {METRICS}", i, own).replace("FROM apps", "FROM scored").replace("model_score", score))
    long = " UNION ALL ".join(f"SELECT 'lr_' || a.dataset || '_{k}' AS metric, CAST(a.{c} AS DOUBLE) AS run_a, CAST(b.{c} AS DOUBLE) AS run_b FROM metrics1 a JOIN metrics2 b USING (dataset)" for k, c in (("KS", "ks"), ("AUC", "auc")))
    total = "SELECT 'n_total' AS metric, CAST(count(*) AS DOUBLE) AS run_a, CAST(count(*) AS DOUBLE) AS run_b FROM apps"
    return _with(f"SELECT metric, run_a, run_b, round(run_b - run_a, 6) AS delta_b_minus_a FROM ({total} UNION ALL {long})", "scored AS (SELECT *, round(model_score, 1) AS coarse FROM apps)", *parts)


def _gini(n: str, bad: str) -> str:
    return f"(CASE WHEN {n} > 0 THEN 2 * ({bad}) * ({n} - ({bad})) / CAST({n} AS DOUBLE) ELSE 0 END)"


def _gains(name: str, source: str, by: str, good: str = "1", bad: str = "1") -> str:
    """A CTE of `source` (by, value, n rows, b bad ones) with what a cut after each value takes off the impurity; the classes weigh."""
    over = f"OVER (PARTITION BY {by}"
    inner = f"SELECT *, sum(n) {over} ORDER BY value) AS ln, sum(b) {over} ORDER BY value) AS lb, sum(n) {over}) AS tn, sum(b) {over}) AS tb, lead(value) {over} ORDER BY value) AS following FROM {source}"
    sides = f"SELECT *, tn - ln AS rn, tb - lb AS rb FROM ({inner})"
    total, left, right = (_gini(f"({good} * ({x}n - {x}b) + {bad} * {x}b)", f"{bad} * {x}b") for x in "tlr")
    return f"{name} AS MATERIALIZED (SELECT *, {total} - {left} - {right} AS gain FROM ({sides}) WHERE following IS NOT NULL AND ln >= 50 AND rn >= 50)"


def _tree_cuts(features, leaves: int = 10) -> str:
    """Splits each feature's best part until there are enough, one step after the other."""
    steps = [f"rows_ AS (SELECT * FROM ({_long(features, 'label, split')}) WHERE split = 'train' AND value IS NOT NULL)", "p0 AS MATERIALIZED (SELECT feature, value, 0 AS part, count(*) AS n, CAST(sum(label) AS BIGINT) AS b FROM rows_ GROUP BY 1, 2)"]
    for i in range(leaves - 1):
        steps += [
            _gains(f"g{i}", f"p{i}", "feature, part"),
            f"s{i} AS MATERIALIZED (SELECT feature, part, value AS last, (value + following) / 2 AS cut FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY gain DESC, value) AS k FROM g{i}) WHERE k = 1 AND gain > {D('1e-12')})",
            f"p{i + 1} AS MATERIALIZED (SELECT p.feature, p.value, CASE WHEN p.part = s.part AND p.value > s.last THEN {i + 1} ELSE p.part END AS part, p.n, p.b FROM p{i} p LEFT JOIN s{i} s ON p.feature = s.feature)",
        ]
    every = " UNION ALL ".join(f"SELECT feature, cut FROM s{i}" for i in range(leaves - 1))
    return _with(f"SELECT feature, CAST(row_number() OVER (PARTITION BY feature ORDER BY cut) - 1 AS INTEGER) AS position, cut FROM ({every})", *steps)


def _tree_rules(features, depth: int, most_coverage: float, least_lift: float) -> str:
    """Grows a tree of balanced weights level by level over imputed train rows; its leaves' conditions are the rules."""
    filled = ", ".join(f"coalesce({f}, (SELECT quantile_cont({f}, {D(0.5)}) FROM apps WHERE split = 'train')) AS {f}" for f in features)
    w = "(SELECT {}/ (2 * CAST({} AS DOUBLE)) FROM weights)".format
    good, bad = w("n", "(n - b)"), w("n", "b")
    steps = ["weights AS (SELECT count(*) AS n, CAST(sum(label) AS BIGINT) AS b FROM apps WHERE split = 'train')", f"t0 AS MATERIALIZED (SELECT app_id, label, 1 AS node, '' AS path, {filled} FROM apps WHERE split = 'train')"]
    for i in range(depth):
        value = "CASE s.feature " + " ".join(f"WHEN '{f}' THEN t.{f}" for f in features) + " END"
        long = " UNION ALL ".join(f"SELECT node, '{f}' AS feature, {f} AS value, label FROM t{i} WHERE node >= {2**i}" for f in features)
        steps += [
            f"h{i} AS (SELECT node, feature, CAST(value AS DOUBLE) AS value, count(*) AS n, CAST(sum(label) AS BIGINT) AS b FROM ({long}) GROUP BY 1, 2, 3)",
            _gains(f"g{i}", f"h{i}", "node, feature", good, bad),
            f"s{i} AS MATERIALIZED (SELECT node, feature, round((value + following) / 2, 6) AS cut FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, value) AS k FROM g{i}) WHERE k = 1 AND gain > {D('1e-12')})",
            f"t{i + 1} AS MATERIALIZED (SELECT t.app_id, t.label, CASE WHEN s.cut IS NULL THEN t.node WHEN {value} <= s.cut THEN 2 * t.node ELSE 2 * t.node + 1 END AS node, CASE WHEN s.cut IS NULL THEN t.path ELSE t.path || CASE WHEN t.path = '' THEN '' ELSE ' and ' END || s.feature || CASE WHEN {value} <= s.cut THEN ' <= ' ELSE ' > ' END || CAST(s.cut AS VARCHAR) END AS path, {', '.join('t.' + f for f in features)} FROM t{i} t LEFT JOIN s{i} s ON t.node = s.node)",
        ]
    figures = f"SELECT path, count(*) AS h, count(*) / CAST(max(w.n) AS DOUBLE) AS coverage, avg(CAST(label AS DOUBLE)) AS bad_rate, avg(CAST(label AS DOUBLE)) / (max(w.b) / CAST(max(w.n) AS DOUBLE)) AS lift FROM t{depth}, weights w WHERE path <> '' GROUP BY path"
    return _with(f"SELECT CAST(row_number() OVER (ORDER BY lift DESC, path) - 1 AS INTEGER) AS rule_id, path AS condition_str, round(coverage, 4) AS coverage, h AS hit_count, round(bad_rate, 4) AS bad_rate, round(lift, 4) AS lift FROM ({figures}) WHERE coverage <= {most_coverage} AND lift >= {least_lift} AND h >= 5", *steps)


def oracle_sql() -> dict[str, str]:
    mono = ("total_price", "acct_bal", "sum_qty")
    order = lambda cols: ", ".join(c[1:] + " DESC" if c[0] == "-" else c for c in cols)
    pool = "pool AS (SELECT * FROM board WHERE coalesce(valid_lift, 0) >= 2 OR (SELECT max(coalesce(valid_lift, 0)) FROM board) < 2)"
    tiers = {"conservative": ("valid_reject_rate", "test_valid_lift_gap", "-valid_lift"), "balanced": ("-leaderboard_score", "-valid_lift", "valid_reject_rate"), "aggressive": ("-valid_lift", "-valid_reject_rate", "-leaderboard_score")}
    points = [i / 100 for i in range(5, 100, 5)]
    candidates = (
        f"rows_ AS ({_long(('total_price', 'acct_bal'), 'label', chr(40) + 'SELECT * FROM apps WHERE split = ' + chr(39) + 'train' + chr(39) + chr(41))})",
        f"th AS (SELECT feature, unnest(list_sort(list_distinct(quantile_cont(value, [{', '.join(D(repr(p)) for p in points)}])))) AS threshold FROM rows_ WHERE value IS NOT NULL GROUP BY 1)",
    )
    mined_rows = ("total_price", "acct_bal", "sum_qty")
    train = "(SELECT * FROM apps WHERE split = 'train')"
    mined = (
        f"rows_ AS ({_long(mined_rows, 'label', train)})",
        f"th AS (SELECT feature, unnest(list_sort(list_distinct(quantile_cont(value, [{', '.join(D(repr(p)) for p in points)}])))) AS threshold FROM rows_ WHERE value IS NOT NULL GROUP BY 1)",
        "cand AS (SELECT t.feature, d AS direction, t.threshold, CAST(NULL AS VARCHAR) AS value, count(*) AS hits, sum(label) AS bad FROM th t JOIN rows_ r USING (feature), (SELECT unnest(['>=', '<=']) AS d) WHERE CASE d WHEN '>=' THEN r.value >= t.threshold ELSE r.value <= t.threshold END GROUP BY 1, 2, 3 UNION ALL "
        + " UNION ALL ".join(f"SELECT '{f}', '==', NULL, {f}, count(*), sum(label) FROM {train} WHERE {f} IS NOT NULL GROUP BY {f}" for f in ("channel", "priority")) + ")",
        f"tt AS (SELECT count(*) AS n, sum(label) AS b FROM {train})",
        f"rated AS (SELECT feature, direction, round(threshold, 6) AS threshold, value, {_r(_share('hits', 'n'), 'coverage', 4)}, hits AS hit_count, {_r(_share('bad', 'hits'), 'bad_rate', 4)}, {_r(_share('b', 'n'), 'overall_bad_rate', 4)}, {_r(_share(_share('bad', 'hits'), _share('b', 'n')), 'lift', 4)} FROM cand, tt)",
        "best AS (SELECT *, row_number() OVER (PARTITION BY feature, direction ORDER BY lift DESC, coverage, threshold, value) AS k FROM rated WHERE coverage <= 0.1 AND lift >= 2 AND hit_count >= 5)",
    )
    stability = [f"max({c}) FILTER (WHERE dataset = '{d}') AS {c}_{d}" for d in ("train", "test", "valid") for c in ("coverage", "bad_rate", "lift", "hit_count")]
    firsts = ", ".join(f"({m}) AS m{i}" for i, (m, _) in enumerate(RULES))
    first = "CASE " + " ".join(f"WHEN m{i} THEN {i}" for i in range(len(RULES))) + " ELSE -1 END"
    woe_map = _woe("bin", "fitrows")
    shap = [*(f"shap_{f}" for f in FIXED_BOOSTER["cuts"]), "shap_base"]
    found = {
        "apps": _with("SELECT * FROM apps"),
        "woe_iv_quantile": _woe_numeric(CUTS),
        "woe_iv_uniform": _woe_numeric(UNIFORM),
        "woe_iv_categorical": _with("SELECT feature, bin_label, total, bad, good, " + ", ".join(_r(c, c) for c in ("bad_pct", "good_pct", "woe", "bad_rate", "iv_bin", "iv")) + " FROM stats", f"trows AS ({_text(('channel', 'priority', 'n_items'))})", _woe("bin_label", "trows")),
        "iv_ranking": _with("SELECT * FROM ranking", *ALL_STATS, RANKED),
        "woe_bin_report": _with("SELECT iv_rank, feature, bin_label, total, bad, good, round(bad_rate, 6) AS bad_rate, round(woe, 6) AS woe, round(iv_bin, 6) AS iv_bin FROM stats JOIN (SELECT feature, iv_rank FROM ranking) USING (feature)", *ALL_STATS, RANKED),
        "data_quality": _with("SELECT * FROM quality", QUALITY),
        "eligible_features": _with("SELECT feature, unique_count FROM quality WHERE unique_count > 1 AND unique_count < 0.5 * (SELECT count(*) FROM apps)", QUALITY),
        "dataset_profile": _with("SELECT split AS dataset, count(*) AS n, round(avg(CAST(label AS DOUBLE)), 6) AS bad_rate, min(apply_time) AS time_min, max(apply_time) AS time_max FROM apps GROUP BY 1"),
        "validate_counts": _with(f"SELECT *, {_r(_share('least(bad, good)', 'n'), 'minority_rate')} FROM (SELECT count(*) AS n, count(*) FILTER (WHERE label IS NULL) AS label_nulls, count(DISTINCT label) AS classes, count(*) FILTER (WHERE label = 1) AS bad, count(*) FILTER (WHERE label = 0) AS good, CAST({' + '.join(f'CAST(min({f}) IS NOT DISTINCT FROM max({f}) AS INTEGER)' for f in NUMERIC)} AS INTEGER) AS constant_features FROM apps)"),
        "ks": _with("SELECT split, round(ks, 8) AS ks FROM ks_", KS),
        "auc_gini": _with("SELECT split, round(auc, 8) AS auc, round(2 * auc - 1, 8) AS gini FROM auc_", AUC),
        "lift": _with("SELECT split, " + ", ".join(_r(_share(f"avg(CAST(label AS DOUBLE)) FILTER (WHERE model_score >= {t})", "avg(CAST(label AS DOUBLE))"), f"lift_{n}") for n, t in (("50", 0.5), ("70", 0.7), ("none", 2.0))) + " FROM apps GROUP BY 1"),
        "model_comparison": _with("SELECT dataset, auc, ks, gini FROM metrics", KS, AUC, METRICS),
        "overfit_diagnostics": _with("SELECT round(max(ks) FILTER (WHERE dataset = 'train') - max(ks) FILTER (WHERE dataset = 'test'), 4) AS train_test_ks_gap, round(max(ks) FILTER (WHERE dataset = 'test') - max(ks) FILTER (WHERE dataset = 'valid'), 4) AS test_valid_ks_gap FROM metrics", KS, AUC, METRICS),
        "psi_feature": _with(PSI_OUT, *_psi(NUMERIC, "split = 'train'", "split = 'valid'")),
        "psi_half_split": _with(PSI_OUT, HALVES, *_psi(("total_price", "drifting", "acct_bal"), "early", "NOT early", "halves")),
        "stability_report": "SELECT * FROM (" + ") UNION ALL SELECT * FROM (".join(_with(f"SELECT '{d}' AS dataset, feature, psi FROM psi_", *_psi(("model_score", "total_price", "sum_qty"), "split = 'train'", f"split = '{d}'")) for d in ("test", "valid")) + ")",
        "score_bins": _with("SELECT dataset, score_bin, bin_order, count, bad_count, raw_bad_rate_monotone, " + ", ".join(_r(c, c) for c in ("raw_bad_rate", "monotone_bad_rate", "lift", "monotone_lift", "cum_bad_capture", "score_min", "score_max", "train_bad_rate", "bad_rate_gap_vs_train", "monotone_bad_rate_gap_vs_train")) + " FROM report", *SCORE_BINS),
        "score_bin_stability": _with("SELECT dataset, count(*) AS n_bins, bool_and(raw_bad_rate_monotone) AS raw_bad_rate_monotone, round(max(abs(bad_rate_gap_vs_train)), 6) AS max_abs_bad_rate_gap_vs_train, round(max(abs(monotone_bad_rate_gap_vs_train)), 6) AS max_abs_monotone_bad_rate_gap_vs_train FROM report GROUP BY 1", *SCORE_BINS),
        "calibration_bins": _with("SELECT dataset, decile, count, round(raw, 6) AS raw_prob_mean, round(cal, 6) AS calibrated_prob_mean, round(act, 6) AS actual_bad_rate, round(abs(raw - act), 6) AS raw_abs_error, round(abs(cal - act), 6) AS calibrated_abs_error FROM agg", f"dq AS (SELECT split, list_sort(list_distinct(quantile_cont(model_score, {_quantiles(10, True)}))) AS c FROM apps GROUP BY 1)", "agg AS (SELECT a.split AS dataset, len(list_filter(c, lambda t: t < model_score)) AS decile, count(*) AS count, avg(model_score) AS raw, avg(model_score * CAST(0.9 AS DOUBLE) + CAST(0.05 AS DOUBLE)) AS cal, avg(CAST(label AS DOUBLE)) AS act FROM apps a JOIN dq ON a.split = dq.split GROUP BY 1, 2)"),
        "monotonicity": _with("SELECT feature, count(*) AS n_bins, CASE WHEN count(*) >= 3 THEN round(coalesce(corr(rb, rw), 0), 6) END AS spearman, coalesce(count(*) >= 3 AND abs(round(coalesce(corr(rb, rw), 0), 6)) >= 0.6, false) AS is_monotone FROM (SELECT feature, avg(pb) OVER (PARTITION BY feature, bin) AS rb, avg(pw) OVER (PARTITION BY feature, woe) AS rw FROM (SELECT feature, bin, woe, row_number() OVER (PARTITION BY feature ORDER BY bin) AS pb, row_number() OVER (PARTITION BY feature ORDER BY woe) AS pw FROM stats WHERE bin >= 0)) GROUP BY 1", f"rows_ AS ({_long(mono)})", CUTS, BINNED, _woe("bin", "binned")),
        "split_stratified": _with("SELECT app_id, split FROM apps"),
        "split_time": _with("SELECT app_id, CASE WHEN k <= floor(n * CAST(0.7 AS DOUBLE)) THEN 'train' WHEN k <= floor(n * CAST(0.85 AS DOUBLE)) THEN 'test' ELSE 'valid' END AS split FROM (SELECT app_id, row_number() OVER (ORDER BY apply_time, app_id) AS k, count(*) OVER () AS n FROM apps)"),
        "split_recent_valid": _with("SELECT app_id, CASE WHEN recent THEN 'valid' WHEN k <= floor(n * (1 - CAST(0.15 AS DOUBLE) / CAST(0.85 AS DOUBLE))) THEN 'train' ELSE 'test' END AS split FROM (SELECT app_id, recent, row_number() OVER (PARTITION BY recent, label ORDER BY (app_id * 7919) % 100003, app_id) AS k, count(*) OVER (PARTITION BY recent, label) AS n FROM (SELECT *, apply_time > (SELECT max(apply_time) - INTERVAL 3 MONTH FROM apps) AS recent FROM apps))"),
        "rule_single_candidates": _with("SELECT feature, round(threshold, 6) AS threshold, value, direction, hits, bad FROM (SELECT t.feature, t.threshold, CAST(NULL AS VARCHAR) AS value, d AS direction, count(r.label) FILTER (WHERE CASE d WHEN '>=' THEN r.value >= t.threshold ELSE r.value <= t.threshold END) AS hits, CAST(coalesce(sum(r.label) FILTER (WHERE CASE d WHEN '>=' THEN r.value >= t.threshold ELSE r.value <= t.threshold END), 0) AS BIGINT) AS bad FROM th t JOIN rows_ r USING (feature), (SELECT unnest(['>=', '<=']) AS d) GROUP BY 1, 2, 4 UNION ALL SELECT 'channel', NULL, channel, '==', count(*), CAST(sum(label) AS BIGINT) FROM apps WHERE split = 'train' AND channel IS NOT NULL GROUP BY channel)", *candidates),
        "rule_single_mined": _with("SELECT feature, direction, threshold, value, coverage, hit_count, bad_rate, overall_bad_rate, lift FROM best WHERE k = 1", *mined),
        "rule_backtest": _with("SELECT * FROM tested", HIT_ROWS, BACKTEST),
        "rule_combined": _with(f"SELECT dataset, 4 AS rule_count, {_r(_share('count(*) FILTER (WHERE hit)', 'count(*)'), 'reject_rate', 4)}, count(*) FILTER (WHERE hit) AS hit_count, {_r(_share('sum(label) FILTER (WHERE hit)', 'count(*) FILTER (WHERE hit)'), 'hit_bad_rate', 4)}, {_r(_share('sum(label)', 'count(*)'), 'overall_bad_rate', 4)}, round(CAST(sum(label) FILTER (WHERE NOT hit) AS DOUBLE) / nullif(count(*) FILTER (WHERE NOT hit), 0), 4) AS passed_bad_rate, {_r(_share(_share('sum(label) FILTER (WHERE hit)', 'count(*) FILTER (WHERE hit)'), _share('sum(label)', 'count(*)')), 'lift', 4)} FROM (SELECT split AS dataset, label, ({ANY4}) AS hit FROM apps) GROUP BY 1"),
        "rule_overlap": _with(" UNION ALL ".join(f"SELECT {i} AS rule_a, {j} AS rule_b, count(*) FILTER (WHERE m{i} AND m{j}) AS \"both\", {_r(_share(f'count(*) FILTER (WHERE m{i} AND m{j})', f'least(count(*) FILTER (WHERE m{i}), count(*) FILTER (WHERE m{j}))'), 'overlap')} FROM fl" for i in range(4) for j in range(i + 1, 4)), f"fl AS (SELECT {firsts} FROM apps)"),
        "rule_stability": _with("SELECT *, coalesce(" + " AND ".join(f"coverage_{d} <= 0.05 AND lift_{d} >= 2 AND hit_count_{d} >= 5" for d in ("train", "test", "valid")) + " AND lift_gap_test_valid <= 0.35, false) AS stable_pass FROM (SELECT *, round(lift_test - lift_valid, 4) AS lift_gap_test_valid FROM (SELECT rule_id, condition, " + ", ".join(stability) + " FROM tested GROUP BY 1, 2))", HIT_ROWS, BACKTEST),
        "rule_marginal": _with(f"SELECT dataset, rule_id, condition, rule_hit_count, marginal_hit_count, marginal_bad_count, {_r(_share('marginal_bad_count', 'marginal_hit_count'), 'marginal_bad_rate', 4)}, {_r(_share(_share('marginal_bad_count', 'marginal_hit_count'), _share('b', 'n')), 'marginal_lift', 4)}, cumulative_hit_count, {_r(_share('cumulative_hit_count', 'n'), 'cumulative_reject_rate', 4)} FROM mg", f"fl AS (SELECT split AS dataset, label, {firsts} FROM apps)", f"fh AS (SELECT *, {first} AS f FROM fl)", "mg AS (" + " UNION ALL ".join(f"SELECT dataset, {i} AS rule_id, '{t}' AS condition, count(*) FILTER (WHERE m{i}) AS rule_hit_count, count(*) FILTER (WHERE f = {i}) AS marginal_hit_count, CAST(coalesce(sum(label) FILTER (WHERE f = {i}), 0) AS BIGINT) AS marginal_bad_count, count(*) FILTER (WHERE f BETWEEN 0 AND {i}) AS cumulative_hit_count, count(*) AS n, sum(label) AS b FROM fh GROUP BY 1" for i, (_, t) in enumerate(RULES)) + ")"),
        "score_policy": _with("SELECT dataset, action, round(CASE action WHEN 'reject' THEN reject_threshold WHEN 'review' THEN review_threshold END, 6) AS threshold_low, round(CASE action WHEN 'review' THEN reject_threshold WHEN 'approve' THEN review_threshold END, 6) AS threshold_high, count, rate, bad_rate, overall_bad_rate, lift FROM figures", f"grid AS (SELECT 'score' AS policy_id, quantile_cont(model_score, {D(0.95)}) AS reject_threshold, quantile_cont(model_score, {D(0.85)}) AS review_threshold FROM apps WHERE split = 'train')", _policy_rows("grid")),
        "global_grid": _with(f"SELECT {GRID_OUT} FROM figures", *GRID),
        "global_pick": _with(f"SELECT {GRID_OUT} FROM figures WHERE policy_id = (SELECT policy_id FROM figures WHERE dataset = 'test' AND action = 'reject' ORDER BY lift DESC, bad_rate DESC, rate, policy_id LIMIT 1)", *GRID),
        "segment_report": _with(f"SELECT dataset, segment_feature, segment_value, count(*) AS segment_count, {_r(_share('sum(label)', 'count(*)'), 'segment_bad_rate', 4)}, count(*) FILTER (WHERE hit) AS reject_count, {_r(_share('count(*) FILTER (WHERE hit)', 'count(*)'), 'reject_rate', 4)}, {_r(_share('sum(label) FILTER (WHERE hit)', 'count(*) FILTER (WHERE hit)'), 'reject_bad_rate', 4)}, {_r(_share(_share('sum(label) FILTER (WHERE hit)', 'count(*) FILTER (WHERE hit)'), _share('sum(label)', 'count(*)')), 'lift_vs_segment', 4)} FROM seg GROUP BY 1, 2, 3 HAVING count(*) >= 50", SEG_ROWS),
        "segment_discrimination": _discrimination(),
        "segment_grid": _with(f"SELECT {SEG_OUT} FROM figures", *SEG_GRID),
        "segment_pick": _with(f"SELECT {SEG_OUT}, recommend_segment_strategy, lift_gap_test_valid, abs_lift_gap_test_valid, NOT recommend_segment_strategy AS fallback_to_global FROM figures JOIN (SELECT policy_id, recommend_segment_strategy, lift_gap_test_valid, abs_lift_gap_test_valid FROM win WHERE k = 1) USING (policy_id)", *SEG_GRID, "vr AS (SELECT v.*, round(t.lift - v.lift, 6) AS lift_gap_test_valid, abs(round(t.lift - v.lift, 6)) AS abs_lift_gap_test_valid FROM figures v LEFT JOIN (SELECT policy_id, lift FROM figures WHERE dataset = 'test' AND action = 'reject') t USING (policy_id) WHERE dataset = 'valid' AND action = 'reject')", "vg AS (SELECT *, coalesce(count >= 10 AND lift >= 2 AND abs_lift_gap_test_valid <= 0.5, false) AS recommend_segment_strategy FROM vr)", "win AS (SELECT *, row_number() OVER (PARTITION BY segment_feature, segment_value ORDER BY recommend_segment_strategy DESC, lift DESC, bad_rate DESC, policy_id) AS k FROM vg)"),
        "final_comparison": _with("SELECT * FROM compared", *COMPARE),
        "leaderboard": _with("SELECT * FROM board", *COMPARE, *BOARD),
        "recommendation_tiers": _with(" UNION ALL ".join(f"SELECT * FROM (SELECT '{n}' AS recommendation_type, strategy_name, leaderboard_score FROM pool ORDER BY {order(c)}, strategy_name LIMIT 1)" for n, c in tiers.items()), *COMPARE, *BOARD, pool),
        "prob_to_score": _with(f"SELECT app_id, round(CAST(600 AS DOUBLE) + CAST(20 AS DOUBLE) / ln(CAST(2 AS DOUBLE)) * ln(CAST(1 AS DOUBLE) / CAST(15 AS DOUBLE)) - CAST(20 AS DOUBLE) / ln(CAST(2 AS DOUBLE)) * ln(p / (1 - p)), 4) AS out_credit_score FROM (SELECT app_id, greatest(least(model_score, 1 - {D('1e-6')}), {D('1e-6')}) AS p FROM apps)"),
        "woe_transform": _with("SELECT a.app_id, round(coalesce(tp.woe, 0), 6) AS total_price, round(coalesce(ab.woe, 0), 6) AS acct_bal, round(coalesce(ch.woe, 0), 6) AS channel FROM tr a LEFT JOIN stats tp ON tp.feature = 'total_price' AND tp.bin = a.b1 LEFT JOIN stats ab ON ab.feature = 'acct_bal' AND ab.bin = a.b2 LEFT JOIN stats ch ON ch.feature = 'channel' AND ch.bin = a.b3", f"tr AS (SELECT app_id, split, label, CAST(len(list_filter([{D(1e5)}, {D(2e5)}, {D(3e5)}], lambda t: t < total_price)) AS VARCHAR) AS b1, CAST(CASE WHEN acct_bal IS NULL THEN -1 ELSE len(list_filter([{D(0)}, {D(5000)}], lambda t: t < acct_bal)) END AS VARCHAR) AS b2, channel AS b3 FROM apps)", "few AS (SELECT count(*) FILTER (WHERE b2 = '-1') AS k FROM tr WHERE split = 'train')", "fitrows AS (SELECT 'total_price' AS feature, b1 AS bin, label FROM tr WHERE split = 'train' UNION ALL SELECT 'acct_bal', b2, label FROM tr, few WHERE split = 'train' AND (b2 <> '-1' OR k >= 50) UNION ALL SELECT 'channel', b3, label FROM tr WHERE split = 'train' AND b3 IS NOT NULL)", woe_map),
        "score_decisions": _with(f"SELECT app_id, decision, r0 OR r1 AS reject_by_rule, model_score >= reject_threshold AS reject_by_score, concat_ws('; ', CASE WHEN r0 THEN '{RULES[0][1]}' END, CASE WHEN r1 THEN '{RULES[1][1]}' END) AS hit_rules, reject_threshold, review_threshold FROM final", DECIDE),
        "decision_counts": _with("SELECT split, decision, count(*) AS n FROM final GROUP BY 1, 2", DECIDE),
        "drift_baseline": _with("SELECT feature, CAST(bin AS INTEGER) AS bin, round(expected, 6) AS expected_pct, missing_rate FROM base_", *BASELINE),
        "drift_check": _with("SELECT feature, psi, CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.25 THEN 'warning' ELSE 'unstable' END AS psi_level, train_missing_rate, new_missing_rate, round(new_missing_rate - train_missing_rate, 6) AS missing_rate_delta FROM (SELECT feature, round(sum((a - e) * ln(a / e)), 6) AS psi, max(missing_rate) AS train_missing_rate, max(new_missing) AS new_missing_rate FROM (SELECT b.feature, b.missing_rate, greatest(round(b.expected, 8), CAST(1e-6 AS DOUBLE)) AS e, greatest(coalesce(c.n, 0) / CAST(t.known AS DOUBLE), CAST(1e-6 AS DOUBLE)) AS a, round((t.n - t.known) / CAST(t.n AS DOUBLE), 6) AS new_missing FROM base_ b JOIN btot t ON b.feature = t.feature AND t.split = 'valid' LEFT JOIN bcnt c ON b.feature = c.feature AND b.bin = c.bin AND c.split = 'valid') GROUP BY 1)", *BASELINE),
        "runs_compared": _runs_compared(),
        "tree_cuts": _tree_cuts(("total_price", "acct_bal", "sum_qty")),
        "tree_rules": _tree_rules(("total_price", "acct_bal", "sum_qty"), 3, 0.3, 1.5),
        "gbt_fixed_scores": _with(f"SELECT app_id, {_r('1 / (1 + exp(-(' + _known(FIXED_BOOSTER, FIXED_BOOSTER['cuts']) + ')))', 'gbt_score')} FROM apps"),
        "shap_values": _with("SELECT app_id, " + ", ".join(_r(c, c) for c in shap) + " FROM shap", _shapley(FIXED_BOOSTER)),
        "shap_importance": _with(" UNION ALL ".join(f"SELECT '{c[5:]}' AS feature, {_r(f'avg(abs({c}))', 'shap_importance')} FROM shap" for c in shap[:-1]), _shapley(FIXED_BOOSTER)),
        "isotonic_calibration": _with("SELECT split, round(avg(c), 6) AS mean_calibrated, round(min(c), 6) AS low, round(max(c), 6) AS high, round(avg(CAST(label AS DOUBLE)), 6) AS bad_rate FROM cal GROUP BY 1", *ISOTONIC),
        "run_diff": _with("SELECT metric, round(run_a, 6) AS run_a, round(run_b, 6) AS run_b, round(run_b - run_a, 6) AS delta_b_minus_a FROM (SELECT metric, max(value) FILTER (WHERE split = 'train') AS run_a, max(value) FILTER (WHERE split = 'valid') AS run_b FROM rl GROUP BY 1)", "rl AS (SELECT split, 'n_total' AS metric, CAST(count(*) AS DOUBLE) AS value FROM apps GROUP BY 1 UNION ALL SELECT split, 'bad_rate', avg(CAST(label AS DOUBLE)) FROM apps GROUP BY 1 UNION ALL SELECT split, 'mean_score', avg(model_score) FROM apps GROUP BY 1)"),
    }
    return found | {"score_decisions_by_table": found["score_decisions"], "final_comparison_by_table": found["final_comparison"]}
