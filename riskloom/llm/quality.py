"""Text quality by a sparse rule ensemble.

Statistics of whole texts feed small boosted trees; each path from a tree's root becomes a rule, a
conjunction of comparisons. A lasso logistic fit keeps few rules, and the kept ones are compiled to
one Spark column over the statistics. Trees and weights are fitted on the driver from at most
MOST_LABELLED labelled rows, picked by a hash of their ids; scoring is a projection.

Null and empty texts have statistics of 0 and are scored like others. Rows without a label, or with
a null one, aren't learnt from; with one class only, or none, the score is the share of label 1
(1/2 without labels). Repeated rows repeat; kept columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.storage import carried, made, spread, table, text_slices
from riskloom.llm.textkernel import lower_table, texts_of, words_of

#: Labelled rows that a fit uses at most.
MOST_LABELLED = 20_000
TREES, DEPTH, LEAF, BINS, STEP = 40, 3, 20, 32, 0.3
#: Weight of the lasso, and its iterations.
LASSO, ROUNDS = 0.0005, 600
THRESHOLD = 0.7

STATISTICS = (
    "bytes", "words", "lines", "word_bytes", "line_words", "upper", "digit", "symbol", "pipe", "stop", "shout", "comma", "high", "blank",
    "distinct", "top", "again", "line_again", "marked_word", "short_word", "long_word", "lone_line",
)

_SETS = {
    "upper": range(0x41, 0x5B), "letter": [*range(0x41, 0x5B), *range(0x61, 0x7B)], "digit": range(0x30, 0x3A), "symbol": b"#$%&*@^~+=<>\\_{}[]", "pipe": b"|",
    "stop": b".?", "shout": b"!", "comma": b",;:", "high": range(0x80, 0xC0), "blank": b" \t\r\v\f", "line": b"\n",
}


def statistics_of(column: pa.Array) -> np.ndarray:
    """One row of STATISTICS for each text."""
    raw, at = texts_of(column)
    n = len(at) - 1
    size = np.diff(at)

    def count(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return (sums[at[1:]] - sums[at[:-1]]).astype(np.float64)

    found = {}
    for name, members in _SETS.items():
        flag = np.zeros(256, bool)
        flag[list(members)] = True
        found[name] = count(flag[raw])
    over = lambda a, b: np.divide(a, b, out=np.zeros(n), where=np.asarray(b) > 0)
    w = words_of(raw, at, lower_table())
    words = np.bincount(w.doc, minlength=n).astype(np.float64)
    tally = lambda flags: np.bincount(w.doc[flags], minlength=n).astype(np.float64)
    length = w.end - w.start
    order = np.lexsort((w.hash, w.doc))
    d, h = w.doc[order], w.hash[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    runs = np.diff(np.append(np.flatnonzero(new), len(d)))
    top = np.zeros(n)
    np.maximum.at(top, d[new], runs)
    same = np.zeros(len(w.doc), bool)
    same[1:] = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    last = raw[w.end - 1] if len(w.end) else np.zeros(0, np.uint8)
    sign = np.zeros(256, bool)
    sign[list(b"#$%&*@^~+=!|")] = True
    lines_table = np.arange(256, dtype=np.uint16)
    lines_table[0], lines_table[10] = 256, 0
    rows = words_of(raw, at, lines_table)
    lines = np.bincount(rows.doc, minlength=n).astype(np.float64)
    o = np.lexsort((rows.hash, rows.doc))
    ld, lh = rows.doc[o], rows.hash[o]
    twice = np.zeros(len(ld), bool)
    twice[1:] = (ld[1:] == ld[:-1]) & (lh[1:] == lh[:-1])
    in_line = np.diff(np.searchsorted(w.start, np.append(rows.start, len(raw)))) if len(rows.start) else np.zeros(0)
    values = {
        "bytes": size, "words": words, "lines": lines, "word_bytes": over(np.bincount(w.doc, length, n), words), "line_words": over(words, lines),
        "upper": over(found["upper"], found["letter"]), **{k: over(found[k], size) for k in ("digit", "symbol", "pipe", "stop", "shout", "comma", "high", "blank")},
        "distinct": over(tally_new := np.bincount(d[new], minlength=n).astype(np.float64), words), "top": over(top, words), "again": over(tally(same), words),
        "line_again": over(np.bincount(ld[twice], minlength=n).astype(np.float64), lines), "marked_word": over(tally(sign[last]), words),
        "short_word": over(tally(length <= 2), words), "long_word": over(tally(length >= 12), words),
        "lone_line": over(np.bincount(rows.doc[in_line <= 1], minlength=n).astype(np.float64) if len(rows.doc) else np.zeros(n), lines),
    }
    del tally_new
    return np.stack([np.asarray(values[k], np.float64) for k in STATISTICS], axis=1)


def text_statistics(documents: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """row (the kept columns as one) and one float column a statistic, for every row; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, "content"):
                s = statistics_of(b.column("content"))
                yield pa.RecordBatch.from_arrays([b.column("row"), *(pa.array(s[:, i], pa.float32()) for i in range(s.shape[1]))], names=["row", *(f"s_{x}" for x in STATISTICS)])

    given = carried(documents, keep, text)
    return given.mapInArrow(run, made(given, ", ".join(f"s_{x} float" for x in STATISTICS)))


@dataclass(frozen=True)
class Condition:
    statistic: int
    above: bool
    cut: float


Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class RuleModel:
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    intercept: float
    #: Was there any label to learn from.
    learnt: bool = True

    def column(self) -> Column:
        """The probability of label 1, over the columns of text_statistics()."""
        total = F.lit(float(self.intercept))
        for rule, weight in zip(self.rules, self.weights):
            holds = None
            for c in rule:
                value = F.col(f"s_{STATISTICS[c.statistic]}")
                one = value > F.lit(c.cut).cast("float") if c.above else value <= F.lit(c.cut).cast("float")
                holds = one if holds is None else holds & one
            total = total + F.when(holds, F.lit(float(weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def rule_matrix(x: np.ndarray, rules: tuple[Rule, ...]) -> np.ndarray:
    out = np.ones((len(x), len(rules)), np.float32)
    for j, rule in enumerate(rules):
        for c in rule:
            out[:, j] *= x[:, c.statistic] > np.float32(c.cut) if c.above else x[:, c.statistic] <= np.float32(c.cut)
    return out


def _grow(x: np.ndarray, code: np.ndarray, cuts: list[np.ndarray], residual: np.ndarray, rows: np.ndarray, path: Rule, depth: int, found: dict[Rule, None], fit: np.ndarray) -> None:
    fit[rows] = residual[rows].mean()
    if depth == 0 or len(rows) < 2 * LEAF:
        return
    best, total = (0.0, None), residual[rows].sum()
    for f in range(x.shape[1]):
        if not len(cuts[f]):
            continue
        bins = len(cuts[f]) + 1
        n = np.cumsum(np.bincount(code[rows, f], minlength=bins))[:-1]
        s = np.cumsum(np.bincount(code[rows, f], residual[rows], bins))[:-1]
        ok = (n >= LEAF) & (len(rows) - n >= LEAF)
        if not ok.any():
            continue
        gain = np.where(ok, s**2 / np.maximum(n, 1) + (total - s) ** 2 / np.maximum(len(rows) - n, 1), -1.0) - total**2 / len(rows)
        at = int(gain.argmax())
        if gain[at] > best[0] + 1e-9:
            best = (float(gain[at]), (f, at))
    if best[1] is None:
        return
    f, at = best[1]
    for above in (False, True):
        part = rows[(code[rows, f] > at) == above]
        rule = (*path, Condition(f, above, float(cuts[f][at])))
        found.setdefault(rule)
        _grow(x, code, cuts, residual, part, rule, depth - 1, found, fit)


def tree_rules(x: np.ndarray, y: np.ndarray, seed: int = 7) -> tuple[Rule, ...]:
    """Every root path of boosted trees, each grown on half of the rows."""
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")).astype(np.float32) for c in x.T]
    code = np.stack([np.searchsorted(k, c, "left") for k, c in zip(cuts, x.T)], axis=1)
    score, found = np.full(len(y), np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))), {}
    for _ in range(TREES):
        residual = y - 1 / (1 + np.exp(-score))
        rows = rng.permutation(len(y))[: max(1, len(y) // 2)]
        fit = np.zeros(len(y))
        before = len(found)
        _grow(x, code, cuts, residual, rows, (), DEPTH, found, fit)
        score += STEP * 4 * fit
        if len(found) == before and before:
            break
    return tuple(found)


def lasso_logistic(a: np.ndarray, y: np.ndarray, penalty: float = LASSO, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Accelerated proximal gradient; the intercept isn't penalised."""
    n, m = a.shape
    a1 = np.hstack([a, np.ones((n, 1), np.float32)])
    # products stay in 32 bits: a wider vector would copy the whole matrix each time
    times, back = lambda v: a1 @ v.astype(np.float32), lambda r: (a1.T @ r.astype(np.float32)).astype(np.float64)
    v = np.random.default_rng(1).normal(size=m + 1)
    for _ in range(20):  # the largest eigenvalue of the Gram matrix
        v = back(times(v))
        v /= np.linalg.norm(v)
    rate = 4 * n / max(1e-9, 1.01 * np.linalg.norm(back(times(v))))
    w = z = np.zeros(m + 1)
    t = 1.0
    shrink = np.append(np.full(m, penalty * rate), 0.0)
    for _ in range(rounds):
        g = back(1 / (1 + np.exp(-times(z))) - y) / n
        step = z - rate * g
        new = np.sign(step) * np.maximum(np.abs(step) - shrink, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, w, t = new + (t - 1) / t2 * (new - w), new, t2
    return w[:-1], float(w[-1])


def fit_rules(x: np.ndarray, y: np.ndarray) -> RuleModel:
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
        return RuleModel((), (), float(np.log(share / (1 - share))), bool(len(y)))
    x = x.astype(np.float32)
    rules = tree_rules(x, y)
    weights, intercept = lasso_logistic(rule_matrix(x, rules), y)
    kept = np.flatnonzero(np.abs(weights) > 1e-4)
    return RuleModel(tuple(rules[i] for i in kept), tuple(float(weights[i]) for i in kept), intercept)


def labelled_sample(labels: DataFrame, label: str, apart: Column, key: str = "doc_id", most: int = MOST_LABELLED) -> DataFrame:
    """key, y: at most `most` labelled rows outside the held-out part, those of least hash of the key."""
    given = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~apart).groupBy(key).agg(F.max(label).cast("double").alias("y"))
    return of_least_hash(given, key, most)


def of_least_hash(rows: DataFrame, key: str, most: int) -> DataFrame:
    """The `most` rows of least hash; a share of a fifth more is cut off first, so that tasks send about that many in all."""
    count = rows.count()
    share = min(1.0, (1.2 * most + 200) / max(1, count))
    near = rows if share == 1 else rows.where(F.pmod(F.xxhash64(key), F.lit(1 << 40)) < int(share * (1 << 40)))
    return near.orderBy(F.pmod(F.xxhash64(key), F.lit(1 << 40)), key).limit(most)


def held_out_rows(key: str, folds: int, held: int) -> Column:
    """Rows that labels aren't learnt from, by the CRC of the key as text; a null key isn't held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % folds == held, F.lit(False))


def fit_quality(documents: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", folds: int = 4, held: int = 2, most: int = MOST_LABELLED) -> RuleModel:
    """The rule model of the labelled rows' texts; statistics are made for those rows only."""
    sample = labelled_sample(labels, label, held_out_rows(key, folds, held), key, most)
    given = documents.select(key, "text").join(F.broadcast(sample), key)
    values = text_statistics(given, (key, "y")).select(F.col(f"row.{key}").alias("key"), F.struct("row.y", *(f"s_{x}" for x in STATISTICS)).alias("v"))
    got = values.groupBy("key").agg(F.min("v").alias("v")).select("v.*").toPandas()  # one row a key, whatever repeats
    return fit_rules(got[[f"s_{x}" for x in STATISTICS]].to_numpy(np.float32), got["y"].to_numpy(np.float64))


def score_quality(documents: DataFrame, model: RuleModel, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The kept columns, score and predicted for every row; one pass, no shuffle."""
    scored = text_statistics(documents, keep, text).select("row", model.column().alias("score"))
    return spread(scored, keep, ("score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score_quality(documents, fit_quality(documents, labels))
    return scored.select("doc_id", held_out_rows("doc_id", 4, 2).alias("held_out"), "score", "predicted")
