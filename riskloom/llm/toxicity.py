"""Toxicity by weak supervision.

Units of toxic speech, whole words (lexicon) and word beginnings (patterns), are mined from a
bounded labelled sample. Units that occur in the same toxic texts form a group (a language or a
manner), and each group has two voters, one for its words and one for its patterns. A voter says
toxic where its units stand densely, clean where only a stray one does, and abstains elsewhere. A
generative model of two classes is fitted by expectation maximisation to the counts of vote
patterns over all documents, without labels: per voter the chances of its votes in either class,
that is its accuracy, and between voters the correlation beyond what the class explains, measured
anew in each round, by which votes that repeat each other count less. A linear classifier over
units and their density is then trained on the posterior labels of the sample's texts and scores
every document.

Null and empty texts have no units and get the classifier's base score. Without toxic labels in
the sample there are no units, and every score is the share of label 1 (0 without labels). An empty
table gives no rows. Repeated rows repeat; kept columns may have any names; labels, languages,
sources and ids never enter a score.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.quality import held_out_rows, of_least_hash
from riskloom.llm.storage import carried, made, spread, table, text_slices

#: Labelled rows of either class that mining and training use at most.
MOST_LABELLED = 3000
THRESHOLD = 0.7
#: Groups of units at most; each has a voter for words and one for patterns.
GROUPS = 5
VOTERS = 2 * GROUPS
#: A unit stands in so many toxic texts of the sample at least, and is so much likelier there (log odds).
SUPPORT, ODDS = 5, 2.5
PREFIX = (3, 4, 5, 6, 7)
#: Units are dense in a text where so many words hold them, and this share of its words.
DENSE_WORDS, DENSE_SHARE = 2, 0.01
#: What a voter says.
ABSTAIN, CLEAN, TOXIC = 0, 1, 2

WORD = re.compile(r"\w+")
Unit = tuple[str, bool]  # the letters, and whether a word may go on after them


def is_dense(hits: int, words: int) -> bool:
    return hits >= DENSE_WORDS and hits >= DENSE_SHARE * words


def mine_units(toxic: list[tuple[str, ...]], clean: list[tuple[str, ...]]) -> list[Unit]:
    """Words and word beginnings that mark the toxic texts, each text given as its distinct words.

    A word counts where it occurs, a beginning where words of it are dense. A beginning replaces the
    words that it covers where at least three words share it; of nested beginnings the longest stays
    that is marked nearly as well as the best.
    """

    def count(texts: list[tuple[str, ...]]) -> tuple[Counter, Counter]:
        words, starts = Counter(), Counter()
        for t in texts:
            words.update(t)
            each = Counter(w[:k] for w in t for k in PREFIX if len(w) > k)
            starts.update(p for p, c in each.items() if is_dense(c, len(t)))
        return words, starts

    toxic = _families(toxic)
    (tw, ts), (cw, cs) = count(toxic), count(clean)
    nt, nc = max(1, len(toxic)), max(1, len(clean))
    odds = lambda a, b: math.log((a + 0.5) / (nt - a + 0.5)) - math.log((b + 0.5) / (nc - b + 0.5))
    marked = lambda a, b: a >= max(min(SUPPORT, max(3, nt // 4)), nt // 300) and odds(a, b) >= ODDS and b <= 0.02 * a * nc / nt
    starts = {p: odds(a, cs[p]) * math.sqrt(a) for p, a in ts.items() if marked(a, cs[p])}
    spread = Counter(w[:k] for w in tw for k in PREFIX if len(w) > k and w[:k] in starts)
    starts = {p: o for p, o in starts.items() if spread[p] >= 3}
    kept: list[str] = []
    for p in sorted(starts, key=lambda p: (-round(starts[p], 9), -len(p), p)):
        if not any(p.startswith(q) or q.startswith(p) for q in kept):
            kept.append(p)
    words = {w: odds(a, cw[w]) * math.sqrt(a) for w, a in tw.items() if marked(a, cw[w]) and not w.startswith(tuple(kept))}
    units = [(o, (w, False)) for w, o in words.items()] + [(starts[p], (p, True)) for p in kept]
    return [u for _, u in sorted(units, key=lambda x: (-x[0], x[1]))]


def _families(texts: list[tuple[str, ...]]) -> list[tuple[str, ...]]:
    """One text of each family of near copies, told by three minima of hashes of their words."""
    seen: dict[tuple, tuple[str, ...]] = {}
    for t in texts:
        hashes = np.array([zlib.crc32(w.encode()) for w in t] or [0], np.uint64)
        seen.setdefault(tuple(int((hashes * np.uint64(odd) % np.uint64(4294967291)).min()) for odd in (2654435761, 2246822519, 3266489917)), t)
    return list(seen.values())


class Finder:
    """Counts units in texts with one automaton."""

    def __init__(self, units: list[Unit]):
        import ahocorasick

        self.units, self.automaton = units, ahocorasick.Automaton()
        by: dict[str, list[tuple[int, bool]]] = {}
        for i, (letters, onward) in enumerate(units):
            by.setdefault(letters, []).append((i, onward))
        for letters, which in by.items():
            self.automaton.add_word(letters, (len(letters), which))
        if units:
            self.automaton.make_automaton()

    def counts(self, text: str | None) -> dict[int, int]:
        found: dict[int, int] = {}
        if not text or not self.units:
            return found
        text = text.lower()
        word = lambda c: c.isalnum() or c == "_"
        for end, (n, which) in self.automaton.iter(text):
            start = end - n + 1
            if start and word(text[start - 1]):
                continue
            more = end + 1 < len(text) and word(text[end + 1])
            for i, onward in which:
                if onward or not more:
                    found[i] = found.get(i, 0) + 1
        return found


@dataclass(frozen=True)
class LabelModel:
    """Chances of each vote by class (clean, toxic) and voter; weights by correlation; log odds where all abstain.

    An abstention says nothing of its own, as most voters know one language or manner only; a text
    on which all abstain has the log odds `silent`.
    """

    chance: np.ndarray
    weight: np.ndarray
    prior: float
    silent: float

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        ratio = np.log(self.chance[1] / self.chance[0])
        said = np.stack([votes == v for v in (CLEAN, TOXIC)], axis=2) * ratio[None, :, 1:]
        total = said.sum(axis=2) @ self.weight + math.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(np.where(votes.any(axis=1), total, self.silent), -30, 30)))


def correlation_weights(votes: np.ndarray, mass: np.ndarray) -> np.ndarray:
    """By how much each vote counts, given what it shares with the other votes inside the classes; `mass` is by class and pattern."""
    says = (votes == TOXIC).astype(float) - (votes == CLEAN)
    m = votes.shape[1]
    cov = np.zeros((m, m))
    for each in mass:
        centred = says - (each @ says) / max(1e-9, each.sum())
        cov += (centred * each[:, None]).T @ centred
    scale = np.sqrt(np.maximum(np.diag(cov), 1e-9))
    shared = np.clip(np.abs(cov) / np.outer(scale, scale), 0, 1)
    np.fill_diagonal(shared, 0)
    return 1 / (1 + shared.sum(axis=1))


def fit_label_model(votes: np.ndarray, counts: np.ndarray, known: np.ndarray, known_y: np.ndarray, stands: np.ndarray | None = None, rounds: int = 100) -> LabelModel:
    """Votes are distinct patterns (rows) with their counts over all documents.

    `known` are the votes of the labelled sample, of which each row stands for so many: its rates
    start the estimate and stay in it with as much mass as all documents have, at every size of the
    corpus, which keeps the two classes from changing places.
    """
    stands = np.ones(len(known_y)) if stands is None else stands
    still = known_y[~known.any(axis=1)]
    share = float(np.clip((still.sum() * 0.1 + 0.01) / (len(still) + 1), 1e-4, 0.3))
    silent = math.log(share / (1 - share))
    # all chances are those of texts on which some voter speaks
    spoken = votes.any(axis=1)
    votes, counts = votes[spoken], counts[spoken]
    known_y, stands = known_y[known.any(axis=1)], stands[known.any(axis=1)]
    known = known[known.any(axis=1)]
    stands = stands * counts.sum() / max(1e-9, stands.sum())
    sure = np.stack([(1.0 - known_y) * stands, known_y * stands])

    def rates(mass: np.ndarray, of: np.ndarray) -> np.ndarray:
        each = np.stack([mass @ (of == v) for v in (ABSTAIN, CLEAN, TOXIC)], axis=2) + 0.1
        return each / each.sum(axis=2, keepdims=True)

    prior = lambda mass: float(np.clip(mass[1].sum() / max(1e-9, mass.sum()), 0.01, 0.9))
    model = LabelModel(rates(sure, known), np.ones(votes.shape[1]), prior(sure), silent)
    for _ in range(rounds if len(votes) else 0):
        q = model.posterior(votes)
        mass = np.stack([(1 - q) * counts, q * counts])
        every = np.hstack([mass, sure])
        chance = rates(every, np.vstack([votes, known]))
        new = LabelModel(chance, correlation_weights(votes, mass), prior(every), silent)
        done = np.abs(new.chance - model.chance).max() < 1e-6
        model = new
        if done:
            break
    return model


def features(found: dict[int, int], words: int, m: int) -> dict[int, float]:
    """Per unit the logarithm of its count, then that of all hits, and their share of the words up to a twentieth, a place each."""
    hits = sum(found.values())
    return {i: math.log1p(c) for i, c in found.items()} | ({m: math.log1p(hits), m + 1: 100 * min(0.05, hits / max(1, words))} if hits else {})


@dataclass(frozen=True)
class ToxicityModel:
    units: list[Unit]
    weights: np.ndarray
    intercept: float

    def score(self, found: dict[int, int], words: int) -> float:
        total = self.intercept + sum(self.weights[i] * x for i, x in features(found, words, len(self.units)).items())
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))


def fit_linear(rows: list[dict[int, float]], target: np.ndarray, m: int, ridge: float = 1e-4, rounds: int = 40) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by damped Newton steps."""
    a = np.zeros((len(rows), m + 1))
    a[:, m] = 1
    for i, r in enumerate(rows):
        for j, x in r.items():
            a[i, j] = x
    keep = np.append(np.full(m, ridge), 1e-6)
    w = np.zeros(m + 1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (p - target) / len(rows) + keep * w
        h = (a * np.maximum(p * (1 - p), 1e-4)[:, None]).T @ a / len(rows) + np.diag(keep)
        step = np.linalg.solve(h, g)
        step *= min(1.0, 4 / max(1e-9, np.abs(step).max()))
        w = w - step
        if np.abs(step).max() < 1e-4:
            break
    return w[:m], float(w[m])


def voter_of(units: list[Unit], toxic: list[dict[int, int]]) -> np.ndarray:
    """The voter of each unit: units that stand in the same toxic texts share a group.

    The best unit of those that are left opens a group; a unit joins the group whose first unit it is met with most often.
    """
    where: list[set[int]] = [set() for _ in units]
    for row, found in enumerate(toxic):
        for i in found:
            where[i].add(row)
    firsts: list[int] = []
    group = np.zeros(len(units), np.int64)
    for i in range(len(units)):
        met = [len(where[i] & where[f]) / max(1, min(len(where[i]), len(where[f]))) for f in firsts]
        if len(firsts) < GROUPS and max(met, default=0.0) < 0.2:
            firsts.append(i)
            group[i] = len(firsts) - 1
        else:
            group[i] = int(np.argmax(met))
    return 2 * group + np.array([onward for _, onward in units], np.int64)


def votes_of(found: dict[int, int], words: int, deal: np.ndarray) -> int:
    """What the voters say of a text, as the digits of one number."""
    hits: dict[int, int] = {}
    for i, c in found.items():
        hits[int(deal[i])] = hits.get(int(deal[i]), 0) + c
    return sum((TOXIC if is_dense(h, words) else CLEAN) * 3**v for v, h in hits.items())


def unfolded(votes: np.ndarray) -> np.ndarray:
    return np.asarray(votes, np.int64)[:, None] // 3 ** np.arange(VOTERS) % 3


def fit_toxicity(documents: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "toxic", folds: int = 3, held: int = 1, most: int = MOST_LABELLED) -> ToxicityModel:
    """Units from the labelled sample, a label model of all documents' votes, a linear model of its posterior."""
    given = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out_rows(key, folds, held)).groupBy(key).agg(F.max(label).alias("y"))
    sizes = {int(r["y"]): r["n"] for r in given.groupBy("y").agg(F.count("*").alias("n")).collect() if r["y"] in (0, 1)}
    prior = sizes.get(1, 0) / max(1, sum(sizes.values()))
    picked = [of_least_hash(given.where(F.col("y") == y), key, most) for y in (1, 0)]
    sample = picked[0].unionByName(picked[1])

    # of rows that repeat an id the least text is learnt from
    texts = documents.select(key, "text").join(F.broadcast(sample), key).groupBy(key).agg(F.max("y").cast("int").alias("y"), F.min("text").alias("text")).select("y", "text")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, "text"):
                sets = [sorted(set(WORD.findall((t or "").lower()))) for t in b.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column("y"), pa.array(sets, pa.list_(pa.string()))], names=["y", "words"])

    got = texts.mapInArrow(words, "y int, words array<string>").toArrow()
    y = np.array(got.column("y").to_pylist(), np.int64)
    pool: dict[str, str] = {}  # each distinct word once
    sets = [tuple([pool.setdefault(w, w) for w in words.as_py()]) for words in got.column("words")]
    del got
    units = mine_units([s for s, v in zip(sets, y) if v], [s for s, v in zip(sets, y) if not v])
    del sets, pool

    def run_found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(units)
        for whole in batches:
            for b in text_slices(whole, "text"):
                each = [(finder.counts(t), len((t or "").split())) for t in b.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column("y"), pa.array([n for _, n in each], pa.int64()), pa.array([list(f.items()) for f, _ in each], pa.map_(pa.int32(), pa.int32()))], names=["y", "words", "found"])

    if not units:
        return ToxicityModel([], np.zeros(0), math.log((prior + 1e-6) / (1 - prior + 1e-6)))
    known = texts.mapInArrow(run_found, "y int, words long, found map<int, int>").collect()
    y = np.array([r["y"] for r in known], np.int64)
    deal = voter_of(units, [r["found"] for r in known if r["y"]])

    def run_votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, seen = Finder(units), Counter()
        for b in batches:
            for t in b.column("text"):
                text = t.as_py()
                found = finder.counts(text)
                seen[votes_of(found, len(text.split()), deal) if found else 0] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], names=["votes", "n"])

    stands = np.array([sizes[int(v)] / max(1, (y == v).sum()) for v in y])
    # at most as many rows as vote patterns, 3 ** VOTERS
    tallied = documents.select("text").mapInArrow(run_votes, "votes long, n long").groupBy("votes").agg(F.sum("n").alias("n")).collect()
    votes = unfolded([votes_of(r["found"], r["words"], deal) for r in known])
    model = fit_label_model(unfolded([r["votes"] for r in tallied]), np.array([r["n"] for r in tallied], np.float64), votes, y, stands)
    return ToxicityModel(units, *fit_linear([features(r["found"], r["words"], len(units)) for r in known], model.posterior(votes), len(units) + 2))


def score_toxicity(documents: DataFrame, model: ToxicityModel, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The kept columns, score and predicted for every row; one pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(model.units)
        for whole in batches:
            for b in text_slices(whole, "content"):
                scores = [model.score(finder.counts(t), len((t or "").split())) for t in b.column("content").to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(scores, pa.float64())], names=["row", "score"])

    given = carried(documents, keep, text)
    scored = given.mapInArrow(run, made(given, "score double"))
    return spread(scored, keep, ("score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score_toxicity(documents, fit_toxicity(documents, labels))
    return scored.select("doc_id", held_out_rows("doc_id", 3, 1).alias("held_out"), "score", "predicted")
