"""Scorecard regression on WOE features, its tuning, and isotonic calibration."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.operators import metrics
from riskloom.operators.encoder import WoeEncoder
from riskloom.operators.search import Dimension, Search
from riskloom.session import settled

#: Rows of a bucket in which permutation_importance() shifts values.
IMPORTANCE_ROWS = 100_000


@dataclass
class Scorecard:
    """A logistic model over WOE columns, in WOE units: scaling is folded into the coefficients."""

    encoder: WoeEncoder
    features: list[str]
    coefficients: list[float]
    intercept: float
    pdo: float = 20.0
    base: float = 600.0
    base_odds: float = 1 / 15
    session: object = None

    def probability(self) -> Column:
        """The probability of label 1, over the raw features: one projection, no model object on the executors."""
        total = F.lit(float(self.intercept))
        for f, c in zip(self.features, self.coefficients):
            total = total + F.lit(float(c)) * self.encoder.column(f)
        return 1 / (1 + F.exp(-total))

    def score(self, df: DataFrame, name: str = "model_score") -> DataFrame:
        return self.encoder.detached(self.encoder.attached(df, self.features).withColumn(name, self.probability()))

    def scorecard(self) -> DataFrame:
        """feature, bin, woe, coef, points for each bin, and a base row; the points of a row sum to its score."""
        factor = self.pdo / math.log(2)
        offset = self.base + factor * math.log(self.base_odds)
        rows = [("__base__", "", 0.0, float(self.intercept), round(offset - factor * self.intercept, 2))]
        for f, c in zip(self.features, self.coefficients):
            table = {} if f in self.encoder.large else self.encoder.woe.get(f) or self.encoder.categories[f]
            rows += [(f, b, float(w), float(c), round(-factor * c * w, 2)) for b, w in sorted(table.items())]
        card = self.session.createDataFrame(rows, "feature string, bin string, woe double, coef double, points double")
        for f, c in zip(self.features, self.coefficients):
            if f in self.encoder.large:
                card = card.unionByName(self.encoder.table.where(F.col("feature") == f).select("feature", F.col("value").alias("bin"), "woe", F.lit(float(c)).alias("coef"), F.round(-factor * c * F.col("woe"), 2).alias("points")))
        return card

    def dumps(self) -> str:
        return json.dumps({"encoder": json.loads(self.encoder.dumps()), "features": self.features, "coefficients": self.coefficients, "intercept": self.intercept, "pdo": self.pdo, "base": self.base, "base_odds": self.base_odds})

    @staticmethod
    def loads(text: str, session: object = None, table: DataFrame | None = None) -> Scorecard:
        d = json.loads(text)
        return Scorecard(WoeEncoder(**d.pop("encoder"), table=table), session=session, **d)


def fit_logistic(train: DataFrame, encoder: WoeEncoder, features: Sequence[str], label: str = "label", c: float = 1.0, iterations: int = 1000) -> Scorecard:
    """L2 logistic regression with balanced class weights on standardised WOE; the penalty is 1 / (c * sum of weights).

    WOE takes few values, so rows equal in all of them and the label are one row of their count; the sums are the same.
    """
    rows = encoder.attached(train, features).select(F.col(label).cast("double").alias("_y"), *(encoder.column(f).alias(f) for f in features)).where("_y IS NOT NULL")
    rows = settled(rows.groupBy("_y", *features).agg(F.count("*").cast("double").alias("_n")))
    row = rows.agg(F.sum("_n").alias("_n"), F.sum(F.col("_y") * F.col("_n")).alias("_b"), *(F.sum(F.col(f) * F.col("_n")).alias(f"m_{f}") for f in features)).first()
    n, b = row["_n"], row["_b"]
    if not n or not 0 < b < n:
        raise ValueError("both classes are needed")
    mean = [row[f"m_{f}"] / n for f in features]
    # the squares are of distances from the mean: a feature of one value is off it by rounding at most
    row = rows.agg(*(F.sum(F.col("_n") * (F.col(f) - m) * (F.col(f) - m)).alias(f"s_{f}") for f, m in zip(features, mean)), *(F.min(f).eqNullSafe(F.max(f)).alias(f"c_{f}") for f in features)).first()
    std = [1.0 if row[f"c_{f}"] else math.sqrt(row[f"s_{f}"] / n) for f in features]
    weight = F.col("_n") * F.when(F.col("_y") == 1, n / (2 * b)).otherwise(n / (2 * (n - b)))
    scaled = rows.select("_y", weight.alias("_w"), *(((F.col(f) - m) / s).alias(f) for f, m, s in zip(features, mean, std)))
    model = LogisticRegression(featuresCol="_x", labelCol="_y", weightCol="_w", standardization=False, elasticNetParam=0.0, regParam=1 / (c * n), maxIter=iterations, tol=1e-9).fit(VectorAssembler(inputCols=list(features), outputCol="_x").transform(scaled))
    coef = [float(k) / s for k, s in zip(model.coefficients, std)]
    return Scorecard(encoder, list(features), coef, float(model.intercept) - sum(k * m for k, m in zip(coef, mean)), session=train.sparkSession)


def scorecard_model(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str = "label", by: str = "split", c: float = 1.0) -> Scorecard:
    train = df.where(F.col(by) == "train")
    encoder = WoeEncoder.fit(train, numeric, categorical, label)
    return fit_logistic(train, encoder, encoder.features, label, c)


PENALTY_SPACE = (Dimension("c", 1e-3, 10.0, log=True),)


def tune_logistic(train: DataFrame, encoder: WoeEncoder, features: Sequence[str], key: str, label: str = "label", trials: int = 10, folds: int = 5, seed: int = 42, search: Search | None = None) -> float:
    """The penalty of best mean AUC over folds, by a Parzen estimator; `search` may hold earlier trials and gets the new ones."""
    search = search or Search(PENALTY_SPACE, seed)
    rows = train.withColumn("_fold", F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(folds)))

    def value(given: dict) -> float:
        values = []
        for k in range(folds):
            model = fit_logistic(rows.where(F.col("_fold") != k), encoder, features, label, given["c"])
            values.append(metrics.auc(model.score(rows.where(F.col("_fold") == k), "_p"), "_p", label).first()["auc"] or 0.5)
        return sum(values) / folds

    return search.run(value, trials)["c"]


@dataclass
class Calibrator:
    """Isotonic calibration; fitted on scores summed by value, so equal scores are one point."""

    model: IsotonicRegressionModel

    @staticmethod
    def fit(df: DataFrame, score: str, label: str = "label") -> Calibrator:
        points = df.where(F.col(label).isNotNull()).groupBy(F.col(score).alias("s")).agg(F.avg(F.col(label).cast("double")).alias("y"), F.count("*").cast("double").alias("w"))
        return Calibrator(IsotonicRegression(featuresCol="s", labelCol="y", weightCol="w", predictionCol="_c").fit(points))

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(path)

    @staticmethod
    def load(path: str) -> Calibrator:
        return Calibrator(IsotonicRegressionModel.load(path))

    def apply(self, df: DataFrame, score: str, name: str = "calibrated_prob") -> DataFrame:
        """Linear between knots, flat beyond them, within 0 and 1."""
        out = self.model.setFeaturesCol(score).setPredictionCol("_c").transform(df)
        return out.withColumn(name, F.greatest(F.least("_c", F.lit(1.0)), F.lit(0.0))).drop("_c")


def permutation_importance(df: DataFrame, features: Sequence[str], score, label: str = "label", key: str = "app_id", seed: int = 7) -> DataFrame:
    """feature, importance: the loss of AUC when each row takes a feature's value from the row before it, in random order
    within hash buckets of about IMPORTANCE_ROWS rows; for models of any kind.
    """
    base = metrics.auc(score(df), "model_score", label).first()["auc"]
    rows = []
    bucket = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(df.count() // IMPORTANCE_ROWS + 1))
    turn = W.partitionBy("_b").orderBy(F.xxhash64(key, F.lit(seed + 1)), key)
    for f in features:
        held = F.struct(F.col(f).alias("v"))
        before = F.coalesce(F.lag(held).over(turn), F.last(held).over(turn.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
        mixed = df.withColumn("_b", bucket).withColumn("_moved", before["v"]).withColumn(f, F.col("_moved")).drop("_moved", "_b")
        rows.append((f, float(base - metrics.auc(score(mixed), "model_score", label).first()["auc"])))
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def assemble(df: DataFrame, features: Sequence[str], name: str = "features") -> DataFrame:
    """Raw numeric features as a vector with missing values kept."""
    return VectorAssembler(inputCols=list(features), outputCol=name, handleInvalid="keep").transform(df)
