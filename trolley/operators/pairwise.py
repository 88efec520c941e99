"""List-aware second stage (R12): a linear ranker on pairs of a bought and a not bought candidate of one customer.

Of each customer at most ``POSITIVES`` bought and ``NEGATIVES`` other candidates, chosen by hash, meet each other; the difference of their features is
one row of a logistic regression without intercept, half of them the other way round. So the model learns the order within a list, and a
customer's weight in it is bounded whatever the length of the list.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trolley.operators.features import FEATURE_COLUMNS
from trolley.session import stage

POSITIVES, NEGATIVES = 8, 16
MISSING = -1.0
#: Features are squeezed to sign(x) * log(1 + |x|), as counts and days have long tails.
REGULARIZATION, ITERATIONS = 1e-4, 60


def _squeezed(name: str) -> Column:
    x = F.coalesce(F.col(name).cast("double"), F.lit(MISSING))
    return F.signum(x) * F.log1p(F.abs(x))


@dataclass(frozen=True)
class PairwiseModel:
    """A weight per feature."""

    features: tuple[str, ...]
    weights: tuple[float, ...]

    def score(self) -> Column:
        total = F.lit(0.0)
        for name, weight in zip(self.features, self.weights):
            total = total + _squeezed(name) * F.lit(float(weight))
        return total


def _some(labelled: DataFrame, label: int, most: int, columns: list[Column], seed: int) -> DataFrame:
    order = Window.partitionBy("customer_id").orderBy(F.xxhash64("customer_id", "item_id", F.lit(seed)), "item_id")
    return labelled.where(F.col("label") == label).withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= most).select("customer_id", *columns)


def pairs(labelled: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, features: list[str] | None = None, seed: int = 42) -> DataFrame:
    """customer_id, item_id (bought), other_id (not bought), difference of their features; at most positives * negatives rows a customer."""
    features = features or [c for c in FEATURE_COLUMNS if c in labelled.columns]
    values = F.array(*[_squeezed(c) for c in features])
    bought = _some(labelled, 1, positives, [F.col("item_id"), values.alias("x")], seed)
    other = _some(labelled, 0, negatives, [F.col("item_id").alias("other_id"), values.alias("y")], seed)
    return bought.join(other, "customer_id").select("customer_id", "item_id", "other_id", F.zip_with("x", "y", lambda a, b: a - b).alias("difference"))


def train_pairwise(
    labelled: DataFrame, features: list[str] | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES,
    regularization: float = REGULARIZATION, iterations: int = ITERATIONS, seed: int = 42,
) -> PairwiseModel:
    """Weights fitted on all pairs; zeros where there are none."""
    features = features or [c for c in FEATURE_COLUMNS if c in labelled.columns]
    found = pairs(labelled, positives, negatives, features, seed)
    turn = F.pmod(F.xxhash64("customer_id", "item_id", "other_id", F.lit(seed)), F.lit(2))
    rows = found.select(
        F.when(turn == 0, F.col("difference")).otherwise(F.transform("difference", lambda x: -x)).alias("x"),
        (1 - turn).cast("double").alias("label"))
    data = stage(rows.select(array_to_vector("x").alias("features"), "label"), "ranker-pairs")
    if data.select("label").distinct().count() < 2:
        return PairwiseModel(tuple(features), (0.0,) * len(features))
    model = LogisticRegression(fitIntercept=False, regParam=regularization, maxIter=iterations, standardization=True).fit(data)
    return PairwiseModel(tuple(features), tuple(float(w) for w in model.coefficients))


def score_pairwise(model: PairwiseModel, frame: DataFrame) -> DataFrame:
    return frame.withColumn("score", model.score())
