"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the interaction log.
EVENT_VIEW, EVENT_CART, EVENT_PURCHASE = 0, 1, 2
# Implicit-feedback weight per event type.
EVENT_WEIGHTS = {EVENT_VIEW: 0.3, EVENT_CART: 1.0, EVENT_PURCHASE: 3.0}


def is_purchase() -> Column:
    return F.col("event_type") == EVENT_PURCHASE


def half_life_decay(age: Column, half_life_days: float) -> Column:
    """2^(-age / half_life), written as an exponential."""
    return F.exp(-F.log(F.lit(2.0)) * age / F.lit(float(half_life_days)))


def event_weight() -> Column:
    weight = F.lit(None).cast("double")
    for event_type, value in EVENT_WEIGHTS.items():
        weight = F.when(F.col("event_type") == event_type, F.lit(value)).otherwise(weight)
    return weight


def score_key(score: Column) -> Column:
    """Scores are compared in whole billionths, so that the order of a floating-point sum cannot flip ranks.

    Only good for comparing. Rounding to 9 places would give the same order but
    goes through a decimal number per row, which costs more than the sort.
    """
    return F.rint(score * 1e9) + 0.0


def best_first(
    df: DataFrame, keys: list[str], k: int, score: str = "score", tie: str = "item_id"
) -> DataFrame:
    """The ``k`` best rows per key, best score first, ties by ascending id, with a 0-based ``rank``.

    The filter is on the plain row number, which lets Spark keep k rows per key
    on the map side already: a hot key never reaches one task whole.
    """
    order = Window.partitionBy(*keys).orderBy(score_key(F.col(score)).desc(), F.col(tie).asc())
    numbered = df.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= k)
    return numbered.withColumn("rank", F.col("_rn") - 1).drop("_rn")


def words(text: Column) -> Column:
    """Number of whitespace-separated words."""
    return F.size(F.regexp_extract_all(text, F.lit(r"\S+"), F.lit(0)))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )


def unit(vector: Column) -> Column:
    """L2-normalised vector; an all-zero vector stays as it is.

    The norm goes into the lambda as a repeated value: named in its body, it
    would be computed again for every element.
    """
    norms = F.array_repeat(F.sqrt(dot(vector, vector)), F.size(vector))
    return F.zip_with(
        vector, norms, lambda x, n: F.when(n > 0, x.cast("double") / n).otherwise(x.cast("double"))
    )
