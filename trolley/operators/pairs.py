"""The one aggregate of the log per (customer, item) that features and retrievers share.

The log is scanned once and combined on the map side before the shuffle. A
customer or an item that makes up a large share of the log is one row per pair
after that, and everything else works on those rows. Decays are anchored at
``as_of_day``; another anchor is a constant factor, see ``reanchored``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.functions.expressions import (
    EVENT_CART, EVENT_PURCHASE, EVENT_VIEW, event_weight, half_life_decay,
)

POPULARITY_HALF_LIFE, HALF_LIFE = 21.0, 30.0


def guard_leak(history: DataFrame, as_of_day: int) -> DataFrame:
    """Fail the job when a row is later than ``as_of_day``. Checked in the same pass that reads the rows."""
    message = F.concat(
        F.lit("feature history leaks past as_of_day "), F.lit(as_of_day), F.lit(": day "), F.col("day")
    )
    return history.filter(
        F.when(F.col("day") > as_of_day, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    )


def pair_aggregate(
    history: DataFrame, as_of_day: int,
    popularity_half_life: float = POPULARITY_HALF_LIFE, half_life: float = HALF_LIFE,
) -> DataFrame:
    """Counts, days and decayed weights per (customer_id, item_id).

    ``popular_w`` and ``repeat_w`` sum the purchase decay with the popularity
    and the repeat half-life, ``implicit_w`` the weighted decay of all events.
    """
    kind, day = F.col("event_type"), F.col("day")
    bought = kind == EVENT_PURCHASE
    age = F.lit(as_of_day) - day
    slow = half_life_decay(age, half_life)
    return guard_leak(history, as_of_day).groupBy("customer_id", "item_id").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.max("day").alias("last_day"),
        F.min("day").alias("first_day"),
        F.count_if(bought).alias("n_purchase"),
        F.count_if(kind == EVENT_CART).alias("n_cart"),
        F.count_if(kind == EVENT_VIEW).alias("n_view"),
        F.sum("quantity").alias("qty"),
        F.sum(F.when(bought, F.col("quantity"))).alias("units"),
        F.max(F.when(bought, day)).alias("last_purchase"),
        F.min(F.when(bought, day)).alias("first_purchase"),
        F.sum(F.when(bought, half_life_decay(age, popularity_half_life))).alias("popular_w"),
        F.sum(F.when(bought, slow)).alias("repeat_w"),
        F.sum(event_weight() * slow).alias("implicit_w"),
        F.lit(as_of_day).alias("as_of_day"),
    )


def bought_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.filter(F.col("n_purchase") > 0)


def reanchored(weight: str, anchor: Column, half_life: float) -> Column:
    """A decayed sum as if its decay had started at ``anchor`` instead of ``as_of_day``."""
    return F.col(weight) / half_life_decay(F.col("as_of_day") - anchor, half_life)


#: Decayed sums of a state and their half-lives.
DECAYED = {"popular_w": POPULARITY_HALF_LIFE, "repeat_w": HALF_LIFE, "implicit_w": HALF_LIFE}


def merged(states: list[DataFrame], as_of_day: int) -> DataFrame:
    """One pair aggregate from those of disjoint days, as of ``as_of_day``: counts add up, decayed sums move to the new anchor first.

    So a day costs the rows of that day and one row per pair, however long the log is.
    """
    pooled = None
    for state in states:
        age = F.lit(as_of_day) - F.col("as_of_day")
        moved = state.withColumns({c: F.col(c) * half_life_decay(age, life) for c, life in DECAYED.items()})
        pooled = moved if pooled is None else pooled.unionByName(moved)
    sums = ("n_events", "n_purchase", "n_cart", "n_view", "qty", "units", *DECAYED)
    return pooled.groupBy("customer_id", "item_id").agg(
        *[F.sum(c).alias(c) for c in sums],
        *[F.max(c).alias(c) for c in ("last_day", "last_purchase")], *[F.min(c).alias(c) for c in ("first_day", "first_purchase")],
        F.lit(as_of_day).alias("as_of_day"),
    ).select(states[0].columns)
