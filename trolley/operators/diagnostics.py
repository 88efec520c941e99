"""Log profile and diagnostics of a ranked, labelled frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.functions.expressions import best_first, is_purchase
from trolley.operators.features import SOURCES

K = 20
# History-depth buckets by upper bound, the last one open; "0" is for customers without a purchase.
DEPTH_BUCKETS = ((0, "0"), (5, "1-5"), (15, "6-15"), (30, "16-30"), (60, "31-60"), (None, "60+"))


def event_profile(pairs: DataFrame, items: DataFrame, top: int = 100) -> DataFrame:
    """Counts by type, distinct customers and items, revenue, repeat share and top-item share.

    ``pairs`` is the pair aggregate of the whole log; the distinct counts are
    counts over its rows.
    """
    per_item = (
        pairs.groupBy("item_id").agg(
            F.sum("n_events").alias("n"), F.sum("n_view").alias("views"), F.sum("n_cart").alias("carts"),
            F.sum("n_purchase").alias("purchases"), F.sum("units").alias("units"),
            F.count_if(F.col("n_purchase") > 0).alias("bought_pairs"),
        )
        .join(items.select("item_id", "price"), "item_id", "left")
    )
    n_customers = pairs.select("customer_id").distinct().agg(F.count(F.lit(1))).scalar()
    head = per_item.orderBy(F.col("purchases").desc(), "item_id").limit(top).agg(F.sum("purchases")).scalar()
    total = per_item.agg(
        F.sum("n").alias("events"), F.sum("views").alias("views"), F.sum("carts").alias("carts"),
        F.sum("purchases").alias("purchases"), F.count(F.lit(1)).alias("items"),
        F.sum(F.coalesce("units", F.lit(0)) * F.col("price")).alias("revenue"),
        F.sum("bought_pairs").alias("bought_pairs"),
    )
    return total.select(
        "events", "views", "carts", "purchases", n_customers.alias("customers"), "items", "revenue",
        (F.lit(1.0) - F.try_divide("bought_pairs", "purchases")).alias("repeat_share"),
        F.try_divide(head, F.col("purchases")).alias("top_share"),
    )


def known_items(history: DataFrame) -> DataFrame:
    return history.filter(is_purchase()).select("customer_id", "item_id").distinct()


def history_depth(history: DataFrame) -> DataFrame:
    return history.filter(is_purchase()).groupBy("customer_id").agg(F.count(F.lit(1)).alias("depth"))


def _truth_with_hits(predictions: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    slate = (
        predictions.filter(F.col("rank") < k).select("customer_id", "item_id").distinct()
        .withColumn("_hit", F.lit(1))
    )
    return (
        truth.select("customer_id", "item_id").distinct()
        .join(slate, ["customer_id", "item_id"], "left").withColumn("hit", F.coalesce("_hit", F.lit(0))).drop("_hit")
    )


def repeat_vs_discovery(predictions: DataFrame, truth: DataFrame, known: DataFrame, k: int = K) -> DataFrame:
    """Micro recall on items the customer had bought before and on new ones."""
    flagged = _truth_with_hits(predictions, truth, k).join(
        known.withColumn("_known", F.lit(True)), ["customer_id", "item_id"], "left"
    )
    old = F.col("_known").isNotNull()
    counts = flagged.agg(
        F.count_if(old).alias("repeat_total"),
        F.count_if(old & (F.col("hit") == 1)).alias("repeat_hits"),
        F.count_if(~old).alias("new_total"),
        F.count_if(~old & (F.col("hit") == 1)).alias("new_hits"),
    )

    def share(a, b):
        return F.col(a) / F.greatest(b, F.lit(1))

    return counts.select(
        share("repeat_hits", F.col("repeat_total")).alias("repeat_recall"),
        share("new_hits", F.col("new_total")).alias("discovery_recall"),
        share("repeat_total", F.col("repeat_total") + F.col("new_total")).alias("repeat_share_of_truth"),
    )


def recall_by_depth(predictions: DataFrame, truth: DataFrame, depth: DataFrame, k: int = K) -> DataFrame:
    """Mean recall per bucket of purchase-history depth, every customer of ``truth`` in one; empty buckets do not appear."""
    per_customer = (
        _truth_with_hits(predictions, truth, k).groupBy("customer_id")
        .agg((F.sum("hit") / F.count(F.lit(1))).alias("recall"))
        .join(depth, "customer_id", "left")
    )
    bucket = F.lit(DEPTH_BUCKETS[-1][1])
    for upper, name in reversed(DEPTH_BUCKETS[:-1]):
        bucket = F.when(F.coalesce("depth", F.lit(0)) <= upper, name).otherwise(bucket)
    return (
        per_customer.withColumn("history_purchases", bucket).groupBy("history_purchases")
        .agg(F.count(F.lit(1)).alias("customers"), F.avg("recall").alias("recall"))
    )


def source_contribution(
    scored: DataFrame, k: int = K, score: str = "score", names: tuple[str, ...] = SOURCES
) -> DataFrame:
    """Which source supplied the slots and the hits of the top k, and which of them no other source had."""
    top = best_first(scored, ["customer_id"], k, score)
    n_sources = sum((F.col(f"in_{n}") for n in names), F.lit(0))
    long = top.select("label", n_sources.alias("n"), F.explode(F.array(*[
        F.struct(F.lit(n).alias("source"), F.col(f"in_{n}").alias("present")) for n in names
    ])).alias("s")).select("label", "n", "s.*")
    present, hit = F.col("present") == 1, F.col("label") == 1
    only = present & (F.col("n") == 1)
    counts = long.groupBy("source").agg(
        F.count(F.lit(1)).alias("slots"), F.count_if(present).alias("own"),
        F.count_if(present & hit).alias("hits"), F.count_if(only).alias("exclusive_slots"),
        F.count_if(only & hit).alias("exclusive_hits"),
    )
    return counts.select(
        "source", (F.col("own") / F.col("slots")).alias("slate_share"), "hits",
        (F.col("hits") / F.greatest("own", F.lit(1))).alias("precision"),
        "exclusive_slots", "exclusive_hits",
    )


def feature_freshness(pairs: DataFrame, items: DataFrame, as_of_day: int) -> DataFrame:
    """Latest day per feature block and its age against ``as_of_day``: what a scoring run checks before it trusts a block.

    The pair block takes every event, the customer, category and brand blocks take purchases, the item block purchases of catalog items.
    """
    known = items.select("item_id", F.lit(True).alias("_known"))
    days = pairs.join(known, "item_id", "left").agg(
        F.max("last_day").alias("user_item"), F.max("last_purchase").alias("user"),
        F.max(F.when(F.col("_known"), F.col("last_purchase"))).alias("item"),
    )
    blocks = {"user_item": "user_item", "user": "user", "user_category": "user", "user_brand": "user", "item": "item"}
    return days.select(F.inline(F.array(*[
        F.struct(F.lit(b).alias("block"), F.col(c).alias("latest_day"), (F.lit(as_of_day) - F.col(c)).alias("age_days"))
        for b, c in blocks.items()
    ])))


def feature_null_profile(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Null share per feature, in one pass over the frame."""
    shares = frame.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    return shares.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("null_share")) for c in columns
    ])))
