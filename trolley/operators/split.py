"""Temporal split, eligibility and ground truth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.functions.expressions import is_purchase
from trolley.functions.quantiles import exact_percentiles

TEST_DAYS, VALID_DAYS, MIN_TRAIN_EVENTS = 7, 7, 3


def purchases_only(interactions: DataFrame) -> DataFrame:
    return interactions.filter(is_purchase())


def split_days(
    interactions: DataFrame, test_days: int = TEST_DAYS, valid_days: int = VALID_DAYS
) -> tuple[int, int]:
    """(train_end, valid_end). One scalar comes to the driver, so that later
    day filters are literals and can prune partitions."""
    max_day = interactions.agg(F.max("day")).first()[0]
    valid_end = max_day - test_days
    return valid_end - valid_days, valid_end


def split_window(train_end: int, valid_end: int):
    """Window name of a row: train, valid or test."""
    return (
        F.when(F.col("day") <= train_end, "train").when(F.col("day") <= valid_end, "valid").otherwise("test")
    )


def eligible_customers(train: DataFrame, min_events: int = MIN_TRAIN_EVENTS) -> DataFrame:
    """Customers with enough train events of any type."""
    return (
        train.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_events"))
        .filter(F.col("n_events") >= min_events)
    )


def ground_truth(window: DataFrame, eligible: DataFrame) -> DataFrame:
    """Distinct (customer_id, item_id) bought in the window by eligible customers.

    Distinct first: the join then meets at most one row per customer and item.
    """
    bought = purchases_only(window).select("customer_id", "item_id").distinct()
    return bought.join(eligible.select("customer_id"), "customer_id", "left_semi")


def split_summary(interactions: DataFrame, train_end: int, valid_end: int) -> DataFrame:
    """Day range, events, purchases, distinct customers and items per window.

    Distinct counts come from two pre-aggregations instead of a row-expanding
    double count(distinct).
    """
    named = interactions.withColumn("window", split_window(train_end, valid_end))
    per_customer = named.groupBy("window", "customer_id").agg(
        F.min("day").alias("lo"), F.max("day").alias("hi"),
        F.count(F.lit(1)).alias("events"), F.count_if(is_purchase()).alias("purchases"),
    )
    by_customer = per_customer.groupBy("window").agg(
        F.min("lo").alias("first_day"), F.max("hi").alias("last_day"),
        F.sum("events").alias("events"), F.sum("purchases").alias("purchases"),
        F.count(F.lit(1)).alias("customers"),
    )
    by_item = (
        named.select("window", "item_id").distinct().groupBy("window").agg(F.count(F.lit(1)).alias("items"))
    )
    return by_customer.join(by_item, "window")


def basket_size_stats(truth: DataFrame) -> DataFrame:
    """Scorable customers; mean, median and 90th percentile of their basket sizes."""
    sizes = truth.groupBy("customer_id").agg(F.count(F.lit(1)).alias("size"))
    mean = sizes.agg(F.avg("size").alias("mean_size"))
    cuts = exact_percentiles(sizes, [], "size", {"median_size": 0.5, "p90_size": 0.9})
    return cuts.select(
        F.col("n").alias("customers"), mean.scalar().alias("mean_size"), "median_size", "p90_size"
    )


def customer_holdout(customers: DataFrame, share_percent: int = 15, seed: int = 42) -> DataFrame:
    """Hold out whole customers, never rows, by an arithmetic hash of the id."""
    mixed = (F.col("customer_id").cast("long") * 48271 + seed * 7919) % 2147483647
    return customers.withColumn("is_holdout", mixed % 100 < share_percent)
