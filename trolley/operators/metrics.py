"""Ranking accuracy and slate health.

``predictions`` is (customer_id, item_id, rank) with a 0-based rank, ``truth``
is (customer_id, item_id). Labels drive every mean: a customer without a
prediction counts as a miss. Hits are counted per slot, so a slate that
repeats an item is scored slot by slot.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K_VALUES, PRIMARY_K = (5, 10, 20, 50), 20


def _hit_ranks(predictions: DataFrame, truth: DataFrame, max_k: int) -> DataFrame:
    """Per labelled customer: number of truth items and the sorted ranks of the hits (at most max_k)."""
    wanted = truth.select("customer_id", "item_id").distinct()
    hits = (
        predictions.filter(F.col("rank") < max_k).select("customer_id", "item_id", "rank")
        .join(wanted, ["customer_id", "item_id"], "left_semi")
        .groupBy("customer_id").agg(F.sort_array(F.collect_list("rank")).alias("hits"))
    )
    sizes = wanted.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_truth"))
    return sizes.join(hits, "customer_id", "left").select(
        "customer_id", "n_truth", F.coalesce("hits", F.array().cast("array<int>")).alias("hits")
    )


def ranking_metrics(
    predictions: DataFrame, truth: DataFrame, k_values: tuple[int, ...] = K_VALUES
) -> DataFrame:
    """One row per k: recall, precision, hit rate, NDCG and MAP, averaged over the labelled customers."""
    max_k = max(k_values)
    # ideal gain of 0..max_k hits
    ideal = [0.0]
    for position in range(max_k):
        ideal.append(ideal[-1] + 1.0 / math.log2(position + 2))
    per_customer = _hit_ranks(predictions, truth, max_k).withColumn(
        "k", F.explode(F.array(*[F.lit(k) for k in k_values]))
    )
    top = F.filter("hits", lambda r: r < F.col("k"))
    n_hits = F.size("top")
    ideal_len = F.least(F.col("n_truth"), F.col("k"))
    zero = F.lit(0.0)
    dcg = F.aggregate("top", zero, lambda acc, r: acc + 1.0 / F.log2((r + 2).cast("double")))
    precision_at_hits = F.aggregate(
        F.transform("top", lambda r, i: (i + 1) / (r + 1)), zero, lambda acc, x: acc + x
    )
    return (
        per_customer.withColumn("top", top)
        .select(
            "k",
            (n_hits / F.col("n_truth")).alias("recall"),
            (n_hits / F.col("k")).alias("precision"),
            (n_hits > 0).cast("double").alias("hit_rate"),
            (dcg / F.element_at(F.array(*[F.lit(x) for x in ideal]), (ideal_len + 1).cast("int"))).alias("ndcg"),
            (precision_at_hits / ideal_len).alias("map"),
        )
        .groupBy("k")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            *[F.avg(m).alias(m) for m in ("recall", "precision", "hit_rate", "ndcg", "map")],
        )
    )


def gini(counts: DataFrame, column: str) -> DataFrame:
    """Gini coefficient of positive counts, as one row.

    Equal counts are grouped first: with T units in total there are at most
    sqrt(2T) different counts, so the ordered step stays tiny at any scale.
    """
    histogram = (
        counts.filter(F.col(column) > 0).groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("m"))
    )
    before = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).orderBy("v")
    placed = histogram.select(
        "v", "m", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("start"), F.sum("m").over(everything).alias("n")
    )
    # sum over i of (2i - n - 1) for a run of m equal values that starts after ``start`` others
    term = F.col("v").cast("double") * F.col("m") * (2.0 * F.col("start") + F.col("m") - F.col("n"))
    return placed.agg((F.sum(term) / (F.max("n") * F.sum(F.col("v").cast("double") * F.col("m")))).alias("gini"))


def slate_health(
    predictions: DataFrame, truth: DataFrame, items: DataFrame, popularity: DataFrame, k: int = PRIMARY_K
) -> DataFrame:
    """Coverage, novelty, Gini and revenue per customer of the first k slots of the labelled customers.

    ``items`` has (item_id, price) and is the whole catalog, ``popularity`` has (item_id, base_popularity).
    """
    wanted = truth.select("customer_id", "item_id").distinct()
    labelled = wanted.select("customer_id").distinct()
    slots = (
        predictions.filter(F.col("rank") < k).select("customer_id", "item_id")
        .join(labelled, "customer_id", "left_semi")
    )
    counts = slots.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    surprise = -F.log2(F.greatest(F.col("base_popularity"), F.lit(1e-12)))
    served = counts.join(popularity.select("item_id", "base_popularity"), "item_id", "left").agg(
        F.count(F.lit(1)).alias("items_served"),
        F.sum("n").alias("slots"),
        (F.sum(surprise * F.col("n")) / F.sum("n")).alias("novelty"),
    )
    revenue = (
        slots.join(wanted, ["customer_id", "item_id"], "left_semi")
        .groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
        .join(items.select("item_id", "price"), "item_id").agg(F.sum(F.col("n") * F.col("price")).alias("total"))
    )
    n_items = items.agg(F.count(F.lit(1))).scalar()
    n_customers = labelled.agg(F.count(F.lit(1))).scalar()
    return served.select(
        F.lit(k).alias("k"), "items_served", "slots",
        (F.col("items_served") / n_items).alias("coverage"),
        "novelty",
        gini(counts, "n").scalar().alias("gini"),
        (F.coalesce(revenue.scalar(), F.lit(0.0)) / n_customers).alias("revenue_hit"),
    )


def purchase_concentration(purchases: DataFrame, top: int = 100) -> DataFrame:
    """Gini and top-item share of purchase counts."""
    counts = purchases.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    head = counts.orderBy(F.col("n").desc(), "item_id").limit(top).agg(F.sum("n")).scalar()
    return counts.agg(
        F.count(F.lit(1)).alias("items"), F.sum("n").alias("purchases")
    ).select(
        "items", "purchases", gini(counts, "n").scalar().alias("gini"),
        (head / F.col("purchases")).alias("top_share"),
    )


def wide_metrics(
    name: str, metrics: DataFrame, k_values: tuple[int, ...] = K_VALUES, health: DataFrame | None = None
) -> DataFrame:
    """One leaderboard row ``model, recall@5, ...`` from the per-k metrics."""
    row = metrics.agg(*[
        F.max(F.when(F.col("k") == k, F.col(m))).alias(f"{m}@{k}")
        for k in k_values for m in ("recall", "precision", "hit_rate", "ndcg", "map")
    ])
    if health is not None:
        first = health.select(F.struct("k", "coverage", "novelty", "gini", "revenue_hit")).scalar()
        row = row.withColumn("_h", first)
        for m in ("coverage", "novelty", "gini", "revenue_hit"):
            row = row.withColumn(f"{m}@{PRIMARY_K}", F.col(f"_h.{m}"))
        row = row.drop("_h")
    return row.select(F.lit(name).alias("model"), "*")


def leaderboard(rows: list[DataFrame], sort_by: str | None = None) -> DataFrame:
    """Stack model rows, also with different columns, best first."""
    board = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    if sort_by and sort_by in board.columns:
        board = board.orderBy(F.col(sort_by).desc(), F.col("model"))
    return board
