"""Causal purchase sequences and model-input tables.

A window over a whole customer would put a customer with a large share of the
log into one task. Purchases are therefore cut into chunks by day and by
blocks of ``event_seq``. As ``event_seq`` is unique, a chunk holds at most
``SEQ_BLOCK`` rows; what a row needs from before its chunk (counts, sums, the
last items) is carried over from the chunk summaries, of which a customer has
at most one per day plus one per ``SEQ_BLOCK`` events of the log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trolley.functions.expressions import is_purchase
from trolley.functions.quantiles import exact_percentiles

HISTORY_LEN, MIN_PRIOR, PRICE_BUCKETS = 20, 1, 20
SEQ_BLOCK = 1 << 20


def causal_sequences(
    interactions: DataFrame,
    items: DataFrame,
    pad_index: int,
    history_len: int = HISTORY_LEN,
    min_prior: int = MIN_PRIOR,
    order: tuple[str, ...] = ("event_seq",),
    seq_block: int = SEQ_BLOCK,
) -> DataFrame:
    """One row per purchase with at least ``min_prior`` earlier purchases of the customer.

    ``history`` holds the last ``history_len`` earlier items, left-padded, most
    recent last. ``order`` names the columns that order purchases inside a day.
    """
    order = list(order)
    chunk = ["customer_id", "day", "block"]
    # everything below that works on rows is partitioned by chunk, by this one shuffle
    bought = interactions.filter(is_purchase())
    rows = (
        bought.join(items.select("item_id", "price"), "item_id", "left")
        .select(
            *chunk[:2], (F.col(order[0]) / seq_block).cast("long").alias("block"), *order, "item_id",
            F.coalesce("price", F.lit(0.0)).alias("price"),
        )
        # stated for both uses below, so that they share the shuffle
        .filter(F.col("customer_id").isNotNull() & F.col("day").isNotNull() & F.col("block").isNotNull())
        .repartition(*chunk)
    )

    # First purchase of every (customer, item): a combinable minimum, so a pair
    # that repeats without bound is no problem. At the row where it happened
    # the number of distinct items grows by one.
    firsts = (
        bought.groupBy("customer_id", "item_id").agg(F.min(F.struct("day", *order)).alias("at"))
        .select("customer_id", "item_id", "at.*")
        .select(
            *chunk[:2], (F.col(order[0]) / seq_block).cast("long").alias("block"), *order, "item_id",
            F.lit(1).alias("is_new"),
        )
        .repartition(*chunk)
    )
    inside = Window.partitionBy(*chunk).orderBy(*order, "item_id")
    place = F.struct(*order, "item_id")
    # of rows that agree in order and item, only the first brings something new
    keyed = rows.join(firsts, [*chunk, *order, "item_id"], "left").withColumn(
        "is_new", F.when(F.lag(place).over(inside) == place, 0).otherwise(F.coalesce("is_new", F.lit(0)))
    )

    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = keyed.select(
        *chunk, "item_id", "price", "is_new",
        F.row_number().over(inside).alias("_rn"),
        F.coalesce(F.sum("price").over(upto), F.lit(0.0)).alias("_price"),
        F.coalesce(F.sum("is_new").over(upto), F.lit(0)).alias("_new"),
        F.collect_list("item_id").over(inside.rowsBetween(-history_len, -1)).alias("_past"),
        F.lead("item_id").over(inside).isNull().alias("_last"),
    )

    # The last row of a chunk knows the chunk's totals and its last items.
    sums = local.filter("_last").select(
        *chunk, F.col("_rn").alias("_n"), (F.col("_price") + F.col("price")).alias("_s"),
        (F.col("_new") + F.col("is_new")).alias("_d"), F.concat("_past", F.array("item_id")).alias("_tail"),
    )
    along = Window.partitionBy("customer_id").orderBy("day", "block")
    prior = along.rowsBetween(Window.unboundedPreceding, -1)
    # every chunk has at least one item, so history_len chunks are enough
    carried = sums.select(
        *chunk,
        F.coalesce(F.sum("_n").over(prior), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_s").over(prior), F.lit(0.0)).alias("_s0"),
        F.coalesce(F.sum("_d").over(prior), F.lit(0)).alias("_d0"),
        F.lag("day").over(along).alias("_prev_day"),
        F.min("day").over(prior).alias("_first_day"),
        F.flatten(F.collect_list("_tail").over(along.rowsBetween(-history_len, -1))).alias("_before"),
    ).withColumn(
        "_before", F.slice("_before", F.greatest(F.size("_before") - history_len + 1, F.lit(1)), F.lit(history_len))
    )

    t = F.col("_n0") + F.col("_rn") - 1
    past = F.concat("_before", "_past")
    joined = local.join(carried, chunk).withColumns({"t": t, "_all": past}).filter(F.col("t") >= min_prior)
    n = F.least(F.col("t"), F.lit(history_len)).cast("int")
    # inside a chunk the previous purchase is of the same day
    prev_day = F.when(F.col("_rn") > 1, F.col("day")).otherwise(F.col("_prev_day"))
    first_day = F.coalesce(F.col("_first_day"), F.col("day"))
    return joined.select(
        "customer_id",
        F.col("item_id").alias("target"),
        "day",
        F.concat(
            F.array_repeat(F.lit(pad_index), F.lit(history_len) - n), F.slice("_all", -n, n)
        ).alias("history"),
        n.alias("history_len"),
        F.log1p(F.col("t").cast("double")).alias("log_n_prior"),
        (F.col("day") - prev_day).cast("double").alias("days_since_last"),
        F.log1p((F.col("_s0") + F.col("_price")) / F.col("t")).alias("log_mean_price"),
        F.log1p((F.col("day") - first_day).cast("double")).alias("log_days_active"),
        ((F.col("_d0") + F.col("_new")) / F.col("t")).alias("distinct_ratio"),
    )


def last_purchases(
    interactions: DataFrame, n: int, order: tuple[str, ...] = ("event_seq",)
) -> DataFrame:
    """The ``n`` most recent purchases per customer with ``recency`` 1 = latest.

    The filter on the row number limits every key on the map side before the shuffle.
    """
    latest = Window.partitionBy("customer_id").orderBy(
        F.col("day").desc(), *[F.col(c).desc() for c in order], F.col("item_id").desc()
    )
    return (
        interactions.filter(is_purchase()).withColumn("recency", F.row_number().over(latest))
        .filter(F.col("recency") <= n).select("customer_id", "item_id", "day", "recency")
    )


def inference_state(
    interactions: DataFrame,
    items: DataFrame,
    customers: DataFrame,
    pad_index: int,
    history_len: int = HISTORY_LEN,
    order: tuple[str, ...] = ("event_seq",),
) -> DataFrame:
    """One row per requested customer: trailing items and dense features at the end of the log.

    Tenure here ends at the last purchase while recency counts from the last
    event of the log, as opposed to the training rows.
    """
    requested = customers.select("customer_id").distinct()
    last_day = interactions.agg(F.max("day")).scalar()
    tail = (
        last_purchases(interactions, history_len, order).groupBy("customer_id")
        .agg(F.transform(
            F.sort_array(F.collect_list(F.struct("recency", "item_id")), asc=False), lambda s: s["item_id"]
        ).alias("tail"))
    )
    per_item = (
        interactions.filter(is_purchase()).groupBy("customer_id", "item_id")
        .agg(F.count(F.lit(1)).alias("n"), F.min("day").alias("lo"), F.max("day").alias("hi"))
        .join(items.select("item_id", "price"), "item_id", "left")
    )
    totals = per_item.groupBy("customer_id").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_distinct"),
        F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.sum(F.coalesce("price", F.lit(0.0)) * F.col("n")).alias("spend"),
    )
    state = requested.join(tail, "customer_id", "left").join(totals, "customer_id", "left")
    size = F.coalesce(F.size("tail"), F.lit(0))
    empty = F.array().cast("array<int>")

    def known(value):
        return F.coalesce(value, F.lit(0.0))

    return state.select(
        "customer_id",
        F.concat(
            F.array_repeat(F.lit(pad_index), F.lit(history_len) - size), F.coalesce("tail", empty)
        ).alias("history"),
        size.alias("history_len"),
        known(F.log1p(F.col("n").cast("double"))).alias("log_n_prior"),
        known((last_day - F.col("hi")).cast("double")).alias("days_since_last"),
        known(F.log1p(F.col("spend") / F.col("n"))).alias("log_mean_price"),
        known(F.log1p((F.col("hi") - F.col("lo")).cast("double"))).alias("log_days_active"),
        known(F.col("n_distinct") / F.col("n")).alias("distinct_ratio"),
    )


def log_q(targets: DataFrame, items: DataFrame, target: str = "target") -> DataFrame:
    """log of each item's share of the training targets, floored at 1e-10 (A10)."""
    counts = targets.groupBy(F.col(target).alias("item_id")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    share = F.coalesce(F.col("n"), F.lit(0)) / total
    return items.select("item_id").join(counts, "item_id", "left").select(
        "item_id", F.coalesce("n", F.lit(0)).alias("n_targets"), F.log(F.greatest(share, F.lit(1e-10))).alias("log_q")
    )


def price_buckets(items: DataFrame, buckets: int = PRICE_BUCKETS) -> DataFrame:
    """Item content features: quantile price bucket = number of interior edges below the price."""
    names = [f"e{i}" for i in range(1, buckets)]
    edges = exact_percentiles(items, [], "price", {f"e{i}": i / buckets for i in range(1, buckets)})
    cut = edges.select(F.array(*[F.round(c, 6) for c in names]).alias("edges")).scalar()
    return items.withColumn("_edges", cut).select(
        "item_id", "category_id", "brand_id", "price",
        F.size(F.filter("_edges", lambda e: e < F.col("price"))).alias("price_bucket"),
    )
