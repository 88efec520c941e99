"""Scans of the given tables and their canonical forms (inventory S1, S2, S9).

Canonical interactions have the columns
``customer_id bigint, item_id bigint, day int, event_type int, quantity int, event_seq bigint``
with event types 0 view, 1 cart, 2 purchase; ``event_seq`` orders a day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

EVENTS_EPOCH = dt.date(2024, 1, 1)
ORDERS_EPOCH = dt.date(1995, 1, 1)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def load_events(spark: SparkSession, path: str, as_of_day: int) -> DataFrame:
    """Canonical interactions stored by day, cut at ``as_of_day`` right at the scan.

    With a ``day``-partitioned folder the cut prunes whole partitions. Rows are
    not moved to their customer here: the aggregations combine on the map side
    first, so a customer with a large share of the log stays spread out.
    """
    return spark.read.parquet(path).filter(F.col("day") <= F.lit(as_of_day))


def interactions_from_events(
    spark: SparkSession, folder: str, as_of_day: int | None = None, after_day: int | None = None
) -> DataFrame:
    """Interactions of the ``events`` table: view, click and purchase rows.

    The day bounds become timestamp bounds, so that they reach the parquet scan.
    """
    events = table(spark, folder, "events").filter(F.col("event_type").isin("view", "click", "purchase"))
    if as_of_day is not None:
        end = EVENTS_EPOCH + dt.timedelta(days=as_of_day + 1)
        events = events.filter(F.col("ts") < F.lit(dt.datetime(end.year, end.month, end.day)))
    if after_day is not None:
        start = EVENTS_EPOCH + dt.timedelta(days=after_day + 1)
        events = events.filter(F.col("ts") >= F.lit(dt.datetime(start.year, start.month, start.day)))
    purchase = F.col("event_type") == "purchase"
    return events.select(
        F.col("user_id").cast("bigint").alias("customer_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
        F.datediff(F.col("ts"), F.lit(EVENTS_EPOCH)).alias("day"),
        F.when(F.col("event_type") == "view", 0).when(F.col("event_type") == "click", 1).otherwise(2)
        .alias("event_type"),
        F.when(purchase, 1).otherwise(0).alias("quantity"),
        F.col("event_id").alias("event_seq"),
    )


def purchases_from_orders(
    spark: SparkSession, folder: str, as_of_day: int | None = None, after_day: int | None = None
) -> DataFrame:
    """Purchases of ``orders`` joined with ``lineitem``, as canonical interactions.

    ``event_seq`` is the order and line number, which is not unique in this
    data; readers that need a total order add ``part_id`` and ``supplier_id``.
    The day bounds become bounds of the order date, so that they reach the parquet scan.
    """
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    if as_of_day is not None:
        orders = orders.filter(F.col("o_orderdate") < F.lit(ORDERS_EPOCH + dt.timedelta(days=as_of_day + 1)))
    if after_day is not None:
        orders = orders.filter(F.col("o_orderdate") >= F.lit(ORDERS_EPOCH + dt.timedelta(days=after_day + 1)))
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"
    )
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").cast("bigint").alias("customer_id"),
        F.col("l_partkey").cast("bigint").alias("item_id"),
        F.datediff(F.col("o_orderdate"), F.lit(ORDERS_EPOCH)).alias("day"),
        F.lit(2).alias("event_type"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("event_seq"),
        F.col("l_partkey").cast("bigint").alias("part_id"),
        F.col("l_suppkey").cast("bigint").alias("supplier_id"),
    )


def last_order_day(spark: SparkSession, folder: str) -> int:
    """Day of the latest order that has a line: no line needs its order's columns for that."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    latest = orders.join(lines, "o_orderkey", "left_semi").agg(F.max("o_orderdate")).first()[0]
    return ((latest.date() if isinstance(latest, dt.datetime) else latest) - ORDERS_EPOCH).days


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Item dimension from ``part``."""
    part = table(spark, folder, "part").select("p_partkey", "p_brand", "p_type", "p_retailprice")
    # the distinct types are few; their dense rank is the category id
    types = part.select("p_type").distinct()
    category = types.select(
        "p_type", (F.dense_rank().over(Window.orderBy("p_type")) - 1).alias("category_id")
    )
    return part.join(category, "p_type", "left").select(
        F.col("p_partkey").cast("bigint").alias("item_id"),
        "category_id",
        F.col("p_type").alias("category_name"),
        F.substring_index("p_brand", "#", -1).cast("int").alias("brand_id"),
        F.col("p_retailprice").alias("price"),
        F.col("p_type").isin("ECONOMY", "SMALL", "STANDARD").alias("is_replenishable"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").cast("bigint").alias("customer_id"),
        F.col("c_nationkey").alias("home_nation_id"),
        F.col("c_mktsegment").alias("segment"),
    )


def item_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").cast("bigint").alias("item_id"),
        F.transform("embedding", lambda x: x.cast("double")).alias("vector"),
    )


def model_calls(spark: SparkSession, folder: str) -> DataFrame:
    """One row per assistant turn that answers a user turn.

    The partner turn is found by an equality join on (conversation, turn), so
    a long conversation is spread over the tasks.
    """
    turns = table(spark, folder, "conversations")
    asked = turns.filter(F.col("role") == "user").select(
        "conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("question")
    )
    return turns.filter(F.col("role") == "assistant").join(asked, ["conv_id", "turn"]).select(
        "conv_id", "turn", "question", F.col("text").alias("reply"),
        F.length("text").cast("double").alias("latency_ms"),
    )


def with_revenue(interactions: DataFrame, items: DataFrame) -> DataFrame:
    """quantity x price."""
    priced = interactions.join(items.select("item_id", "price"), "item_id", "left")
    return priced.withColumn("revenue", F.col("quantity") * F.col("price"))
