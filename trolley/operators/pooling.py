"""Candidate pooling, labelling and stage diagnostics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.operators.features import SOURCES

# List length per source.
PER_SOURCE = {"repeat": 60, "two_tower": 120, "item_knn": 60, "popularity": 20}


def candidate_pool(
    sources: dict[str, DataFrame], max_per_source: dict[str, int] | None = None, names: tuple[str, ...] = SOURCES
) -> DataFrame:
    """Union of the ranked lists on (customer, item), one column group per source.

    The lists are stacked and pivoted by one aggregation, which costs one
    shuffle instead of one per outer join.
    """
    limits = PER_SOURCE if max_per_source is None else max_per_source
    stacked = None
    for name, df in sources.items():
        part = df.filter(F.col("rank") < limits[name]) if name in limits else df
        part = part.select("customer_id", "item_id", F.lit(name).alias("source"), "rank", "score")
        stacked = part if stacked is None else stacked.unionByName(part)
    aggs = []
    for name in names:
        mine = F.col("source") == name
        aggs += [
            F.coalesce(F.max(F.when(mine, F.col("rank"))), F.lit(-1)).cast("int").alias(f"rank_{name}"),
            F.coalesce(F.max(F.when(mine, F.col("score"))), F.lit(0.0)).alias(f"score_{name}"),
        ]
    wide = stacked.groupBy("customer_id", "item_id").agg(*aggs)
    for name in names:
        rank = F.col(f"rank_{name}")
        wide = wide.withColumns({
            f"in_{name}": (rank >= 0).cast("int"),
            f"rr_{name}": F.when(rank >= 0, F.lit(1.0) / (rank + 1)).otherwise(F.lit(0.0)),
        })
    return wide.withColumn("n_sources", sum((F.col(f"in_{n}") for n in names), F.lit(0)))


def attach_labels(frame: DataFrame, truth: DataFrame) -> DataFrame:
    """label = 1 when the customer bought the item in the held-out window."""
    hit = truth.select("customer_id", "item_id").distinct().withColumn("_hit", F.lit(True))
    return frame.join(hit, ["customer_id", "item_id"], "left").withColumn(
        "label", F.col("_hit").isNotNull().cast("int")
    ).drop("_hit")


def group_sizes(frame: DataFrame) -> DataFrame:
    return frame.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_candidates"))


def candidate_diagnostics(labelled: DataFrame, truth: DataFrame) -> DataFrame:
    """Rows, customers, candidates per customer, positive rate, coverage and recall ceiling over all customers."""
    per_customer = labelled.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("hits")
    )
    wanted = truth.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_truth"))
    both = per_customer.join(wanted, "customer_id", "full")
    n = F.coalesce(F.col("n"), F.lit(0))
    hits = F.coalesce(F.col("hits"), F.lit(0))
    served = F.count("n")
    return both.agg(
        F.sum(n).alias("rows"),
        served.alias("customers"),
        (F.sum(n) / served).alias("candidates_per_customer"),
        (F.sum(hits) / F.sum(n)).alias("positive_rate"),
        (F.sum((hits > 0).cast("int")) / served).alias("customer_coverage"),
        F.avg(F.when(F.col("n_truth").isNotNull(), hits / F.col("n_truth"))).alias("recall_ceiling"),
    )


def ordered_frame(frame: DataFrame) -> DataFrame:
    """Rows of a customer together and in item order inside each partition (K4)."""
    return frame.repartition("customer_id").sortWithinPartitions("customer_id", "item_id")
