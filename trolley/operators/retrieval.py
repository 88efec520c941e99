"""Candidate retrievers.

Every retriever returns (customer_id, item_id, rank, score) with a 0-based
rank. What a retriever is fitted on is the pair aggregate of the log up to the
wanted day; several retrievers share one.
"""

from __future__ import annotations

from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.functions.expressions import best_first, score_key
from trolley.operators.knn import best_items
from trolley.operators.pairs import HALF_LIFE, POPULARITY_HALF_LIFE, bought_pairs, reanchored
from trolley.operators.similarity import NEIGHBOURS, SEGMENT, SHRINKAGE, item_similarity
from trolley.operators.vectors import block_topk
from trolley.session import stage, use_checkpoints

RRF_K = 60.0
# Fusion weights of the evaluated blend.
BLEND_WEIGHTS = {"repeat": 1.0, "item_knn": 0.8, "als": 0.8}


def item_popularity(pairs: DataFrame, items: DataFrame, half_life: float = POPULARITY_HALF_LIFE) -> DataFrame:
    """Recency-weighted purchase count of every catalog item, zero when unsold; decay starts at the last purchase."""
    anchor = pairs.agg(F.max("last_purchase")).scalar()
    weight = bought_pairs(pairs).groupBy("item_id").agg(F.sum(reanchored("popular_w", anchor, half_life)).alias("w"))
    return items.select("item_id").join(weight, "item_id", "left").select(
        "item_id", F.coalesce("w", F.lit(0.0)).alias("score")
    )


def popularity_slate(popularity: DataFrame, k: int) -> Column:
    """The k most popular items as one array of (rank, item_id, score), a scalar subquery of k entries."""
    top = popularity.orderBy(score_key(F.col("score")).desc(), "item_id").limit(k)
    packed = top.agg(F.sort_array(F.collect_list(F.struct(
        (-score_key(F.col("score"))).alias("key"), "item_id", "score"
    ))).alias("top"))
    return packed.select(F.transform("top", lambda s, i: F.struct(
        i.alias("rank"), s["item_id"].alias("item_id"), s["score"].alias("score")
    ))).scalar()


def popularity_topk(pairs: DataFrame, items: DataFrame, customers: DataFrame, k: int) -> DataFrame:
    """The same list for every customer."""
    slate = popularity_slate(item_popularity(pairs, items), k)
    return customers.select("customer_id", slate.alias("slate")).select("customer_id", F.inline("slate")).select(
        "customer_id", "item_id", "rank", "score"
    )


def repeat_purchase(pairs: DataFrame, customers: DataFrame, k: int, half_life: float = HALF_LIFE) -> DataFrame:
    """A customer's own items by decayed purchase count, without backfill."""
    anchor = pairs.agg(F.max("last_purchase")).scalar()
    own = bought_pairs(pairs).join(customers.select("customer_id"), "customer_id", "left_semi").select(
        "customer_id", "item_id", reanchored("repeat_w", anchor, half_life).alias("score")
    )
    return best_first(own, ["customer_id"], k).select("customer_id", "item_id", "rank", "score")


def repeat_backfill(
    pairs: DataFrame, items: DataFrame, customers: DataFrame, k: int, half_life: float = HALF_LIFE
) -> DataFrame:
    """The repeat list, filled up to k with popular items that are not already in it.

    The k most popular items are enough: at most n_own of them are own items,
    which leaves the k - n_own that are needed. Filler has score 0.
    """
    own = (
        repeat_purchase(pairs, customers, k, half_life).groupBy("customer_id")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "item_id", "score"))).alias("own"))
    )
    slate = popularity_slate(item_popularity(pairs, items), k)
    empty = F.array().cast("array<struct<rank:int,item_id:int,score:double>>")
    packed = customers.select("customer_id").join(own, "customer_id", "left").select(
        "customer_id", F.coalesce("own", empty).alias("own"), slate.alias("popular")
    )
    extra = F.filter("popular", lambda s: ~F.array_contains(F.col("own.item_id"), s["item_id"]))
    filler = F.transform(
        F.slice(F.col("extra"), F.lit(1), F.lit(k) - F.size("own")),
        lambda s, i: F.struct(
            (F.size("own") + i).alias("rank"), s["item_id"].alias("item_id"), F.lit(0.0).alias("score")
        ),
    )
    return (
        packed.withColumn("extra", extra)
        .select("customer_id", F.inline(F.concat("own", filler)))
        .select("customer_id", "item_id", "rank", "score")
    )


def interaction_matrix(pairs: DataFrame, half_life: float = HALF_LIFE) -> DataFrame:
    """Implicit weights per (customer, item): event weight x recency decay, summed (A6); decay starts at the last event."""
    anchor = pairs.agg(F.max("last_day")).scalar()
    return pairs.select("customer_id", "item_id", reanchored("implicit_w", anchor, half_life).alias("r"))


def item_knn(
    pairs: DataFrame, items: DataFrame, customers: DataFrame, k: int,
    neighbours: int = NEIGHBOURS, shrinkage: float = SHRINKAGE, half_life: float = HALF_LIFE,
    segment: int = SEGMENT,
) -> DataFrame:
    """Sum of similarities from everything in the history; customers without a score get the popular list.

    Seen items stay in. Only positive scores are listed.
    """
    matrix = interaction_matrix(pairs, half_life)
    sim = item_similarity(matrix, neighbours, shrinkage, segment)
    asked = customers.select("customer_id").distinct()
    ranked = best_items(matrix.join(asked, "customer_id", "left_semi"), sim, k, neighbours)
    slate = popularity_slate(item_popularity(pairs, items), k)
    unserved = (
        asked.join(ranked.select("customer_id").distinct(), "customer_id", "left_anti")
        .select("customer_id", slate.alias("slate"))
        .select("customer_id", F.inline("slate"))
        .select("customer_id", "item_id", "rank", F.lit(0.0).alias("score"))
    )
    return ranked.unionByName(unserved)


def dense_ids(df: DataFrame, name: str) -> DataFrame:
    """``name`` and ``{name}_no``, its place from 0 among the distinct values, for models that take 32-bit ids only.

    A range partitioned sort, written once; the driver sees one row count per partition.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = stage(
        df.select(name).distinct().repartitionByRange(n, name).sortWithinPartitions(name)
        .withColumn("_id", F.monotonically_increasing_id()), "ids",
    )
    part = F.shiftrightunsigned("_id", 33)
    starts, total = [], 0
    sizes = {r[0]: r[1] for r in placed.groupBy(part).count().collect()}
    for p in range(max(sizes, default=-1) + 1):
        starts.append(total)
        total += sizes.get(p, 0)
    start = F.element_at(F.array(*[F.lit(x) for x in starts or [0]]), (part + 1).cast("int"))
    number = start + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.select(name, number.cast("int").alias(f"{name}_no"))


def als_factors(
    pairs: DataFrame, customers: DataFrame,
    factors: int = 64, regularization: float = 0.05, alpha: float = 12.0, iterations: int = 12,
    half_life: float = HALF_LIFE, seed: int = 7,
) -> tuple[DataFrame, DataFrame]:
    """Implicit matrix factorization: (query_id, vector) of the asked customers and (item_id, vector) of the items."""
    matrix = stage(interaction_matrix(pairs, half_life), "matrix")
    users_of, items_of = dense_ids(matrix, "customer_id"), dense_ids(matrix, "item_id")
    dense = matrix.join(users_of, "customer_id").join(items_of, "item_id").select("customer_id_no", "item_id_no", "r")
    use_checkpoints(pairs.sparkSession)
    model = ALS(
        rank=factors, regParam=regularization, alpha=alpha, maxIter=iterations, implicitPrefs=True, seed=seed,
        userCol="customer_id_no", itemCol="item_id_no", ratingCol="r", coldStartStrategy="drop",
    ).fit(dense)

    def as_double(col):
        return F.transform(col, lambda x: x.cast("double"))

    def named(factors, ids, name):
        return factors.join(ids, factors["id"] == ids[f"{name}_no"]).select(name, as_double("features").alias("vector"))

    users = named(model.userFactors, users_of, "customer_id").join(customers.select("customer_id"), "customer_id", "left_semi")
    return (
        stage(users.withColumnRenamed("customer_id", "query_id"), "user-factors"),
        stage(named(model.itemFactors, items_of, "item_id"), "item-factors"),
    )


def als_topk(pairs: DataFrame, customers: DataFrame, k: int, **settings) -> DataFrame:
    """Best items per customer by the product of the learned factors."""
    found = block_topk(*als_factors(pairs, customers, **settings), k)
    return found.select(F.col("query_id").alias("customer_id"), "item_id", "rank", "score")


def rrf_blend(lists: list[tuple[DataFrame, float]], k: int, k_rrf: float = RRF_K) -> DataFrame:
    """Reciprocal-rank fusion of the first 3k entries of each list: sum of w / (k_rrf + rank + 1)."""
    parts = [
        df.filter(F.col("rank") < 3 * k).select(
            "customer_id", "item_id", (F.lit(float(w)) / (F.lit(float(k_rrf)) + F.col("rank") + 1)).alias("s")
        )
        for df, w in lists
    ]
    pooled = parts[0]
    for part in parts[1:]:
        pooled = pooled.unionByName(part)
    fused = pooled.groupBy("customer_id", "item_id").agg(F.sum("s").alias("score"))
    return best_first(fused, ["customer_id"], k).select("customer_id", "item_id", "rank", "score")
