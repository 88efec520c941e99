"""Point-in-time feature blocks and the 42-column feature frame.

All five blocks derive from the pair aggregate, so the log is read once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trolley.operators.pairs import bought_pairs, pair_aggregate

# Candidate sources and the names of the feature contract.
SOURCES = ("repeat", "two_tower", "item_knn", "popularity")
FEATURE_COLUMNS = [
    "rr_repeat", "rr_two_tower", "rr_item_knn", "rr_popularity",
    "in_repeat", "in_two_tower", "in_item_knn", "in_popularity",
    "score_repeat", "score_two_tower", "score_item_knn", "score_popularity",
    "n_sources",
    "ui_n_purchase", "ui_n_cart", "ui_n_view", "ui_qty", "ui_days_since",
    "ui_mean_gap", "ui_due_ratio", "ui_cart_rate", "ui_purchase_rate",
    "u_n_purchase", "u_n_distinct", "u_mean_price", "u_days_since",
    "u_freq", "u_repeat_ratio", "u_n_categories",
    "uc_n", "uc_share", "uc_days_since", "ub_n", "ub_share",
    "i_pop", "i_n_buyers", "i_repeat_intensity", "i_log_price", "is_replenishable",
    "price_ratio", "is_known_item", "cat_due_ratio",
]
# Fixed values of the null policy.
NEVER_SEEN_DAYS, NO_GAP = 9999.0, -1.0


def user_item_features(pairs: DataFrame, as_of_day: int) -> DataFrame:
    span = F.greatest(F.col("last_day") - F.col("first_day"), F.lit(0))
    gap = F.when(F.col("n_purchase") > 1, span / F.col("n_purchase"))
    since = F.lit(as_of_day) - F.col("last_day")
    return pairs.select(
        "customer_id", "item_id",
        F.col("n_events").alias("ui_n_events"),
        F.col("last_day").alias("ui_last_day"),
        F.col("n_purchase").alias("ui_n_purchase"),
        F.col("n_cart").alias("ui_n_cart"),
        F.col("n_view").alias("ui_n_view"),
        F.col("qty").alias("ui_qty"),
        since.alias("ui_days_since"),
        gap.alias("ui_mean_gap"),
        F.try_divide(since, gap).alias("ui_due_ratio"),
        (F.col("n_cart") / F.col("n_events")).alias("ui_cart_rate"),
        (F.col("n_purchase") / F.col("n_events")).alias("ui_purchase_rate"),
    )


def _share(n: str) -> Column:
    # rows per customer are bounded by the categories or brands of the catalog
    return F.col(n) / F.sum(n).over(Window.partitionBy("customer_id"))


def user_category_totals(pairs: DataFrame, items: DataFrame) -> DataFrame:
    """Purchases per (customer, category): feeds both the category block and the customer block."""
    dim = items.select("item_id", "category_id", "price")
    n = F.col("n_purchase")
    return bought_pairs(pairs).join(dim, "item_id", "left").groupBy("customer_id", "category_id").agg(
        F.sum("n_purchase").alias("n"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.max("last_purchase").alias("last_purchase"),
        F.min("first_purchase").alias("first_purchase"),
        F.sum(F.col("price") * n).alias("spend"),
        F.sum(F.when(F.col("price").isNotNull(), n)).alias("n_priced"),
        F.max("price").alias("max_price"),
    )


def user_features(category_totals: DataFrame, as_of_day: int) -> DataFrame:
    per_user = category_totals.groupBy("customer_id").agg(
        F.sum("n").alias("u_n_purchase"),
        F.sum("n_distinct").alias("u_n_distinct"),
        F.try_divide(F.sum("spend"), F.sum("n_priced")).alias("u_mean_price"),
        F.max("max_price").alias("u_max_price"),
        F.count("category_id").alias("u_n_categories"),
        F.max("last_purchase").alias("last_purchase"),
        F.min("first_purchase").alias("first_purchase"),
    )
    active = F.greatest(F.col("last_purchase") - F.col("first_purchase"), F.lit(1))
    return per_user.select(
        "customer_id", "u_n_purchase", "u_n_distinct", "u_mean_price", "u_max_price", "u_n_categories",
        (F.lit(as_of_day) - F.col("last_purchase")).alias("u_days_since"),
        active.alias("u_active_days"),
        (F.col("u_n_purchase") / active).alias("u_freq"),
        (F.lit(1.0) - F.col("u_n_distinct") / F.col("u_n_purchase")).alias("u_repeat_ratio"),
    )


def user_category_affinity(category_totals: DataFrame, as_of_day: int) -> DataFrame:
    return category_totals.select(
        "customer_id", "category_id",
        F.col("n").alias("uc_n"),
        _share("n").alias("uc_share"),
        (F.lit(as_of_day) - F.col("last_purchase")).alias("uc_days_since"),
    )


def user_brand_affinity(pairs: DataFrame, items: DataFrame) -> DataFrame:
    totals = (
        bought_pairs(pairs).join(items.select("item_id", "brand_id"), "item_id", "left")
        .groupBy("customer_id", "brand_id").agg(F.sum("n_purchase").alias("ub_n"))
    )
    return totals.withColumn("ub_share", _share("ub_n"))


def item_features(pairs: DataFrame, items: DataFrame) -> DataFrame:
    stats = bought_pairs(pairs).groupBy("item_id").agg(
        F.sum("popular_w").alias("pop"),
        F.count(F.lit(1)).alias("buyers"),
        F.sum("n_purchase").alias("events"),
    )
    pop = F.coalesce(F.col("pop"), F.lit(0.0))
    buyers = F.coalesce(F.col("buyers"), F.lit(0))
    events = F.coalesce(F.col("events"), F.lit(0))
    return items.join(stats, "item_id", "left").select(
        "item_id", "price", "category_id", "brand_id",
        F.col("is_replenishable").cast("int").alias("is_replenishable"),
        F.log1p(pop).alias("i_pop"),
        F.log1p(buyers.cast("double")).alias("i_n_buyers"),
        (events / F.greatest(buyers, F.lit(1))).alias("i_repeat_intensity"),
        F.log1p("price").alias("i_log_price"),
    )


@dataclass
class FeatureStore:
    """The five blocks of one point in time; offline training and batch scoring share ``transform``."""

    item: DataFrame
    user_item: DataFrame
    user: DataFrame
    user_category: DataFrame
    user_brand: DataFrame
    as_of_day: int

    @classmethod
    def build(cls, history: DataFrame, items: DataFrame, as_of_day: int) -> "FeatureStore":
        return cls.from_pairs(pair_aggregate(history, as_of_day), items, as_of_day)

    @classmethod
    def from_pairs(cls, pairs: DataFrame, items: DataFrame, as_of_day: int) -> "FeatureStore":
        """Blocks from an existing pair aggregate, best one that was written out before."""
        totals = user_category_totals(pairs, items)
        return cls(
            item=item_features(pairs, items),
            user_item=user_item_features(pairs, as_of_day),
            user=user_features(totals, as_of_day),
            user_category=user_category_affinity(totals, as_of_day),
            user_brand=user_brand_affinity(pairs, items),
            as_of_day=as_of_day,
        )

    def transform(self, candidates: DataFrame) -> DataFrame:
        """Left-join every block onto (customer_id, item_id) candidates.

        The item block goes first, as it supplies category and brand, then the
        customer block: its only key deals the candidates by customer, and
        the last three joins keep them there. So the candidates move twice.
        A candidate frame is even by customer, since its rows per customer
        are bounded by the list lengths. No broadcast is forced: the planner
        broadcasts a block while it is below the size threshold and shuffles
        it beyond.
        """
        joined = (
            candidates.join(self.item, "item_id", "left")
            .join(self.user, "customer_id", "left")
            .join(self.user_item, ["customer_id", "item_id"], "left")
            .join(self.user_category, ["customer_id", "category_id"], "left")
            .join(self.user_brand, ["customer_id", "brand_id"], "left")
        )
        keys = ["customer_id", "item_id", "category_id", "brand_id"]
        blocks = (candidates, self.user_item, self.item, self.user, self.user_category, self.user_brand)
        own = [c for block in blocks for c in block.columns if c not in keys]
        joined = joined.select("customer_id", "brand_id", "category_id", "item_id", *own)
        return finalise(joined).withColumn("as_of_day", F.lit(self.as_of_day))


def finalise(frame: DataFrame) -> DataFrame:
    """Derived columns, then the null policy: counts 0, recency "infinitely long ago", gap -1."""
    zero = ["ui_n_purchase", "ui_n_cart", "ui_n_view", "ui_qty", "uc_n", "ub_n"]
    zero_double = ["uc_share", "ub_share", "ui_due_ratio"]
    never = ["ui_days_since", "uc_days_since"]
    known = (F.coalesce(F.col("ui_n_purchase"), F.lit(0)) > 0).cast("int")
    return frame.withColumns({
        "is_known_item": known,
        "price_ratio": F.try_divide(F.col("price"), F.col("u_mean_price")),
        "cat_due_ratio": F.col("uc_days_since") / F.greatest(F.col("uc_n"), F.lit(1)),
    }).withColumns({
        **{c: F.coalesce(F.col(c), F.lit(0)) for c in zero},
        **{c: F.coalesce(F.col(c), F.lit(0.0)) for c in zero_double},
        **{c: F.coalesce(F.col(c).cast("double"), F.lit(NEVER_SEEN_DAYS)) for c in never},
        "ui_mean_gap": F.coalesce(F.col("ui_mean_gap"), F.lit(NO_GAP)),
    })


def feature_frame(candidates: DataFrame, history: DataFrame, items: DataFrame, as_of_day: int) -> DataFrame:
    """Features of (customer_id, item_id) candidates; fails when ``history`` is later than ``as_of_day``."""
    return FeatureStore.build(history, items, as_of_day).transform(candidates)
