"""The tables of one evaluation setting: a log, its split, its catalog and the held-out truth."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.operators import cells, features, pooling, retrieval, split, vectors
from trolley.operators.pairs import bought_pairs, pair_aggregate
from trolley.session import stage
from trolley.sources import tables

# Transparent scoring weights for the slates that are compared with SQL.
LINEAR_WEIGHTS = {
    "rr_repeat": 1.0, "rr_item_knn": 0.8, "rr_two_tower": 0.6, "rr_popularity": 0.2,
    "is_known_item": 0.3, "uc_share": 0.5, "ub_share": 0.2,
}


@dataclass
class Setting:
    """Interactions of the ``events`` table, cut by the default split.

    Tables that several steps read (held-out customers, pair aggregate, user
    vectors, candidate pool) are written out once by ``stage``.
    """

    spark: SparkSession
    folder: str
    # vector search of the candidate lists: "bounds" (exact, cells whose bound rules them out are not read) or "all" items
    search: str = "bounds"
    _staged: dict = field(default_factory=dict, repr=False)

    def once(self, name: str, day: int, make) -> DataFrame:
        """``make()`` written out, once per name and day."""
        if (name, day) not in self._staged:
            self._staged[name, day] = stage(make(), name)
        return self._staged[name, day]

    @cached_property
    def days(self) -> tuple[int, int]:
        return split.split_days(self.log())

    @property
    def train_end(self) -> int:
        return self.days[0]

    @property
    def valid_end(self) -> int:
        return self.days[1]

    def log(self, as_of_day: int | None = None, after_day: int | None = None) -> DataFrame:
        return tables.interactions_from_events(self.spark, self.folder, as_of_day, after_day)

    @cached_property
    def train(self) -> DataFrame:
        return self.log(as_of_day=self.train_end)

    @cached_property
    def history(self) -> DataFrame:
        """Everything before the test window."""
        return self.log(as_of_day=self.valid_end)

    @cached_property
    def items(self) -> DataFrame:
        return tables.catalog(self.spark, self.folder)

    @cached_property
    def vectors(self) -> DataFrame:
        return tables.item_vectors(self.spark, self.folder)

    @cached_property
    def eligible(self) -> DataFrame:
        return split.eligible_customers(self.train)

    def pairs(self, as_of_day: int | None = None) -> DataFrame:
        """Pair aggregate up to a day, the end of the train window by default: one pass over the log per day, written out."""
        day = self.train_end if as_of_day is None else as_of_day
        return self.once("pairs", day, lambda: pair_aggregate(self.log(as_of_day=day), day))

    def truth(self, window: str = "test") -> DataFrame:
        if window == "test":
            rows = self.log(after_day=self.valid_end)
        else:
            rows = self.log(as_of_day=self.valid_end, after_day=self.train_end)
        return split.ground_truth(rows, self.eligible)

    @cached_property
    def test_truth(self) -> DataFrame:
        return stage(self.truth(), "truth")

    @property
    def asked(self) -> DataFrame:
        """Customers with held-out purchases."""
        return self.test_truth.select("customer_id").distinct()

    def user_vectors(self, as_of_day: int, asked: DataFrame) -> DataFrame:
        users = vectors.pooled_user_vectors(self.log(as_of_day=as_of_day), self.vectors)
        return stage(users.join(asked, "customer_id", "left_semi"), "users")

    def nearest(self, users: DataFrame, k: int) -> DataFrame:
        """Best items per customer by cosine; both ways list the same."""
        if self.search == "all":
            return vectors.vector_topk(users, self.vectors, k)
        asked = users.select(F.col("customer_id").alias("query_id"), "vector")
        found = cells.pruned_topk(asked, self.vectors, k)
        return found.withColumnRenamed("query_id", "customer_id").select("customer_id", "item_id", "rank", "score")

    def sources(self, pairs: DataFrame, as_of_day: int, asked: DataFrame) -> dict[str, DataFrame]:
        """The four candidate lists, all fitted on the log up to ``as_of_day``."""
        depth = pooling.PER_SOURCE
        return {
            "repeat": retrieval.repeat_purchase(pairs, asked, depth["repeat"]),
            "two_tower": self.nearest(self.user_vectors(as_of_day, asked), depth["two_tower"]),
            "item_knn": retrieval.item_knn(pairs, self.items, asked, depth["item_knn"]),
            "popularity": retrieval.popularity_topk(pairs, self.items, asked, depth["popularity"]),
        }

    def pool(self, as_of_day: int, asked: DataFrame) -> DataFrame:
        return pooling.candidate_pool(self.sources(self.pairs(as_of_day), as_of_day, asked))

    def feature_frame(self, as_of_day: int, asked: DataFrame) -> DataFrame:
        """Features of the pooled candidates of ``asked`` customers."""
        pairs = self.pairs(as_of_day)
        pool = stage(pooling.candidate_pool(self.sources(pairs, as_of_day, asked)), "pool")
        return features.FeatureStore.from_pairs(pairs, self.items, as_of_day).transform(pool)

    def labelled(self, window: str = "test") -> DataFrame:
        """Labelled feature frame of the test stage, or of the train stage on the validation week."""
        truth = self.test_truth if window == "test" else stage(self.truth(window), "truth")
        day = self.valid_end if window == "test" else self.train_end
        frame = self.feature_frame(day, truth.select("customer_id").distinct())
        return pooling.attach_labels(frame, truth)

    def base_popularity(self, pairs: DataFrame) -> DataFrame:
        """Smoothed purchase share per catalog item."""
        counts = bought_pairs(pairs).groupBy("item_id").agg(F.sum("n_purchase").alias("n"))
        total = counts.agg(F.sum("n")).scalar()
        n_items = self.items.agg(F.count(F.lit(1))).scalar()
        return self.items.select("item_id").join(counts, "item_id", "left").select(
            "item_id", ((F.coalesce("n", F.lit(0)) + 1) / (total + n_items)).alias("base_popularity")
        )


class OrdersSetting(Setting):
    """Purchases of ``orders`` and ``lineitem``, cut by 90-day windows."""

    WINDOW = 90

    @cached_property
    def days(self) -> tuple[int, int]:
        valid_end = tables.last_order_day(self.spark, self.folder) - self.WINDOW
        return valid_end - self.WINDOW, valid_end

    def log(self, as_of_day: int | None = None, after_day: int | None = None) -> DataFrame:
        return tables.purchases_from_orders(self.spark, self.folder, as_of_day, after_day)
