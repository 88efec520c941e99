"""Feature blocks as bucketed tables.

A day's blocks are shuffled once, when they are written: those of customers in ``buckets`` by customer, sorted. Every candidate frame of the day then
meets them where they lie; only the candidates move, once by item for the item block and once by customer for the other four.

Defined results: as ``FeatureStore.transform``. Blocks without rows keep their schema. Writing a day again replaces its blocks.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.operators.features import FeatureStore, finalise

BY_CUSTOMER = ("user_item", "user", "user_category", "user_brand")
ROWS_PER_BUCKET = 1_000_000


def buckets_for(rows: int, least: int = 8) -> int:
    """A power of two, so that stores of different sizes still fit each other's buckets."""
    return max(least, 1 << max(-(-rows // ROWS_PER_BUCKET) - 1, 0).bit_length())


@dataclass(frozen=True)
class BucketedBlocks:
    """Blocks of all days below ``root``; the number of buckets holds for the life of the store."""

    root: str
    buckets: int

    def _place(self, name: str, day: int) -> str:
        return f"{self.root}/as_of_day={day}/{name}"

    def _table(self, name: str, day: int) -> str:
        own = hashlib.md5(self.root.encode()).hexdigest()[:12]
        return f"blocks_{own}_{self.buckets}_{day}_{name}"

    def write(self, store: FeatureStore) -> None:
        day = store.as_of_day
        store.item.write.mode("overwrite").parquet(self._place("item", day))
        for name in BY_CUSTOMER:
            frame = getattr(store, name)
            # a table without rows has no files to read its columns from
            frame.limit(0).write.mode("overwrite").parquet(self._place(f"{name}-columns", day))
            # dealt as the buckets are, so that a bucket is one file
            (frame.repartition(self.buckets, "customer_id").write.mode("overwrite")
             .bucketBy(self.buckets, "customer_id").sortBy("customer_id")
             .option("path", self._place(name, day)).format("parquet").saveAsTable(self._table(name, day)))

    def read(self, spark: SparkSession, day: int) -> FeatureStore:
        """The blocks of a day; a session that has not written them itself takes them into its catalog."""
        blocks = {"item": spark.read.parquet(self._place("item", day))}
        for name in BY_CUSTOMER:
            table = self._table(name, day)
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(self._place(f"{name}-columns", day)).schema)
            spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet CLUSTERED BY (customer_id) SORTED BY (customer_id) "
                      f"INTO {self.buckets} BUCKETS LOCATION '{self._place(name, day)}'")
            spark.catalog.refreshTable(table)
            blocks[name] = spark.table(table)
        return FeatureStore(as_of_day=day, **blocks)


def transform(store: FeatureStore, candidates: DataFrame) -> DataFrame:
    """Features of (customer_id, item_id) candidates; the item block first, so that what follows stays dealt by customer.

    The customer block is next: its only key deals the candidates by customer, where the pair block would also take them dealt by item.
    """
    joined = (
        candidates.join(store.item, "item_id", "left")
        .join(store.user, "customer_id", "left")
        .join(store.user_item, ["customer_id", "item_id"], "left")
        .join(store.user_category, ["customer_id", "category_id"], "left")
        .join(store.user_brand, ["customer_id", "brand_id"], "left")
    )
    return finalise(joined).withColumn("as_of_day", F.lit(store.as_of_day))
