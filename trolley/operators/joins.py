"""Salted equi-join (J2) for event-level joins with hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT_BUCKETS = 32


def salted_left_join(
    left: DataFrame, right: DataFrame, on: list[str], spread_by: list[Column], buckets: int = SALT_BUCKETS
) -> DataFrame:
    """Left join whose left rows are spread over ``buckets`` salts per key.

    The salt is a hash of other columns of the left row, not a random number:
    a task that runs again after a lost executor must place its rows alike.
    The right side, which should hold few rows per key, is repeated per salt.
    """
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(buckets)))
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return salted.join(repeated.withColumn("_salt", F.col("_salt").cast("long")), [*on, "_salt"], "left").drop("_salt")
