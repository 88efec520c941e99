"""Helpers that several operators of this package share."""

from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.session import stage

#: Low bits of ``monotonically_increasing_id`` that number the rows of a partition.
ROW_BITS = 33


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw(text: Column | str) -> Column:
    """UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce((F.col(text) if isinstance(text, str) else text).cast("string"), F.lit("")).cast("binary")


def sql_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def parts_for(spark: SparkSession, total_bytes: int | None, each: int) -> int:
    """Enough partitions that none holds much over ``each`` bytes, and no fewer than the session's."""
    return max(sql_partitions(spark), math.ceil((total_bytes or 0) / each), 1)


def numbered(df: DataFrame, keys: Iterable[Column | str], name: str, at: str = "at") -> DataFrame:
    """Rows in the global order of ``keys`` with their 0-based place in column ``at``.

    A range partitioned sort, written once; the places are the row numbers within the partitions plus
    the sizes of the partitions before, of which the driver sees one number per partition. Only rows
    that agree in all keys need to share a task, so end the keys with what tells rows apart.
    """
    keys = [F.col(k) if isinstance(k, str) else k for k in keys]
    spark = df.sparkSession
    mid = "__mid"
    ordered = stage(
        df.repartitionByRange(sql_partitions(spark), *keys).sortWithinPartitions(*keys)
        .withColumn(mid, F.monotonically_increasing_id()),
        name,
    )
    part = F.shiftrightunsigned(mid, ROW_BITS)
    sizes = {r[0]: r[1] for r in ordered.groupBy(part.alias("p")).count().collect()}
    starts, total = [], 0
    for p in range(max(sizes, default=-1) + 1):
        starts.append(total)
        total += sizes.get(p, 0)
    start = F.element_at(longs(starts or [0]), (part + 1).cast("int"))
    return ordered.withColumn(at, start + F.col(mid).bitwiseAND(F.lit((1 << ROW_BITS) - 1))).drop(mid)


def longs(values: Iterable[int]) -> Column:
    """A literal array of longs; the optimizer folds it to one constant."""
    return F.from_json(F.lit("[" + ",".join(str(int(v)) for v in values) + "]"), "array<bigint>")


def crc32_number(value: Column) -> Column:
    """Unsigned CRC-32."""
    return F.crc32(value)


# --- 64-bit hashing in numpy -------------------------------------------------------------------

#: Odd multipliers of the 64-bit finalizer (fixed values of the public splitmix64 generator).
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of uint64 values."""
    x = x + MIX[2]
    x ^= x >> np.uint64(30)
    x *= MIX[0]
    x ^= x >> np.uint64(27)
    x *= MIX[1]
    x ^= x >> np.uint64(31)
    return x


def packed(docs: DataFrame, *columns: Column, text: Column | None = None) -> DataFrame:
    """``columns`` and the UTF-8 bytes of the text, compressed (column ``packed``), for texts that must cross a shuffle."""
    import pyarrow as pa

    rows = docs.select(*columns, (raw("text") if text is None else text).alias("packed"))

    def squeeze(batches):
        import zstandard

        press = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            small = pa.array([press(t) for t in batch.column("packed").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], small], schema=batch.schema)

    return rows.mapInArrow(squeeze, rows.schema)


def unpacked(values: Iterable[bytes]) -> list[bytes]:
    import zstandard

    open_up = zstandard.ZstdDecompressor().decompress
    return [open_up(v) for v in values]
