"""Sharding along a Hilbert curve over several metadata dimensions.

Every dimension is quantised to ``2**bits`` cells: numbers by their share of rows below (approximate quantiles of the whole
column), everything else by hash, as equality is all that a filter on it can use. The rows are sorted by the
index of their cell on the curve and cut into runs whose row counts differ by one at most, so that a shard covers a compact
region of all dimensions at once and min/max statistics per file prune on each of them.

The order is global: a range partitioned sort, ended by the row's id, size and checksum so that equal cells and copies spread over tasks.

Defined results: null metadata goes to cell 0. A null text has 0 bytes and the checksum of an empty text.
Repeated rows get a slot each. An empty table gives no rows. Rows with equal texts may part, as no law but ``rows`` is claimed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from trolley.llm.common import crc32_number, numbered, raw

OVERHEAD = 8


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells`` (rows x dimensions, values below ``2**bits``).

    The coordinates are turned to the transposed index by undoing, from the highest bit on, the reflections and
    exchanges of axes that each subcube applies; a Gray decode follows, and the bits are interleaved.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            reflect = (x[i] & q) != 0
            x[0] = np.where(reflect, x[0] ^ low, x[0])
            swap = np.where(reflect, 0, (x[0] ^ x[i]) & low)
            x[0] ^= swap
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn = np.where((x[n - 1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    index = np.zeros_like(turn)
    for b in reversed(range(bits)):
        for i in range(n):
            index = (index << 1) | ((x[i] >> b) & 1)
    return index


def quantised(df: DataFrame, dimensions: list[str], bits: int) -> list[Column]:
    """A column of cells per dimension."""
    cells = 1 << bits
    numeric = [d for d in dimensions if isinstance(df.schema[d].dataType, NumericType)]
    cuts = {}
    if numeric:
        shares = [i / cells for i in range(1, cells)]
        row = df.agg(*(F.percentile_approx(F.col(f"`{d}`").cast("double"), shares, 10_000).alias(f"q{i}")
                       for i, d in enumerate(numeric))).first()
        cuts = {d: row[f"q{i}"] or [] for i, d in enumerate(numeric)}
    found = []
    for d in dimensions:
        col = F.col(f"`{d}`")
        if d in cuts:
            cut = F.from_json(F.lit("[" + ",".join(repr(float(c)) for c in cuts[d]) + "]"), "array<double>")
            cell = F.size(F.filter(cut, lambda c, col=col: c < col.cast("double")))
        else:
            cell = F.pmod(F.xxhash64(col.cast("string")), F.lit(cells)).cast("int")
        found.append(F.when(col.isNull(), F.lit(0)).otherwise(cell))
    return found


def curve(df: DataFrame, dimensions: list[str], bits: int) -> Column:
    n = len(dimensions)
    if not 0 < n * bits < 63:
        raise ValueError("the index must fit in 62 bits")

    @F.pandas_udf("bigint")
    def index(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(hilbert_index(np.stack(part.to_numpy()), bits) if len(part) else [], dtype="int64")

    return index(F.array(*(c.cast("int") for c in quantised(df, dimensions, bits))))


def shard_by_curve(docs: DataFrame, dimensions: list[str], shards: int, bits: int = 6) -> DataFrame:
    """Per document: doc_id, size, text_crc32, the curve index, its shard and its slot there (both from 0)."""
    text = raw("text")
    rows = docs.select(
        F.col("doc_id"), (F.octet_length(text) + OVERHEAD).cast("bigint").alias("size"), crc32_number(text).alias("text_crc32"),
        curve(docs, dimensions, bits).alias("curve"))
    rows = numbered(rows, ["curve", "doc_id", "size", "text_crc32"], "shards")
    total = rows.count()
    few, longer = total // shards, total % shards
    # the first ``longer`` shards have one row more
    first = longer * (few + 1)
    at = F.col("at")
    if few:
        shard = F.when(at < first, F.expr(f"at div {few + 1}")).otherwise(F.lit(longer) + F.expr(f"(at - {first}) div {few}"))
        slot = F.when(at < first, at % (few + 1)).otherwise((at - first) % few)
    else:
        shard, slot = at, F.lit(0)
    return rows.select("doc_id", "size", "text_crc32", "curve", shard.cast("int").alias("shard"), slot.cast("bigint").alias("slot"))


def write_shards(docs: DataFrame, assigned: DataFrame, path: str) -> None:
    """One folder of files per shard, in slot order within a file. ``doc_id`` must tell the documents apart."""
    (docs.join(assigned.select("doc_id", "shard", "slot"), "doc_id").repartitionByRange("shard", "slot")
     .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))
