"""Connected components of a table of links, and a walk over sorted groups in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.session import stage


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """node, component (smallest node reachable) for every node of ``links`` (columns a, b).

    Alternating large and small stars: every node hangs its larger neighbours, then its smaller ones, under the smallest node
    it sees, until each component is a star. Both steps take a minimum per node, combined before the shuffle,
    and a join back that adaptive execution can split, so no neighbourhood is ever gathered. Each round is
    written to the shared folder.
    """
    edges = stage(links.where("a <> b").select(
        F.greatest("a", "b").cast("bigint").alias("a"), F.least("a", "b").cast("bigint").alias("b")).distinct(), name)
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).distinct())
        edges = stage(small, name)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each group as a table; the batches hold the groups one after the other."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in columns)
        starts = np.flatnonzero(change).tolist()
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        at = 0
        for s in starts:
            yield pa.Table.from_batches([*held, batch.slice(at, s - at)])
            held, at = [], s
        held.append(batch.slice(at))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


def block_pairs(rows: DataFrame, group: str, sizes: DataFrame, item: str, block: int) -> DataFrame:
    """Rows of each group dealt to blocks of about ``block`` rows, one copy for every pair of blocks (columns i <= j, own).

    ``sizes`` has ``group`` and ``size``. All pairs of rows of a group meet in some pair of blocks; a group that fits one
    block stays as it is.
    """
    blocks = F.ceil(F.col("size") / block).cast("int")
    rows = rows.join(sizes.select(group, "size"), group)
    rows = rows.withColumn("__n", blocks).withColumn("own", F.pmod(F.hash(item), F.col("__n")))
    rows = rows.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    return rows.withColumns({"i": F.least("own", "__other"), "j": F.greatest("own", "__other")}).drop("__n", "__other", "size")
