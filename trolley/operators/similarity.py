"""Item similarity as sparse block products.

Items are dealt to blocks. A customer's row meets a block once: the cells that lie in the block against the whole row, as arrays. A task
takes the rows of one block, multiplies and sums them in numpy and keeps the best neighbours of the block's items, so that what is shuffled is
a short array per customer and block, never a row per pair of cells, and an item's list is final where it is made.

Two kinds of heavy input are cut. A long row falls into segments of ``segment`` cells, a record per pair of segments and block. A block that
hot items make heavy is cut into slices of about ``PAIRS`` products by customer; only for these partial sums leave a task and are added up by Spark.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.functions.expressions import best_first
from trolley.session import stage

NEIGHBOURS, SHRINKAGE = 200, 25.0
SEGMENT = 256
#: Products of a task: so many cells of a block's items times cells of their rows.
PAIRS = 4_000_000


def _segments(matrix: DataFrame, segment: int) -> DataFrame:
    """Matrix rows cut into segments of about ``segment`` items, a written table: customer_id, n (cells of the row), n_seg, seg, and
    items, rs, norms as arrays."""
    sizes = matrix.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    packed = (
        matrix.join(sizes, "customer_id")
        .withColumn("n_seg", F.ceil(F.col("n") / F.lit(segment)).cast("long"))
        .withColumn("seg", F.pmod(F.xxhash64("item_id"), F.col("n_seg")))
        # the join leaves a customer's whole row in one task; its segments part here
        .repartition("customer_id", "seg")
        .groupBy("customer_id", "n", "n_seg", "seg")
        .agg(F.sort_array(F.collect_list(F.struct(F.col("item_id").cast("long").alias("item_id"), "r", "norm"))).alias("cells"))
    )
    return stage(packed.select("customer_id", "n", "n_seg", "seg", F.col("cells.item_id").alias("items"), F.col("cells.r").alias("rs"),
                               F.col("cells.norm").alias("norms")), "matrix-segments")


def _facing(segments: DataFrame) -> DataFrame:
    """Every segment of a row against every segment of it: customer_id and the arrays of both sides."""
    left = segments.select("customer_id", "n_seg", "seg", *[F.col(c).alias(f"l_{c}") for c in ("items", "rs", "norms")])
    whole = left.where("n_seg = 1")
    alone = whole.select("customer_id", F.lit(0).cast("long").alias("other"), *[f"l_{c}" for c in ("items", "rs", "norms")],
                         *[F.col(f"l_{c}").alias(c) for c in ("items", "rs", "norms")])
    long_rows = left.where("n_seg > 1").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_seg") - 1)))
    right = segments.where("n_seg > 1").select("customer_id", F.col("seg").alias("other"), "items", "rs", "norms")
    both = long_rows.join(right, ["customer_id", "other"]).select(alone.columns)
    return alone.unionByName(both)


def mixed(ids: np.ndarray) -> np.ndarray:
    """Scrambled ids (a multiplicative hash), so that neighbouring ids part."""
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _block(items: np.ndarray, blocks: int) -> np.ndarray:
    return (mixed(items) % np.uint64(blocks)).astype(np.int64)


RECORD = ("block int, slice int, l_items array<bigint>, l_rs array<double>, items array<bigint>, rs array<double>, norms array<double>, "
          "l_norms array<double>")
FOUND = "item_i bigint, item_j bigint, value double, norms double, rank int"


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column, one after the other, and the length of each list."""
    return np.array(column.flatten()), np.diff(np.array(column.offsets))


def _plain(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    # without the offset of a slice
    return pa.concat_arrays([column]) if column.offset else column


def _records(facing: DataFrame, blocks: int, slices: list[int]) -> DataFrame:
    """The cells of a left side by block, each with the whole right side."""
    many = np.array(slices, np.int64)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            items, size = _lists(_plain(batch.column("l_items")))
            rs, norms = (np.array(_plain(batch.column(c)).flatten()) for c in ("l_rs", "l_norms"))
            row = np.repeat(np.arange(len(size)), size)
            block = _block(items, blocks)
            order = np.lexsort((items, block, row))
            row, block = row[order], block[order]
            first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (block[1:] != block[:-1])])
            offsets = pa.array(np.r_[first, len(row)].astype(np.int32))
            own = row[first]
            customer = np.array(batch.column("customer_id")).astype(np.int64) * 31 + np.array(batch.column("other"))
            turn = ((mixed(customer) >> np.uint64(20)).astype(np.int64)[own] % many[block[first]]).astype(np.int32)
            take = pa.array(own)
            yield pa.RecordBatch.from_arrays([
                pa.array(block[first].astype(np.int32)), pa.array(turn),
                pa.ListArray.from_arrays(offsets, pa.array(items[order])), pa.ListArray.from_arrays(offsets, pa.array(rs[order])),
                *(batch.column(c).take(take) for c in ("items", "rs", "norms")), pa.ListArray.from_arrays(offsets, pa.array(norms[order]))],
                ["block", "slice", "l_items", "l_rs", "items", "rs", "norms", "l_norms"])

    return facing.mapInArrow(part, RECORD)


def products(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sums over the records of a group: item_i, item_j, co-occurrence and product of norms, by pair, an item with itself left out."""
    left, n_left = _lists(_plain(group.column("l_items")))
    right, n_right = _lists(_plain(group.column("items")))
    l_r, l_norm, r_r, r_norm = (np.array(_plain(group.column(c)).flatten()) for c in ("l_rs", "l_norms", "rs", "norms"))
    names_l, at_l = np.unique(left, return_inverse=True)
    names_r, at_r = np.unique(right, return_inverse=True)
    norm_l, norm_r = np.zeros(len(names_l)), np.zeros(len(names_r))
    norm_l[at_l], norm_r[at_r] = l_norm, r_norm
    # every left cell against the right cells of its record
    width = np.repeat(n_right, n_left)
    start = np.repeat(np.cumsum(n_right) - n_right, n_left)
    l = np.repeat(np.arange(len(left)), width)
    r = np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width, width) + np.repeat(start, width)
    key = at_l[l] * len(names_r) + at_r[r]
    value = l_r[l] * r_r[r]
    if len(names_l) * len(names_r) <= 4 * len(key):
        total = np.bincount(key, value, len(names_l) * len(names_r))
        pairs = np.flatnonzero(total)
        total = total[pairs]
    else:
        pairs, back = np.unique(key, return_inverse=True)
        total = np.bincount(back, value, len(pairs))
    i, j = pairs // len(names_r), pairs % len(names_r)
    other = names_l[i] != names_r[j]
    i, j, total = i[other], j[other], total[other]
    return names_l[i], names_r[j], total, norm_l[i] * norm_r[j]


def best_of(item: np.ndarray, other: np.ndarray, sim: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the ``k`` best rows per item, compared in whole billionths, ties to the smaller id, and their ranks."""
    order = np.lexsort((other, -np.rint(sim * 1e9), item))
    first = np.flatnonzero(np.r_[True, item[order][1:] != item[order][:-1]]) if len(order) else np.zeros(0, int)
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
    keep = rank < k
    return order[keep], rank[keep]


def weights_of_blocks(segments: DataFrame, blocks: int) -> DataFrame:
    """Products of each block: for every cell of its items, the length of the cell's row."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(blocks, np.int64)
        for batch in batches:
            items, size = _lists(_plain(batch.column("items")))
            np.add.at(total, _block(items, blocks), np.repeat(np.array(batch.column("n")), size))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(blocks)), pa.array(total)], ["block", "weight"])

    return segments.select("items", "n").mapInArrow(dealt, "block bigint, weight bigint").groupBy("block").agg(F.sum("weight").alias("weight"))


def item_similarity(
    matrix: DataFrame, neighbours: int = NEIGHBOURS, shrinkage: float = SHRINKAGE, segment: int = SEGMENT, pairs: int = PAIRS,
) -> DataFrame:
    """Shrunk cosine similarity, the ``neighbours`` best per item: (item_i, item_j, sim, rank)."""
    spark = matrix.sparkSession
    item_kind = dict(matrix.dtypes)["item_id"]
    norms = matrix.groupBy("item_id").agg((F.sqrt(F.sum(F.col("r") * F.col("r"))) + 1e-8).alias("norm"))
    segments = _segments(matrix.join(norms, "item_id"), segment)
    total = segments.agg(F.sum(F.col("n") * F.size("items"))).first()[0] or 0
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(tasks, math.ceil(total / pairs), 1)
    # one number per block
    weight = {r["block"]: r["weight"] for r in weights_of_blocks(segments, blocks).collect()}
    slices = [max(1, math.ceil(weight.get(b, 0) / (2 * pairs))) for b in range(blocks)]
    records = _records(_facing(segments), blocks, slices)

    def multiply(group: pa.Table) -> pa.Table:
        i, j, co, both = products(group)
        if slices[group.column("block")[0].as_py()] > 1:
            return pa.table({"item_i": i, "item_j": j, "value": co, "norms": both, "rank": pa.nulls(len(i), pa.int32())})
        sim = co / (both + shrinkage)
        some = sim > 0
        i, j, sim, both = i[some], j[some], sim[some], both[some]
        at, rank = best_of(i, j, sim, neighbours)
        return pa.table({"item_i": i[at], "item_j": j[at], "value": sim[at], "norms": both[at], "rank": rank.astype(np.int32)})

    found = records.repartition(sum(slices), "block", "slice").groupBy("block", "slice").applyInArrow(multiply, FOUND)
    out = ["item_i", "item_j", "sim", "rank"]
    ids = [F.col(c).cast(item_kind).alias(c) for c in ("item_i", "item_j")]
    if max(slices) == 1:
        return found.select(*ids, F.col("value").alias("sim"), "rank")
    split = found.where("rank is null").groupBy("item_i", "item_j").agg(F.sum("value").alias("co"), F.max("norms").alias("norms"))
    split = split.select("item_i", "item_j", (F.col("co") / (F.col("norms") + F.lit(shrinkage))).alias("sim")).where("sim > 0")
    ready = found.where("rank is not null").select("item_i", "item_j", F.col("value").alias("sim"), "rank")
    both = ready.unionByName(best_first(split, ["item_i"], neighbours, "sim", "item_j").select(out))
    return both.select(*ids, "sim", "rank")
