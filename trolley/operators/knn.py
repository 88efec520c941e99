"""Customer side of the nearest-neighbour lists (R4): summed similarities in numpy, the best k per customer.

Customers are dealt to blocks, a task each. A block gets the similar items of what its customers have in their history, once each, then its customers
row by row. The sums of a customer are made and cut to k there: neither a row per history item and similar item nor a row per score is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.operators.vectors import k_best
from trolley.session import stage

#: Entries of similar items that a block holds at most, history rows of a block whose items all fit in, products made at once.
HELD, ROWS, PRODUCTS = 6_500_000, 1_000_000, 2_000_000
STEPS = 4


class _Similar:
    """Similar items by item, their ids as places among the distinct ones."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]):
        item, size, others, self.sims = (np.concatenate(x) for x in zip(*parts))
        self.names, self.other = np.unique(others, return_inverse=True)
        start = np.cumsum(size) - size
        order = np.argsort(item, kind="stable")
        self.item, self.size, self.start = item[order], size[order], start[order]

    def place(self, item: np.ndarray) -> np.ndarray:
        """Place of each item, -1 where it has no similar ones."""
        at = np.minimum(np.searchsorted(self.item, item), len(self.item) - 1)
        return np.where(self.item[at] == item, at, -1)

    def sums(self, customer: np.ndarray, at: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """customer, place of the similar item and sum, by customer; ``customer`` counts from 0 in order."""
        width, many = self.size[at], len(self.names)
        entry = np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width - self.start[at], width)
        key = np.repeat(customer, width) * many + self.other[entry]
        value = np.repeat(r, width) * self.sims[entry]
        cells = (int(customer[-1]) + 1) * many
        if cells <= 8 * len(key) + 1:
            total = np.bincount(key, value, cells)
            found = np.flatnonzero(total)
            total = total[found]
        else:
            found, back = np.unique(key, return_inverse=True)
            total = np.bincount(back, value, len(found))
        return found // many, found % many, total

    def best(self, customer: np.ndarray, at: np.ndarray, r: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
        """Lists of the customers of some rows, which are in the order of their customers."""
        ids, row = np.unique(customer, return_inverse=True)
        done = np.cumsum(self.size[at])
        a = 0
        while a < len(row):
            # whole customers, PRODUCTS products or one customer
            b = int(np.searchsorted(done, (done[a - 1] if a else 0) + PRODUCTS, side="right"))
            b = len(row) if b >= len(row) else max(int(np.searchsorted(row, row[b], side="left")), a)
            if b == a:
                b = int(np.searchsorted(row, row[a], side="right"))
                total = np.zeros(len(self.names))
                step = max(1, PRODUCTS // max(1, int(self.size[at[a:b]].max())))
                for c in range(a, b, step):
                    cut = slice(c, min(c + step, b))
                    _, other, part = self.sums(np.zeros(cut.stop - c, np.int64), at[cut], r[cut])
                    total[other] += part
                other = np.flatnonzero(total)
                who, score = np.full(len(other), row[a]), total[other]
            else:
                who, other, score = self.sums(row[a:b] - row[a], at[a:b], r[a:b])
                who = who + row[a]
            billionths = np.rint(score * 1e9)
            some = billionths > 0
            who, item, score, billionths = who[some], self.names[other[some]], score[some], billionths[some]
            keep, rank = k_best(who, item, billionths, k)
            yield pa.RecordBatch.from_arrays([pa.array(ids[who[keep]]), pa.array(item[keep]), pa.array(rank.astype(np.int32)), pa.array(score[keep])],
                                             ["customer_id", "item_id", "rank", "score"])
            a = b


def _lists(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, parts, similar, rows, waiting = None, [], None, [], 0

        def flush(whole: bool) -> Iterator[pa.RecordBatch]:
            nonlocal rows, waiting
            if not rows or similar is None:
                rows, waiting = [], 0
                return
            customer, at, r = (np.concatenate(x) for x in zip(*rows))
            # the last customer may go on in the next batch
            cut = len(customer) if whole else int(np.searchsorted(customer, customer[-1], side="left"))
            rest = customer[cut:], at[cut:], r[cut:]
            rows, waiting = ([rest] if len(rest[0]) else []), 0
            if cut:
                yield from similar.best(customer[:cut], at[:cut], r[:cut], k)

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.array(batch.column("key"))
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            for a, b in zip(first, [*first[1:], len(key)]):
                part = batch.slice(a, b - a)
                own, step = divmod(int(key[a]), STEPS)
                if own != group:
                    yield from flush(True)
                    group, parts, similar = own, [], None
                if step == 0:
                    others = part.column("others")
                    parts.append((np.array(part.column("item_id")), np.diff(np.array(others.offsets)).astype(np.int64), np.array(others.flatten()),
                                  np.array(part.column("sims").flatten())))
                    continue
                if similar is None and parts:
                    similar, parts = _Similar(parts), []
                if similar is None:
                    continue
                at = similar.place(np.array(part.column("item_id")))
                some = at >= 0
                if some.any():
                    rows.append((np.array(part.column("customer_id"))[some], at[some], np.array(part.column("r"))[some]))
                    waiting += int(similar.size[at[some]].sum())
                    if waiting >= PRODUCTS:
                        yield from flush(False)
        yield from flush(True)

    return run


def best_items(matrix: DataFrame, similar: DataFrame, k: int, neighbours: int) -> DataFrame:
    """(customer_id, item_id, rank, score): the k best positive sums of r times similarity over a customer's rows (customer_id, item_id, r).

    ``similar`` is (item_i, item_j, sim), at most ``neighbours`` rows per item. The result is a written table.
    """
    kinds = dict(matrix.dtypes)
    rows = matrix.where("customer_id is not null and item_id is not null and r is not null")
    # at most ``neighbours`` entries per item: one small row instead of many
    packed = similar.groupBy(F.col("item_i").cast("long").alias("item_id")).agg(
        F.collect_list(F.struct(F.col("item_j").cast("long").alias("item_j"), "sim")).alias("similar"))
    packed = stage(packed.select("item_id", F.col("similar.item_j").alias("others"), F.col("similar.sim").alias("sims")), "similar")
    held = max(1, HELD // neighbours)
    tasks = matrix.sparkSession.sparkContext.defaultParallelism
    blocks = max(tasks, math.ceil(rows.count() / (ROWS if packed.count() <= held else held)))
    dealt = rows.select(
        F.pmod(F.xxhash64("customer_id"), F.lit(blocks)).cast("int").alias("block"), F.col("customer_id").cast("long").alias("customer_id"),
        F.col("item_id").cast("long").alias("item_id"), "r")
    wanted = dealt.select("block", "item_id").distinct().join(packed, "item_id")
    no_list = [F.lit(None).cast(kind).alias(name) for name, kind in (("others", "array<bigint>"), ("sims", "array<double>"))]
    both = wanted.select(
        "block", F.lit(0).alias("step"), F.lit(None).cast("long").alias("customer_id"), "item_id", F.lit(None).cast("double").alias("r"), "others", "sims",
    ).unionByName(dealt.select("block", F.lit(1).alias("step"), "customer_id", "item_id", "r", *no_list))
    key = F.col("block").cast("long") * STEPS + F.col("step")
    found = both.repartitionById(blocks, F.col("block")).select(key.alias("key"), "customer_id", "item_id", "r", "others", "sims").sortWithinPartitions(
        "key", "customer_id").mapInArrow(_lists(k), "customer_id bigint, item_id bigint, rank int, score double")
    ids = [F.col(c).cast(kinds[c]).alias(c) for c in ("customer_id", "item_id")]
    return stage(found.select(*ids, "rank", "score"), "knn-lists")
