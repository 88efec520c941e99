"""Vector search as blocked matrix products (J11, K3, R6, R11); ``cells`` prunes it.

Queries are dealt to blocks. A block is one task: it holds its queries and the k best items of each, while the items stream past in blocks of
bounded size. So a list is final where it is made, what is shuffled is each query once and the items once per query block, never a row per query
and item block, and no task holds a whole side. Where there are few queries the items are dealt to parts as well, whose lists are merged.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.functions.expressions import best_first, unit
from trolley.operators.sequences import HISTORY_LEN, last_purchases

QUERY_BLOCK, ITEM_BLOCK = 16_384, 4_096
#: Rows that the lists of a block have at most, and queries that are multiplied at once.
LISTED, TILE = 2_000_000, 1_024
#: Scores are compared in whole billionths; what may round up to a score lies this much below it at most.
SLACK = 1e-9
#: Places of a group: its queries, then its items, in as many steps as there are cells.
STEPS = 1 << 20
#: Stands for a null id, which sorts first as in Spark.
NO_ID = np.iinfo(np.int64).min

ROW = ("key", "id", "vector", "least")


def _ids(column: pa.Array) -> np.ndarray:
    return np.array(pc.fill_null(column, int(NO_ID)) if column.null_count else column).astype(np.int64)


def _named(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NO_ID)


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors as rows."""
    if column.null_count:
        raise ValueError("a vector is null")
    return np.array(column.flatten()).reshape(len(column), -1)


def k_best(row: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the ``k`` best entries per row, by row, score and id, and their ranks."""
    order = np.lexsort((ids, -score, row))
    by = row[order]
    rank = np.arange(len(by)) - np.searchsorted(by, by, side="left")
    keep = rank < k
    return order[keep], rank[keep]


class _Block:
    """The queries of a group and their best items so far."""

    def __init__(self, group: int, k: int, item_block: int, opened: Callable | None):
        self.group, self.k, self.item_block, self.opened = group, k, item_block, opened
        self.queries: list[pa.RecordBatch] = []
        self.ids: np.ndarray | None = None
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.step = 0

    def _ready(self) -> None:
        """All queries are here: the first item has come."""
        if self.ids is not None:
            return
        n = sum(q.num_rows for q in self.queries)
        self.ids = np.concatenate([_ids(q.column("id")) for q in self.queries] or [np.zeros(0, np.int64)])
        self.x = np.concatenate([matrix(q.column("vector")) for q in self.queries]) if n else np.zeros((0, 0))
        least = np.concatenate([np.array(pc.fill_null(q.column("least"), -np.inf)) for q in self.queries]) if n else np.zeros(0)
        self.least = least.astype(np.float64)
        self.queries = []
        self.rows, self.items, self.scores = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0)
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.open = None
        if self.opened and n:
            # a bit per cell
            parts = [np.packbits(self.opened(self.x[t: t + TILE], self.least[t: t + TILE]), axis=1) for t in range(0, n, TILE)]
            self.open = np.concatenate(parts)

    def add(self, step: int, part: pa.RecordBatch) -> None:
        if step == 0:
            self.queries.append(part)
            return
        self._ready()
        if self.waiting and step != self.step:
            self._meet()
        self.step = step
        if len(self.ids):
            self.waiting.append((_ids(part.column("id")), matrix(part.column("vector"))))
            if sum(len(i) for i, _ in self.waiting) >= self.item_block:
                self._meet()

    def _meet(self) -> None:
        """The queries that the waiting items are open to meet them."""
        ids, y = (np.concatenate(x) for x in zip(*self.waiting))
        self.waiting = []
        cell = self.step - 1
        rows = np.arange(len(self.ids)) if self.open is None else np.flatnonzero(self.open[:, cell >> 3] >> (7 - (cell & 7)) & 1)
        for t in range(0, len(rows), TILE):
            own = rows[t: t + TILE]
            scores = self.x[own] @ y.T
            floor = self.least[own].copy()
            free = np.flatnonzero(np.isneginf(floor))
            if len(free) and len(ids) > self.k:
                floor[free] = np.partition(scores[free], len(ids) - self.k, axis=1)[:, len(ids) - self.k]
            row, col = np.nonzero(scores >= (floor - SLACK - np.abs(floor, where=np.isfinite(floor), out=np.zeros(len(floor))) * 1e-14)[:, None])
            name, best = ids[col], np.round(scores[row, col], 9)
            if len(row) > 2 * self.k * len(own):  # many equal scores
                keep, _ = k_best(row, name, best, self.k)
                row, name, best = row[keep], name[keep], best[keep]
            self.found.append((own[row].astype(np.int32), name, best))
        if sum(len(f[0]) for f in self.found) >= len(self.ids) * self.k:
            self._merge()

    def _merge(self) -> None:
        if not self.found:
            return
        row, item, score = (np.concatenate([a, *b]) for a, b in zip((self.rows, self.items, self.scores), zip(*self.found)))
        self.found = []
        keep, rank = k_best(row, item, score, self.k)
        self.rows, self.items, self.scores = row[keep], item[keep], score[keep]
        full = rank == self.k - 1
        at = self.rows[full]
        self.least[at] = np.maximum(self.least[at], self.scores[full])

    def _end(self) -> None:
        self._ready()
        if self.waiting:
            self._meet()
        self._merge()

    def lists(self) -> Iterator[pa.RecordBatch]:
        """(query_id, item_id, rank, score), queries of one id with one list."""
        self._end()
        if not len(self.rows):
            return
        _, name = np.unique(self.ids, return_inverse=True)
        keep, rank = k_best(name[self.rows], self.items, self.scores, self.k)
        query, item, score = self.ids[self.rows[keep]], self.items[keep], self.scores[keep]
        for t in range(0, len(keep), 100_000):
            cut = slice(t, t + 100_000)
            yield pa.RecordBatch.from_arrays([_named(query[cut]), _named(item[cut]), pa.array(rank[cut].astype(np.int32)), pa.array(score[cut])],
                                             ["query_id", "item_id", "rank", "score"])

    def thresholds(self) -> Iterator[pa.RecordBatch]:
        """(query_id, vector, least): the k-th best score found, or null."""
        self._end()
        for t in range(0, len(self.ids), TILE):
            x, least = self.x[t: t + TILE], self.least[t: t + TILE]
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1])
            yield pa.RecordBatch.from_arrays([_named(self.ids[t: t + TILE]), pa.ListArray.from_arrays(ends, pa.array(x.reshape(-1))),
                                              pa.array(least, mask=np.isneginf(least))], ["query_id", "vector", "least"])


LISTS, THRESHOLDS = "query_id bigint, item_id bigint, rank int, score double", "query_id bigint, vector array<double>, least double"


def meet(rows: DataFrame, groups: int, k: int, kind: str, item_block: int = ITEM_BLOCK, opened: Callable | None = None) -> DataFrame:
    """Queries and items of (group, step, id, vector, least), a task per group: step 0 has the queries, the others have items, in this order.

    ``least`` is a score that the k-th best of the query is known to reach. ``opened(vectors, least)`` tells which steps each query meets, all without
    it. ``kind`` is LISTS or THRESHOLDS.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.array(batch.column("key"))
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            for a, b in zip(first, [*first[1:], len(key)]):
                group, step = divmod(int(key[a]), STEPS)
                if block is None or block.group != group:
                    if block is not None:
                        yield from block.lists() if kind == LISTS else block.thresholds()
                    block = _Block(group, k, item_block, opened)
                block.add(step, batch.slice(a, b - a))
        if block is not None:
            yield from block.lists() if kind == LISTS else block.thresholds()

    key = F.col("group").cast("long") * STEPS + F.col("step")
    dealt = rows.repartitionById(groups, F.col("group").cast("int")).select(key.alias("key"), "id", "vector", "least")
    return dealt.sortWithinPartitions("key").mapInArrow(run, kind)


def parts_and_blocks(queries: int, items: int, k: int, tasks: int, query_block: int, item_block: int) -> tuple[int, int]:
    """Parts of the items and blocks of the queries: as many groups as tasks run at once, dealt so that least is copied."""
    least = max(1, math.ceil(queries / max(1, min(query_block, LISTED // k))))
    groups = max(least, min(tasks, math.ceil(queries * items / (TILE * ITEM_BLOCK))), 1)
    # a query is copied to each part with its list, an item to each block
    even = math.sqrt(groups * items / max(1, queries * (1 + k / 20)))
    parts = max(1, min(round(even), groups // least, math.ceil(items / item_block)))
    return parts, max(least, math.ceil(groups / parts))


def block_topk(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    query_block: int = QUERY_BLOCK,
    item_block: int = ITEM_BLOCK,
    step: str | None = None,
    opened: Callable | None = None,
) -> DataFrame:
    """Top-k items per query by inner product: (query_id, item_id, rank, score), rank 0-based.

    ``queries`` has (query_id, vector[, least]), ``items`` has (item_id, vector[, step]); for ``least``, ``step`` and ``opened`` see ``meet``.
    Both are read twice, once for their number, so pass tables rather than long computations.
    """
    tasks = queries.sparkSession.sparkContext.defaultParallelism
    parts, blocks = parts_and_blocks(queries.count(), items.count(), k, tasks, query_block, item_block)

    def place(name: str, n: int):
        return F.pmod(F.xxhash64(F.col(name).cast("long")), F.lit(n))

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))) if n > 1 else F.lit(0)

    least = F.col("least") if "least" in queries.columns else F.lit(None)
    left = queries.select(
        place("query_id", blocks).alias("block"), every(parts).alias("part"), F.lit(0).alias("step"), F.col("query_id").cast("long").alias("id"),
        F.col("vector").cast("array<double>").alias("vector"), least.cast("double").alias("least"))
    right = items.select(
        every(blocks).alias("block"), place("item_id", parts).alias("part"), (F.col(step) + 1 if step else F.lit(1)).alias("step"),
        F.col("item_id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector"), F.lit(None).cast("double").alias("least"))
    rows = left.unionByName(right).select((F.col("block") * parts + F.col("part")).alias("group"), "step", "id", "vector", "least")
    found = meet(rows, parts * blocks, k, LISTS, item_block, opened)
    if parts == 1:
        return found
    return best_first(found.drop("rank"), ["query_id"], k).select("query_id", "item_id", "rank", "score")


def pooled_user_vectors(
    interactions: DataFrame,
    vectors: DataFrame,
    history_len: int = HISTORY_LEN,
    order: tuple[str, ...] = ("event_seq",),
) -> DataFrame:
    """Unit-length mean of the vectors of a customer's last ``history_len`` purchases."""
    recent = last_purchases(interactions, history_len, order)
    pooled = (
        recent.join(vectors, "item_id").groupBy("customer_id")
        .agg(F.collect_list("vector").alias("vs"))  # at most history_len vectors
    )
    total = F.aggregate(
        F.slice("vs", 2, history_len),
        F.element_at("vs", 1),
        lambda acc, v: F.zip_with(acc, v, lambda a, b: a + b),
    )
    mean = F.transform(total, lambda x: x / F.size("vs"))
    return pooled.select("customer_id", mean.alias("vector")).withColumn("vector", unit(F.col("vector")))


def unit_vectors(vectors: DataFrame) -> DataFrame:
    return vectors.withColumn("vector", unit(F.col("vector")))


def vector_topk(user_vectors: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """Cosine top-k items per customer in the common retriever form."""
    found = block_topk(
        user_vectors.select(F.col("customer_id").alias("query_id"), "vector"), unit_vectors(vectors), k
    )
    return found.select(
        F.col("query_id").alias("customer_id"), "item_id", "rank", "score"
    )


def item_neighbours(vectors: DataFrame, k: int, of: DataFrame | None = None) -> DataFrame:
    """Top-k items by inner product per item, the item itself excluded."""
    asked = vectors if of is None else vectors.join(of.select("item_id").distinct(), "item_id", "left_semi")
    found = block_topk(asked.select(F.col("item_id").alias("query_id"), "vector"), vectors, k + 1)
    others = found.filter(F.col("query_id") != F.col("item_id")).drop("rank")
    return best_first(others, ["query_id"], k).select(
        F.col("query_id").alias("item_id"), F.col("item_id").alias("neighbour_id"), "rank", "score",
    )
