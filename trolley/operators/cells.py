"""Vector search over cells (R8, R9): exact by bounds, or with as many probes as a recall asks for.

Items lie in cells around unit centres. The angles between a cell's items and its centre are known, so by the triangle inequality
no item of a cell is nearer to a query than the angle between query and centre allows. ``pruned_topk`` first meets each query with the items of one
near cell, whose k-th best score the final list reaches at least, and then compares it with the items of those cells only whose bound is not below that
score: the lists are those of the full product. How much that saves depends on the vectors: on ones without clusters (many dimensions, no structure)
every cell's bound stays open and all of them are read; see ``work``.

``ivf_topk`` visits a fixed number of cells, nearest centre first. That number is fitted: for a bounded sample of queries the exact
lists are computed, and it is the place, in the query's order of cells, within which ``recall`` of their items lie.

Both run as ``vectors.block_topk``, with the items of a block in the order of their cells: which cells a query visits is found out in the task that
holds it, so no row per query and cell is written or shuffled.

Centres are fitted on at most ``SAMPLE`` items and number one per ``CELL_ITEMS`` items of the catalog, ``MOST_CELLS`` at most; every item is
assigned. What travels with the tasks are the centres and their extents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.functions.expressions import unit
from trolley.operators.vectors import QUERY_BLOCK, THRESHOLDS, block_topk, matrix, meet, unit_vectors
from trolley.session import stage

CELL_ITEMS, MOST_CELLS, SAMPLE = 256, 4096, 65_536
FIT_QUERIES, RECALL = 512, 0.95
#: What rounding may add to a bound or to a score.
SLACK = 1e-7


@dataclass(frozen=True)
class Cells:
    """Unit centres, least and largest angle to an item, and items, by cell; the last cell, of centre 0, has the items without direction."""

    centres: np.ndarray
    low: np.ndarray
    high: np.ndarray
    members: np.ndarray

    def angles(self, x: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(x @ self.centres.T, -1, 1))

    def bounds(self, angles: np.ndarray) -> np.ndarray:
        """Largest cosine that an item of a cell can have."""
        gap = np.maximum(np.maximum(angles - self.high, self.low - angles), 0)
        some = np.where(self.centres.any(axis=1), np.cos(np.minimum(gap, np.pi)), 0.0)
        return np.where(self.members > 0, some, -2.0)

    def by_angle(self, x: np.ndarray) -> np.ndarray:
        return np.argsort(np.where(self.members > 0, self.angles(x), 9.0), axis=1, kind="stable")


def spherical_means(x: np.ndarray, cells: int, seed: int = 7, rounds: int = 8) -> np.ndarray:
    """Unit centres of rows of ``x``; a centre without rows starts again at a random one."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), cells, replace=False)]
    for _ in range(rounds):
        nearest = np.concatenate([np.argmax(x[k: k + 4096] @ centres.T, axis=1) for k in range(0, len(x), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        norm = np.linalg.norm(sums, axis=1)
        lost = norm < 1e-12
        sums[lost], norm[lost] = x[rng.integers(0, len(x), int(lost.sum()))], 1.0
        centres = sums / norm[:, None]
    return centres


def fit_cells(vectors: DataFrame, cells: int | None = None, seed: int = 7) -> tuple[DataFrame, Cells] | None:
    """Items (item_id, vector, cell) as a written table, and the cells; None for an empty catalog."""
    items = stage(unit_vectors(vectors).select("item_id", "vector"), "cell-items")
    n = items.count()
    if not n:
        return None
    some = items.orderBy(F.xxhash64("item_id"), "item_id").limit(SAMPLE).select("vector").toArrow().column("vector").combine_chunks()
    x = matrix(some)
    norm = np.linalg.norm(x, axis=1)
    x = x[norm > 0] / norm[norm > 0][:, None] if (norm > 0).any() else np.eye(1, x.shape[1])
    centres = spherical_means(x, min(cells or -(-n // CELL_ITEMS), MOST_CELLS, len(x)), seed)
    centres = np.vstack([centres, np.zeros((1, centres.shape[1]))])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = matrix(batch.column("vector"))
            near = v @ centres[:-1].T
            cell = np.where(v.any(axis=1), np.argmax(near, axis=1), len(centres) - 1)
            angle = np.arccos(np.clip((v * centres[cell]).sum(axis=1), -1, 1))
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), batch.column("vector"), pa.array(cell.astype(np.int32)), pa.array(angle)],
                                             ["item_id", "vector", "cell", "angle"])

    kind = dict(items.dtypes)["item_id"]
    celled = stage(items.mapInArrow(assign, f"item_id {kind}, vector array<double>, cell int, angle double"), "cells")
    low, high, members = np.zeros(len(centres)), np.zeros(len(centres)), np.zeros(len(centres), np.int64)
    for row in celled.groupBy("cell").agg(F.min("angle"), F.max("angle"), F.count(F.lit(1))).collect():
        low[row[0]], high[row[0]], members[row[0]] = row[1], row[2], row[3]
    return celled.drop("angle"), Cells(centres, low, high, members)


def _asked(queries: DataFrame) -> DataFrame:
    return queries.select(F.col("query_id").cast("bigint").alias("query_id"), unit(F.col("vector")).alias("vector"))


def _with_least(asked: DataFrame, celled: DataFrame, known: Cells, k: int) -> DataFrame:
    """Queries (query_id, vector, least) with the k-th best score in the cell nearest to them that has k items; null where no cell has."""
    large = np.flatnonzero(known.members >= k)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cell = large[np.argmin(known.angles(matrix(batch.column("vector")))[:, large], axis=1)] if len(large) else np.full(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("vector"), pa.array(cell.astype(np.int32))],
                                             ["query_id", "vector", "cell"])

    null = F.lit(None).cast("double").alias("least")
    if not len(large):
        return asked.select("query_id", "vector", null)
    placed = stage(asked.mapInArrow(nearest, "query_id bigint, vector array<double>, cell int"), "queries")
    # a cell that many queries are near to is cut into several groups, each with the items of the cell
    count = {r[0]: r[1] for r in placed.groupBy("cell").count().collect()}
    cuts = [-(-count.get(c, 0) // QUERY_BLOCK) for c in range(len(known.members))]
    groups = sum(cuts)
    if not groups:
        return asked.select("query_id", "vector", null)
    starts = np.cumsum(cuts) - cuts
    first, cut = (F.element_at(F.lit([int(x) for x in values]), F.col("cell") + 1) for values in (starts, cuts))
    left = placed.select(
        (first + F.pmod(F.xxhash64("query_id"), cut)).alias("group"), F.lit(0).alias("step"), F.col("query_id").alias("id"), "vector", null)
    right = celled.where(cut > 0).select(
        F.explode(F.sequence(first, first + cut - 1)).alias("group"), F.lit(1).alias("step"), F.col("item_id").cast("long").alias("id"), "vector", null)
    return meet(left.unionByName(right), groups, k, THRESHOLDS)


NO_LISTS = "query_id bigint, item_id bigint, rank int, score double"


def search(queries: DataFrame, vectors: DataFrame, k: int, cells: int | None = None) -> tuple[DataFrame, list[DataFrame], Cells | None]:
    """Exact lists (query_id, item_id, rank, score), the visits (query_id, cells), and the cells. The cell that gives a query its first score
    is read twice and counted once."""
    spark = queries.sparkSession
    fitted = fit_cells(vectors, cells)
    if fitted is None:
        return spark.createDataFrame([], NO_LISTS), [], None
    celled, known = fitted
    asked = stage(_with_least(_asked(queries), celled, known, k), "cell-queries")

    def opened(x: np.ndarray, least: np.ndarray) -> np.ndarray:
        bounds = known.bounds(known.angles(x))
        return (bounds > -2) & (bounds >= least[:, None] - SLACK)

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                least = np.array(batch.column("least").fill_null(-2.0))
                found = [np.flatnonzero(o).astype(np.int32) for o in opened(matrix(batch.column("vector")), least)]
                yield pa.RecordBatch.from_arrays([batch.column("query_id"), pa.array(found, pa.list_(pa.int32()))], ["query_id", "cells"])

    found = block_topk(asked, celled, k, step="cell", opened=opened)
    return found, [asked.mapInArrow(visits, "query_id bigint, cells array<int>")], known


def pruned_topk(queries: DataFrame, vectors: DataFrame, k: int, cells: int | None = None) -> DataFrame:
    """Top-k items per query by cosine, exactly: (query_id, item_id, rank, score)."""
    return search(queries, vectors, k, cells)[0]


def work(visits: list[DataFrame], known: Cells) -> DataFrame:
    """What a search has read: queries, cells visited and items compared, each as a share of all pairs, in one row."""
    sizes = F.array(*[F.lit(int(m)) for m in known.members])
    all_visits = visits[0].withColumn("round", F.lit(1))
    for n, visit in enumerate(visits[1:], 2):
        all_visits = all_visits.unionByName(visit.withColumn("round", F.lit(n)))
    items = F.aggregate("cells", F.lit(0).cast("bigint"), lambda t, c: t + F.element_at(sizes, c + 1))
    sums = all_visits.agg(F.count_distinct("query_id").alias("queries"), F.sum(F.size("cells")).alias("cells"), F.sum(items).alias("items"),
                          F.max("round").alias("rounds"))
    return sums.select("queries", "rounds", (F.col("cells") / (F.col("queries") * int((known.members > 0).sum()))).alias("cells_read"),
                       (F.col("items") / (F.col("queries") * int(known.members.sum()))).alias("items_read"))


def fitted_probes(asked: DataFrame, celled: DataFrame, known: Cells, k: int, recall: float = RECALL) -> int:
    """Cells to visit, nearest centre first, so that ``recall`` of the exact lists of a bounded sample of queries lies in them."""
    some = stage(asked.orderBy(F.xxhash64("query_id"), "query_id").limit(FIT_QUERIES), "fit-queries")
    exact = block_topk(some, celled.select("item_id", "vector"), k)
    where = exact.join(celled.select("item_id", "cell"), "item_id").select("query_id", "cell").collect()
    rows = some.collect()
    if not where:
        return 1
    place = np.argsort(known.by_angle(np.array([r["vector"] for r in rows])), axis=1)
    at = {r["query_id"]: k for k, r in enumerate(rows)}
    places = [place[at[r["query_id"]], r["cell"]] for r in where]
    return int(np.quantile(places, recall, method="higher")) + 1


def ivf_topk(queries: DataFrame, vectors: DataFrame, k: int, cells: int | None = None, nprobe: int | None = None,
             recall: float = RECALL) -> DataFrame:
    """Search the cells with the nearest centres only, exactly inside them: ``nprobe`` of them or as many as ``recall`` asks for,
    and more where those hold fewer than k items, so that lists are full. With all cells the result equals the full product."""
    fitted = fit_cells(vectors, cells)
    if fitted is None:
        return queries.sparkSession.createDataFrame([], NO_LISTS)
    celled, known = fitted
    asked = stage(_asked(queries), "cell-queries")
    probes = nprobe or fitted_probes(asked, celled, known, k, recall)

    def opened(x: np.ndarray, least: np.ndarray) -> np.ndarray:
        order = known.by_angle(x)
        before = np.cumsum(known.members[order], axis=1) - known.members[order]
        wanted = ((np.arange(order.shape[1]) < probes) | (before < k)) & (known.members[order] > 0)
        out = np.zeros(order.shape, bool)
        np.put_along_axis(out, order, wanted, axis=1)
        return out

    return block_topk(asked, celled, k, step="cell", opened=opened)


def ann_recall(approx: DataFrame, exact: DataFrame, k: int) -> DataFrame:
    """Mean share of the exact top-k ids that the approximate search found."""
    hits = exact.join(approx.select("query_id", "item_id", F.lit(1).alias("hit")), ["query_id", "item_id"], "left")
    per_query = hits.groupBy("query_id").agg((F.count("hit") / F.lit(k)).alias("recall"))
    return per_query.agg(F.count(F.lit(1)).alias("queries"), F.avg("recall").alias("recall"))
