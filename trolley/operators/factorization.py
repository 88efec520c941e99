"""What an implicit factorization minimises, over all cells of the matrix.

A customer with factors x and an item with factors y have score s = x y. With weight r > 0 in the matrix the wanted score is 1 with
confidence 1 + alpha r, in all other cells it is 0 with confidence 1. The factors are penalised by ``regularization`` times the
number of cells of their row or column. The sum over the empty cells needs no cell: the squares of all scores add up to the inner
product of the two Gram matrices, so only the filled cells are visited.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.functions.expressions import dot


def _stacked(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return np.array(batch.column(column).to_pylist(), float)


def gram(vectors: DataFrame) -> np.ndarray:
    """Sum of the outer products of ``vector``: one small matrix per task, added up by Spark."""

    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = _stacked(batch, "vector")
                total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["at", "x"])

    parts = vectors.select("vector").mapInArrow(outer, "at bigint, x double")
    # rank x rank numbers, whatever the number of vectors
    sums = parts.groupBy("at").agg(F.sum("x").alias("x")).toPandas().sort_values("at")["x"].to_numpy()
    side = int(round(len(sums) ** 0.5))
    return sums.reshape(side, side)


def filled_cells(matrix: DataFrame, users: DataFrame, items: DataFrame, alpha: float) -> DataFrame:
    """customer_id, item_id, extra (alpha r) and score of every cell of the matrix whose row and column have factors."""
    x = users.select(F.col("query_id").alias("customer_id"), F.col("vector").alias("x"))
    y = items.select("item_id", F.col("vector").alias("y"))
    cells = matrix.where(F.col("r") > 0).join(x, "customer_id").join(y, "item_id")
    return cells.select("customer_id", "item_id", (F.lit(alpha) * F.col("r")).alias("extra"), dot(F.col("x"), F.col("y")).alias("score"))


def _penalty(cells: DataFrame, vectors: DataFrame, key: str, id_column: str) -> DataFrame:
    """Squared length of each vector times the number of its cells, summed."""
    counts = cells.groupBy(F.col(key).alias(id_column)).agg(F.count(F.lit(1)).alias("n"))
    return vectors.join(counts, id_column).agg(F.coalesce(F.sum(F.col("n") * dot(F.col("vector"), F.col("vector"))), F.lit(0.0)).alias("p"))


def implicit_objective(
    matrix: DataFrame, users: DataFrame, items: DataFrame, regularization: float = 0.05, alpha: float = 12.0,
) -> DataFrame:
    """One row: filled cells, loss over all cells, penalty, objective (loss + penalty).

    ``matrix`` is (customer_id, item_id, r), ``users`` (query_id, vector), ``items`` (item_id, vector). Cells are those of the given
    users and items; the row of a user or item that is not given counts nowhere. Write the inputs out first, they are read several times.
    """
    everywhere = float((gram(users) * gram(items)).sum()) if not users.isEmpty() and not items.isEmpty() else 0.0
    cells = filled_cells(matrix, users, items, alpha)
    extra, s = F.col("extra"), F.col("score")
    # (1 + extra)(1 - s)^2 instead of the s^2 that the sum over all cells holds already
    correction = extra * s * s + (1 + extra) * (1 - 2 * s)
    loss = cells.agg(F.count(F.lit(1)).alias("filled"), F.coalesce(F.sum(correction), F.lit(0.0)).alias("correction"))
    penalty = F.lit(regularization) * (
        _penalty(cells, users, "customer_id", "query_id").scalar() + _penalty(cells, items, "item_id", "item_id").scalar())
    row = loss.select("filled", (F.lit(everywhere) + F.col("correction")).alias("loss"), penalty.alias("penalty"))
    return row.withColumn("objective", F.col("loss") + F.col("penalty"))


def stationarity(
    matrix: DataFrame, users: DataFrame, items: DataFrame, regularization: float = 0.05, alpha: float = 12.0,
) -> DataFrame:
    """query_id and gap per user: how far the objective still slopes along the user's own factors, as a share of its confidence.

    The last half-step solves each user's factors for the items' factors, where the slope along any direction is 0; what remains is
    the rounding of single precision. Along the factors themselves the slope needs scores only.
    """
    inner = gram(items)

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _stacked(batch, "vector")
                yield pa.RecordBatch.from_arrays([
                    batch.column("query_id"), pa.array(((x @ inner) * x).sum(axis=1)), pa.array((x * x).sum(axis=1))],
                    ["query_id", "everywhere", "length"])

    kind = dict(users.dtypes)["query_id"]
    rows = users.select("query_id", "vector").mapInArrow(squares, f"query_id {kind}, everywhere double, length double")
    extra, s = F.col("extra"), F.col("score")
    own = filled_cells(matrix, users, items, alpha).groupBy(F.col("customer_id").alias("query_id")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(extra * s * s - (1 + extra) * s).alias("slope"), F.sum(1 + extra).alias("confidence"))
    whole = F.col("everywhere") + F.col("slope") + F.lit(regularization) * F.col("n") * F.col("length")
    return rows.join(own, "query_id").select("query_id", (F.abs(whole) / F.col("confidence")).alias("gap"))
