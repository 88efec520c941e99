"""Registered queries over the retrievers, fitted on the train window and asked for the test customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from trolley.operators import cells, factorization, retrieval, vectors
from trolley.plans.common import rounded
from trolley.plans.oracle import build
from trolley.plans.setting import OrdersSetting, Setting
from trolley.session import stage

K = 20
LIST = ("score",)


def _fit(s: Setting):
    return s.pairs()


def popularity_topk(spark, d):
    s = Setting(spark, d)
    return rounded(retrieval.popularity_topk(_fit(s), s.items, s.asked, K))


def repeat_purchase(spark, d):
    s = Setting(spark, d)
    return rounded(retrieval.repeat_purchase(s.pairs(), s.asked, K))


def repeat_purchase_orders(spark, d):
    s = OrdersSetting(spark, d)
    return rounded(retrieval.repeat_purchase(s.pairs(), s.asked, K))


def repeat_backfill(spark, d):
    s = Setting(spark, d)
    return rounded(retrieval.repeat_backfill(_fit(s), s.items, s.asked, K))


def interaction_matrix(spark, d):
    return rounded(retrieval.interaction_matrix(_fit(Setting(spark, d))))


def item_similarity(spark, d):
    return rounded(retrieval.item_similarity(retrieval.interaction_matrix(_fit(Setting(spark, d)))))


def item_similarity_orders(spark, d):
    return rounded(retrieval.item_similarity(retrieval.interaction_matrix(_fit(OrdersSetting(spark, d)))))


def item_knn(spark, d):
    s = Setting(spark, d)
    return rounded(retrieval.item_knn(_fit(s), s.items, s.asked, K))


def als_topk(spark, d):
    s = Setting(spark, d)
    return rounded(retrieval.als_topk(s.pairs(), s.asked, K))


def als_scores(spark, d):
    """Lists scored again from the exported factors: customers served, rows listed, largest gap between the two scores."""
    s = Setting(spark, d)
    users, items = retrieval.als_factors(s.pairs(), s.asked)
    listed = vectors.block_topk(users, items, K)
    own = listed.join(users, "query_id").join(items.select("item_id", F.col("vector").alias("other")), "item_id")
    again = own.withColumn("again", F.aggregate(F.zip_with("vector", "other", lambda a, b: a * b), F.lit(0.0), lambda t, x: t + x))
    return again.agg(
        F.count_distinct("query_id").alias("customers"), F.count(F.lit(1)).alias("listed"),
        F.round(F.max(F.abs(F.col("again") - F.col("score"))), 6).alias("worst_gap"))


def implicit_objective(spark, d):
    """The factorization's objective for vectors that SQL can derive: last purchases pooled, and the items' own vectors."""
    s = Setting(spark, d)
    matrix = stage(retrieval.interaction_matrix(s.pairs()), "matrix")
    users = _user_vectors(s).select(F.col("customer_id").alias("query_id"), "vector")
    return rounded(factorization.implicit_objective(matrix, users, s.vectors), 3)


def als_objective(spark, d):
    """After few and after all iterations: filled cells, customers, whether the objective fell, whether each customer's factors solve it."""
    s = Setting(spark, d)
    matrix = stage(retrieval.interaction_matrix(s.pairs()), "matrix")
    everyone = matrix.select("customer_id").distinct()
    rows, last = None, F.lit(float("inf"))
    for iterations in (1, 4, 12):
        users, items = retrieval.als_factors(s.pairs(), everyone, iterations=iterations)
        found = stage(factorization.implicit_objective(matrix, users, items), "objective")
        gaps = factorization.stationarity(matrix, users, items)
        row = found.select(
            F.lit(iterations).alias("iterations"), "filled", gaps.agg(F.count(F.lit(1))).scalar().alias("customers"),
            (F.col("objective") < last).alias("fell"), (gaps.agg(F.max("gap")).scalar() < 1e-3).alias("solved"))
        rows, last = row if rows is None else rows.unionByName(row), found.select("objective").scalar()
    return rows


def _user_vectors(s: Setting):
    return s.user_vectors(s.train_end, s.asked)


def vector_topk(spark, d):
    s = Setting(spark, d)
    return rounded(vectors.vector_topk(_user_vectors(s), s.vectors, K))


def rrf_blend(spark, d):
    s = Setting(spark, d)
    pairs = _fit(s)
    lists = [
        (retrieval.repeat_backfill(pairs, s.items, s.asked, 3 * K), 1.0),
        (retrieval.item_knn(pairs, s.items, s.asked, 3 * K), 0.8),
        (vectors.vector_topk(_user_vectors(s), s.vectors, 3 * K), 0.8),
    ]
    return rounded(retrieval.rrf_blend(lists, K))


def item_neighbours(spark, d):
    return rounded(vectors.item_neighbours(Setting(spark, d).vectors, 5))


def _queries(s: Setting):
    return _user_vectors(s).select(F.col("customer_id").alias("query_id"), "vector")


def pruned_topk(spark, d):
    """Cells in the order of their bounds until none can hold a better item: the lists of the full product."""
    s = Setting(spark, d)
    return rounded(cells.pruned_topk(_queries(s), s.vectors, K).withColumnRenamed("query_id", "customer_id"))


def cells_read(spark, d):
    """What the bounds leave to read, as shares of all cells and of all pairs, for the last purchases' vectors."""
    s = Setting(spark, d)
    _, visits, known = cells.search(_queries(s), s.vectors, K)
    return rounded(cells.work(visits, known))


def pruned_neighbours(spark, d):
    """The 5 nearest items of every item, itself among them, by the same search."""
    items = Setting(spark, d).vectors
    found = cells.pruned_topk(items.select(F.col("item_id").alias("query_id"), "vector"), items, 5)
    return rounded(found.select(F.col("query_id").alias("item_id"), F.col("item_id").alias("neighbour_id"), "rank", "score"))


def ivf_topk(spark, d):
    s = Setting(spark, d)
    return rounded(cells.ivf_topk(_queries(s), s.vectors, K))


def ivf_all_cells(spark, d):
    """Every cell probed: the search must then list what the exact one lists."""
    s = Setting(spark, d)
    found = cells.ivf_topk(_queries(s), s.vectors, K, nprobe=cells.MOST_CELLS)
    return rounded(found.withColumnRenamed("query_id", "customer_id"))


def ann_recall_all_cells(spark, d):
    s = Setting(spark, d)
    queries = _queries(s)
    exact = vectors.block_topk(queries, vectors.unit_vectors(s.vectors), K)
    return rounded(cells.ann_recall(cells.ivf_topk(queries, s.vectors, K, nprobe=cells.MOST_CELLS), exact, K))


def _recalls(spark, d):
    s = Setting(spark, d)
    queries = _queries(s)
    exact = stage(vectors.block_topk(queries, vectors.unit_vectors(s.vectors), K), "exact-lists")
    for name, found in (("bounds", cells.pruned_topk(queries, s.vectors, K)), ("probed_cells", cells.ivf_topk(queries, s.vectors, K))):
        found = stage(found, "found-lists")
        yield cells.ann_recall(found, exact, K).select(
            F.lit(name).alias("index"), "queries", "recall", found.agg(F.count(F.lit(1))).scalar().alias("listed"))


def ann_recall(spark, d):
    """Recall of the search by bounds and of that by a fitted number of probes."""
    parts = list(_recalls(spark, d))
    return rounded(parts[0].unionByName(parts[1]))


def ann_recall_reached(spark, d):
    """Whether both searches reach a recall of 0.9 with full lists, and the exact one 1."""
    return ann_recall(spark, d).select("index", "queries", "listed", (F.col("recall") >= 0.9).alias("reached"),
                                       ((F.col("recall") == 1) | (F.col("index") != "bounds")).alias("exact"))


_LIST = "SELECT customer_id, item_id, CAST(rank AS INTEGER) AS rank, score FROM {} WHERE rank < 20"
_SIM = "SELECT item_i, item_j, sim, CAST(rank AS INTEGER) AS rank FROM sim"

QUERIES = {
    "popularity_topk": (popularity_topk, build("""
SELECT customer_id, item_id, CAST(rank AS INTEGER) AS rank, score FROM asked, pop WHERE rank < 20""", digits=LIST)),
    "repeat_purchase": (repeat_purchase, build(_LIST.format("rep"), digits=LIST)),
    "repeat_purchase_orders": (repeat_purchase_orders, build(
        _LIST.format("rep"), past="otrain", asked="SELECT DISTINCT customer_id FROM otruth", digits=LIST)),
    "repeat_backfill": (repeat_backfill, build(_LIST.format("repbf"), digits=LIST)),
    "interaction_matrix": (interaction_matrix, build("SELECT * FROM mat", digits=("r",))),
    "item_similarity": (item_similarity, build(_SIM, digits=("sim",))),
    "item_similarity_orders": (item_similarity_orders, build(_SIM, past="otrain", digits=("sim",))),
    "item_knn": (item_knn, build(_LIST.format("knn"), digits=LIST)),
    "als_topk": (als_topk, None),
    "vector_topk": (vector_topk, build(_LIST.format("vec"), digits=LIST)),
    "rrf_blend": (rrf_blend, build(_LIST.format("rrf"), digits=LIST)),
    "item_neighbours": (item_neighbours, build("""
SELECT item_id, neighbour_id, CAST(rank AS INTEGER) AS rank, score FROM neigh WHERE rank < 5""", digits=LIST)),
    "pruned_topk": (pruned_topk, build(_LIST.format("vec"), digits=LIST)),
    "pruned_neighbours": (pruned_neighbours, """
WITH v AS (
    SELECT CAST(vec_id AS BIGINT) AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), scored AS (
    SELECT a.id AS item_id, b.id AS neighbour_id,
           round(list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))), 9) AS score
    FROM v a, v b
)
SELECT item_id, neighbour_id, CAST(row_number() OVER o - 1 AS INTEGER) AS rank, round(score, 6) AS score FROM scored
WINDOW o AS (PARTITION BY item_id ORDER BY score DESC, neighbour_id) QUALIFY row_number() OVER o <= 5"""),
    "cells_read": (cells_read, None),
    "ivf_topk": (ivf_topk, None),
    "ann_recall": (ann_recall, None),
    "ann_recall_reached": (ann_recall_reached, build("""
SELECT i AS index, count(DISTINCT customer_id) AS queries, count(*) FILTER (rank < 20) AS listed, true AS reached, true AS exact
FROM vec, (SELECT unnest(['bounds', 'probed_cells']) AS i) GROUP BY i""")),
    "ivf_all_cells": (ivf_all_cells, build(_LIST.format("vec"), digits=LIST)),
    "ann_recall_all_cells": (ann_recall_all_cells, build(
        "SELECT count(DISTINCT customer_id) AS queries, 1.0::DOUBLE AS recall FROM vec")),
    "implicit_objective": (implicit_objective, build("""
SELECT filled, round(loss, 3) AS loss, round(penalty, 3) AS penalty, round(loss + penalty, 3) AS objective FROM (
  SELECT count(r) AS filled, sum(CASE WHEN r IS NULL THEN s * s ELSE (1 + 12 * r) * (1 - s) * (1 - s) END) AS loss,
    0.05::DOUBLE * sum(CASE WHEN r IS NULL THEN 0 ELSE xx + yy END) AS penalty
  FROM (
    SELECT m.r, list_dot_product(u.v, i.v) AS s, list_dot_product(u.v, u.v) AS xx, list_dot_product(i.v, i.v) AS yy
    FROM (SELECT customer_id, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS v FROM uvec
          WHERE customer_id IN (SELECT customer_id FROM asked)) u CROSS JOIN ivec i
    LEFT JOIN mat m ON m.customer_id = u.customer_id AND m.item_id = i.item_id))""")),
    "als_objective": (als_objective, build("""
SELECT CAST(unnest([1, 4, 12]) AS INTEGER) AS iterations, count(*) AS filled, count(DISTINCT customer_id) AS customers, true AS fell, true AS solved
FROM mat""")),
    "als_scores": (als_scores, build(
        "SELECT count(*) AS customers, 20 * count(*) AS listed, 0.0::DOUBLE AS worst_gap FROM asked")),
}
