import numpy as np
import pytest

from trolley.operators import factorization, retrieval
from trolley.operators.pairs import pair_aggregate

SETTINGS = {"regularization": 0.1, "alpha": 5.0}


@pytest.fixture(scope="module")
def pairs(interactions):
    return pair_aggregate(interactions, 11).cache()


@pytest.fixture(scope="module")
def cells(pairs):
    return {(r["customer_id"], r["item_id"]): r["r"] for r in retrieval.interaction_matrix(pairs).collect()}


def dense_objective(cells, users, items, regularization, alpha):
    """Every cell visited, filled or not."""
    loss = penalty = 0.0
    for u, x in users.items():
        for i, y in items.items():
            r = cells.get((u, i), 0.0)
            loss += (1 + alpha * r) * ((r > 0) - x @ y) ** 2
            penalty += regularization * (r > 0) * (x @ x + y @ y)
    return loss, penalty


def collected(vectors, key):
    return {r[key]: np.array(r["vector"]) for r in vectors.collect()}


def test_objective_equals_the_sum_over_all_cells(spark, pairs, cells):
    rng = np.random.default_rng(1)
    users = spark.createDataFrame([(u, rng.standard_normal(5).tolist()) for u in range(0, 25, 2)], "query_id int, vector array<double>")
    items = spark.createDataFrame([(i, rng.standard_normal(5).tolist()) for i in range(28)], "item_id int, vector array<double>")
    row = factorization.implicit_objective(retrieval.interaction_matrix(pairs), users, items, **SETTINGS).first()
    x, y = collected(users, "query_id"), collected(items, "item_id")
    loss, penalty = dense_objective(cells, x, y, **SETTINGS)
    assert (row["loss"], row["penalty"], row["objective"]) == pytest.approx((loss, penalty, loss + penalty))
    assert row["filled"] == sum(u in x and i in y for u, i in cells)


def test_no_factors_leave_nothing_to_explain(spark, pairs):
    users = spark.createDataFrame([], "query_id int, vector array<double>")
    items = spark.createDataFrame([], "item_id int, vector array<double>")
    row = factorization.implicit_objective(retrieval.interaction_matrix(pairs), users, items).first()
    assert tuple(row) == (0, 0.0, 0.0, 0.0)


def test_factorization_minimises_its_objective(pairs, cells):
    matrix, asked = retrieval.interaction_matrix(pairs), pairs.select("customer_id").distinct()
    found = []
    for iterations in (1, 3, 10):
        users, items = retrieval.als_factors(pairs, asked, factors=4, iterations=iterations, **SETTINGS)
        row = factorization.implicit_objective(matrix, users, items, **SETTINGS).first()
        found.append(row["objective"])
        dense = dense_objective(cells, collected(users, "query_id"), collected(items, "item_id"), **SETTINGS)
        assert row["objective"] == pytest.approx(sum(dense), rel=1e-9)
    assert found[0] > found[1] > found[2]
    gaps = [r["gap"] for r in factorization.stationarity(matrix, users, items, **SETTINGS).collect()]
    assert len(gaps) == 25 and max(gaps) < 1e-5
    # moved factors are no solution any more
    worse = users.selectExpr("query_id", "transform(vector, x -> 1.1 * x) AS vector")
    gaps = [r["gap"] for r in factorization.stationarity(matrix, worse, items, **SETTINGS).collect()]
    assert min(gaps) > 1e-3
    assert factorization.implicit_objective(matrix, worse, items, **SETTINGS).first()["objective"] > found[2]
