"""Nearest-neighbour lists by customer block, and what the feature joins move."""

import random

import pytest

from trolley.operators import knn
from trolley.operators.features import FeatureStore


@pytest.fixture(scope="module")
def sides(spark):
    """One customer has every item; ids beyond 32 bits; items without similar ones; a null r and null ids."""
    rng = random.Random(4)
    rows = [(0, i, rng.random()) for i in range(60)] + [(2**40 + c, rng.randrange(60), rng.random()) for c in range(40) for _ in range(4)]
    rows = list({(c, i): (c, i, r) for c, i, r in rows}.values()) + [(7, 3, None), (None, 3, 1.0), (8, None, 1.0), (9, 59, 1.0)]
    sims = [(i, (i * k + 1) % 60, 0.01 * ((i + k) % 9)) for i in range(55) for k in range(1, 6)]
    sims = list({(i, j): (i, j, s) for i, j, s in sims if i != j}.values())
    want = {}
    for c, i, r in rows:
        for a, j, s in sims:
            if a == i and c is not None and r is not None:
                want.setdefault(c, {}).setdefault(j, []).append(r * s)
    want = {c: {j: sum(x) for j, x in own.items() if sum(x) > 5e-10} for c, own in want.items()}
    return (spark.createDataFrame(rows, "customer_id bigint, item_id bigint, r double").repartition(3),
            spark.createDataFrame(sims, "item_i bigint, item_j bigint, sim double"), want)


@pytest.mark.parametrize("held, products", [(6_500_000, 2_000_000), (20, 30), (20, 1)])
def test_lists_do_not_depend_on_the_blocks(monkeypatch, sides, held, products):
    matrix, similar, want = sides
    monkeypatch.setattr(knn, "HELD", held)
    monkeypatch.setattr(knn, "PRODUCTS", products)
    got = {}
    for r in knn.best_items(matrix, similar, 5, 5).collect():
        got.setdefault(r.customer_id, {})[r["rank"]] = (r.item_id, pytest.approx(r.score))
    assert got == {c: dict(enumerate(sorted(own.items(), key=lambda x: (-round(x[1], 9), x[0]))[:5])) for c, own in want.items() if own}


def test_no_row_per_score_is_moved(monkeypatch, sides):
    kept = []
    monkeypatch.setattr(knn, "stage", lambda df, name: kept.append(df) or df)
    matrix, similar, _ = sides
    knn.best_items(matrix, similar, 5, 5)
    text = kept[-1]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text[: text.index("MapInArrow")] and "Window" not in text


def test_candidates_move_twice(spark, interactions, items, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        path = str(tmp_path / "candidates")
        interactions.select("customer_id", "item_id").distinct().write.parquet(path)
        plain = FeatureStore.build(interactions.where("day < 8"), items, 8)
        parts = []
        for name in ("item", "user", "user_item", "user_category", "user_brand"):
            getattr(plain, name).write.parquet(str(tmp_path / name))
            parts.append(spark.read.parquet(str(tmp_path / name)))
        store = FeatureStore(parts[0], parts[2], parts[1], parts[3], parts[4], 8)
        text = store.transform(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
        # each of the five blocks once, the candidates by item and by customer
        assert text.count("Exchange hashpartitioning") == 7
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
