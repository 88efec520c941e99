"""Pruned vector search against brute force."""

import numpy as np
import pytest

from trolley.operators import cells, vectors


def frames(spark, queries, items):
    return (spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(queries)], "query_id bigint, vector array<double>"),
            spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(items)], "item_id bigint, vector array<double>"))


def brute(queries, items, k):
    unit = lambda x: x / np.maximum(np.linalg.norm(x, axis=1), 1e-300)[:, None]
    scores = np.round(unit(queries) @ unit(items).T, 9)
    return {(q, r): (j, scores[q, j]) for q in range(len(queries))
            for r, j in enumerate(sorted(range(len(items)), key=lambda j: (-scores[q, j], j))[:k])}


def listed(df):
    return {(r["query_id"], r["rank"]): (r["item_id"], r["score"]) for r in df.collect()}


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(4)
    middle = rng.standard_normal((30, 16))
    items = np.concatenate([m + rng.standard_normal((40, 16)) * 0.12 for m in middle])
    # one cluster holds a third of all items, some vectors repeat, one is zero
    items = np.concatenate([items, middle[3] + rng.standard_normal((600, 16)) * 0.02, items[:20], np.zeros((1, 16))])
    return middle[rng.integers(0, 30, 50)] + rng.standard_normal((50, 16)) * 0.1, items[rng.permutation(len(items))]


def test_bounds_give_the_exact_lists_and_read_few_items(spark, clustered):
    queries, items = clustered
    qdf, idf = frames(spark, queries, items)
    found, visits, known = cells.search(qdf, idf, 10, cells=40)
    got, want = listed(found), brute(queries, items, 10)
    assert {p: j for p, (j, _) in got.items()} == {p: j for p, (j, _) in want.items()}
    share = cells.work(visits, known).first()
    assert share["queries"] == 50 and share["items_read"] < 0.5 and share["cells_read"] < 0.5, share
    assert sum(known.members) == len(items)


def test_vectors_without_structure_are_still_exact(spark):
    rng = np.random.default_rng(5)
    queries, items = rng.standard_normal((20, 24)), rng.standard_normal((700, 24))
    qdf, idf = frames(spark, queries, items)
    assert {p: j for p, (j, _) in listed(cells.pruned_topk(qdf, idf, 7, cells=25)).items()} == {p: j for p, (j, _) in brute(queries, items, 7).items()}


@pytest.mark.parametrize("k", [5, 60])
def test_fitted_probes_reach_the_recall_with_full_lists(spark, clustered, k):
    for queries, items in (clustered, (np.random.default_rng(6).standard_normal((60, 12)), np.random.default_rng(7).standard_normal((900, 12)))):
        qdf, idf = frames(spark, queries, items)
        exact = vectors.block_topk(vectors.unit_vectors(qdf), vectors.unit_vectors(idf), k)
        found = cells.ivf_topk(qdf, idf, k, cells=30).cache()
        assert found.count() == k * len(queries) and cells.ann_recall(found, exact, k).first()["recall"] >= 0.9


def test_all_cells_give_the_exact_result(spark, clustered):
    queries, items = clustered
    qdf, idf = frames(spark, queries, items[:300])
    exact = sorted(map(tuple, vectors.block_topk(vectors.unit_vectors(qdf), vectors.unit_vectors(idf), 5).collect()))
    for n in (4, 256):
        assert sorted(map(tuple, cells.ivf_topk(qdf, idf, 5, cells=n, nprobe=n).collect())) == exact


def test_small_catalogs(spark):
    qdf, idf = frames(spark, [[1.0, 0.0], [0.0, 0.0]], [[1.0, 1.0], [0.0, 2.0]])
    got = listed(cells.pruned_topk(qdf, idf, 5))
    assert {p: j for p, (j, _) in got.items()} == {(0, 0): 0, (0, 1): 1, (1, 0): 0, (1, 1): 1}
    for search in (cells.pruned_topk, cells.ivf_topk):
        assert search(qdf, idf.limit(0), 5).count() == 0 and search(qdf.limit(0), idf, 5).count() == 0
    # nothing but vectors without direction
    _, still = frames(spark, [[1.0]], [[0.0, 0.0]] * 3)
    assert {p: j for p, (j, _) in listed(cells.pruned_topk(qdf, still, 2)).items()} == {(0, 0): 0, (0, 1): 1, (1, 0): 0, (1, 1): 1}


def test_bounds_hold_for_every_item():
    rng = np.random.default_rng(8)
    x = rng.standard_normal((400, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    centres = cells.spherical_means(x, 12)
    cell = np.argmax(x @ centres.T, axis=1)
    angle = np.arccos(np.clip((x * centres[cell]).sum(axis=1), -1, 1))
    low, high = (np.array([f(angle[cell == c]) if (cell == c).any() else 0 for c in range(12)]) for f in (np.min, np.max))
    known = cells.Cells(centres, low, high, np.bincount(cell, minlength=12))
    q = rng.standard_normal((50, 8))
    q /= np.linalg.norm(q, axis=1)[:, None]
    bounds = known.bounds(known.angles(q))
    assert (q @ x.T <= bounds[:, cell] + 1e-9).all()
