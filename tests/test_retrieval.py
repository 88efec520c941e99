import numpy as np
import pytest
from schemas import LOG_SCHEMA

from trolley.operators import retrieval, vectors
from trolley.operators.pairs import pair_aggregate


@pytest.fixture(scope="module")
def pairs(interactions):
    return pair_aggregate(interactions, 11).cache()


@pytest.fixture(scope="module")
def dense(pairs):
    m = np.zeros((25, 32))
    for r in retrieval.interaction_matrix(pairs).collect():
        m[r["customer_id"], r["item_id"]] = r["r"]
    return m


def test_matrix_weights(log, dense):
    want = np.zeros_like(dense)
    last = max(r[2] for r in log)
    for c, i, day, kind, *_ in log:
        want[c, i] += {0: 0.3, 1: 1.0, 2: 3.0}[kind] * 2 ** (-(last - day) / 30)
    assert np.allclose(dense, want)


def similarity(m):
    co = m.T @ m
    norm = np.sqrt(np.diag(co)) + 1e-8
    sim = co / (np.outer(norm, norm) + 25)
    np.fill_diagonal(sim, 0)
    return sim


@pytest.mark.parametrize("segment", [1, 3, 256])
def test_similarity_does_not_depend_on_the_segments(pairs, dense, segment):
    """Rows cut into single items, into several segments and left whole agree with the dense product."""
    got = np.zeros((32, 32))
    for r in retrieval.item_similarity(retrieval.interaction_matrix(pairs), segment=segment).collect():
        got[r["item_i"], r["item_j"]] = r["sim"]
    assert np.allclose(got, similarity(dense))


def test_neighbour_limit(pairs, dense):
    rows = retrieval.item_similarity(retrieval.interaction_matrix(pairs), neighbours=3).collect()
    sim = similarity(dense)
    for i in range(30):
        mine = sorted((r["rank"], r["item_j"]) for r in rows if r["item_i"] == i)
        want = sorted(range(32), key=lambda j: (-round(sim[i, j], 9), j))[:3]
        assert [j for _, j in mine] == want


def test_knn_scores_and_fallback(spark, pairs, items, dense):
    asked = spark.createDataFrame([(0,), (4,), (900,)], "customer_id int")
    rows = retrieval.item_knn(pairs, items, asked, 5).collect()
    scores = dense @ similarity(dense)
    for c in (0, 4):
        got = sorted((r["rank"], r["item_id"], r["score"]) for r in rows if r["customer_id"] == c)
        want = sorted(range(32), key=lambda j: (-round(scores[c, j], 9), j))[:5]
        assert [g[1] for g in got] == want
        assert [g[2] for g in got] == pytest.approx([scores[c, j] for j in want])
    popular = [r["item_id"] for r in sorted(retrieval.popularity_topk(
        pairs, items, asked.filter("customer_id = 900"), 5).collect(), key=lambda r: r["rank"])]
    assert [r["item_id"] for r in sorted((r for r in rows if r["customer_id"] == 900), key=lambda r: r["rank"])] == popular


def test_backfill_fills_every_slate(spark, items):
    log = spark.createDataFrame([(0, 7, 1, 2, 1, 0), (0, 8, 2, 2, 1, 1), (1, 7, 2, 2, 1, 2)], LOG_SCHEMA)
    asked = spark.createDataFrame([(0,), (2,)], "customer_id int")
    fitted = pair_aggregate(log, 2)
    rows = sorted(map(tuple, retrieval.repeat_backfill(fitted, items, asked, 4).collect()))
    assert [r[1] for r in rows if r[0] == 0] and {r[0] for r in rows} == {0, 2}
    slates = {c: [r[1] for r in sorted(rows, key=lambda r: r[2]) if r[0] == c] for c in (0, 2)}
    assert slates[0] == [8, 7, 0, 1] and slates[2] == [7, 8, 0, 1]


def test_rrf(spark):
    schema = "customer_id int, item_id int, rank int, score double"
    a = spark.createDataFrame([(0, 1, 0, 9.0), (0, 2, 1, 8.0)], schema)
    b = spark.createDataFrame([(0, 2, 0, 0.1)], schema)
    got = {r["item_id"]: r["score"] for r in retrieval.rrf_blend([(a, 1.0), (b, 0.8)], 5).collect()}
    assert got[1] == pytest.approx(1 / 61) and got[2] == pytest.approx(1 / 62 + 0.8 / 61)


@pytest.fixture(scope="module")
def cloud(spark):
    """Vectors of which a third are copies of one another."""
    rng = np.random.default_rng(3)
    items = rng.normal(size=(90, 8))
    items[:30] = items[0]
    queries = np.vstack([rng.normal(size=(20, 8)), items[:1]])
    return (
        queries, items,
        spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "query_id int, vector array<double>"),
        spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(items)], "item_id int, vector array<double>"),
    )


@pytest.mark.parametrize("blocks", [(1024, 4096), (4, 7), (1, 1)])
def test_block_search_is_exact(cloud, blocks):
    queries, items, qdf, idf = cloud
    got = vectors.block_topk(qdf, idf, 5, query_block=blocks[0], item_block=blocks[1]).collect()
    scores = np.round(queries @ items.T, 9)
    assert len(got) == 5 * len(queries)
    for q in range(len(queries)):
        mine = [r["item_id"] for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])]
        assert mine == sorted(range(90), key=lambda j: (-scores[q, j], j))[:5]


def test_neighbours_leave_the_item_out(cloud):
    _, _, _, idf = cloud
    rows = vectors.item_neighbours(idf, 3).collect()
    assert len(rows) == 270 and all(r["item_id"] != r["neighbour_id"] for r in rows)


