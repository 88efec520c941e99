"""Vector search: what it moves, and odd ids."""

import numpy as np
import pytest

from trolley.operators import cells, vectors


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def frames(spark):
    rng = np.random.default_rng(2)
    queries, items = rng.standard_normal((40, 6)), rng.standard_normal((300, 6))
    return (spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(queries)], "query_id bigint, vector array<double>"),
            spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(items)], "item_id bigint, vector array<double>"), queries, items)


def test_lists_are_final_where_they_are_made(frames):
    qdf, idf, *_ = frames
    found, visits, _ = cells.search(qdf, idf, 5, cells=12)
    for df in (vectors.block_topk(qdf, idf, 5), found, cells.ivf_topk(qdf, idf, 5, cells=12)):
        # queries and items move once, their lists not at all, and there is no row per query and cell
        assert plan(df).count("Exchange") == 1 and "Window" not in plan(df)
    assert [v.count() for v in visits] == [40]


def test_groups_copy_little():
    assert vectors.parts_and_blocks(500_000, 300_000, 20, 6, 16_384, 4_096) == (1, 31)
    assert vectors.parts_and_blocks(500_000, 300_000, 200, 6, 16_384, 4_096) == (1, 50)  # lists of a block are bounded
    assert vectors.parts_and_blocks(512, 300_000, 20, 6, 16_384, 4_096) == (6, 1)
    assert vectors.parts_and_blocks(0, 0, 20, 6, 16_384, 4_096) == (1, 1)


def test_equal_scores_repeated_and_null_ids(spark):
    items = spark.createDataFrame([(k, [1.0, 0.0]) for k in range(400)] + [(400, [2.0, 0.0])], "item_id bigint, vector array<double>")
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [-1.0, 0.0]), (None, [1.0, 1.0])], "query_id bigint, vector array<double>")
    for item_block in (4_096, 7):
        got = {(r.query_id, r["rank"]): (r.item_id, r.score) for r in vectors.block_topk(queries, items, 3, item_block=item_block).collect()}
        assert got == {(q, r): v for q in (1, 2, None) for r, v in enumerate([(400, 2.0), (0, 1.0), (1, 1.0)])}


def test_a_crowded_cell_is_cut(spark, monkeypatch, frames):
    _, idf, _, items = frames
    monkeypatch.setattr(cells, "QUERY_BLOCK", 8)
    qdf = spark.createDataFrame([(k, [1.0, 0.01 * k, 0.0, 0.0, 0.0, 0.0]) for k in range(50)], "query_id bigint, vector array<double>")
    x = np.array([r.vector for r in qdf.collect()])
    unit = lambda v: v / np.linalg.norm(v, axis=1)[:, None]
    scores = np.round(unit(x) @ unit(items).T, 9)
    got = {(r.query_id, r["rank"]): r.item_id for r in cells.pruned_topk(qdf, idf, 4, cells=10).collect()}
    assert got == {(q, r): j for q in range(50) for r, j in enumerate(sorted(range(300), key=lambda j: (-scores[q, j], j))[:4])}
