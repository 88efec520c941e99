"""Approximate nearest neighbours against brute force."""

import collections

import numpy as np

from trolley.llm import pruned_graph as graph

SCHEMA = "vec_id bigint, embedding array<float>, label int, rank int"


def exact(rows, asked, k):
    """The k best (score, id) of every asked row, its own row left out."""
    out = collections.Counter()
    for at, (i, v, *_) in asked:
        scores = []
        for other, (j, w, *_) in rows:
            if other != at and len(w) == len(v):
                a, b = np.array(v, float), np.array(w, float)
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                scores.append((-round(float(a @ b / np.sqrt((a @ a) * (b @ b))), 12), j))
        out.update((i, n + 1, j, -s) for n, (s, j) in enumerate(sorted(scores)[:k]))
    return out


def found(rows):
    return collections.Counter((r.query_id, r["rank"], r.vec_id, round(r.score, 12)) for r in rows)


def test_lists_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    values = [[float(x) for x in np.float32(rng.standard_normal(6))] for _ in range(300)]
    # a third of the rows are copies of one vector, others are near it; some are lone in their length
    values += [values[4]] * 140 + [[float(x) for x in np.float32(np.array(values[4]) + rng.standard_normal(6) * 0.01)] for _ in range(60)]
    values += [[1.0, 2.0], [2.0, 4.1], [1.0, 0.0], [3e30] * 6, [1e-30] * 5 + [0.0], [5.0]]
    rows = [(i, v, i % 3, i) for i, v in enumerate(values)]
    rows += [rows[50], rows[50], (100, values[7], 1, 0), (None, values[8], 1, 0), (600, None, 0, 0), (650, [], 0, 0), (700, [0.0] * 6, 0, 0),
             (750, [None] + [1.0] * 5, 0, 0), (800, [float("nan")] * 6, 0, 0), (850, [float("inf")] * 6, 0, 0)]
    sound = [(k, r) for k, r in enumerate(rows)
             if r[0] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    s = graph.Settings(least_shard=100, growth=4, degree=16, build_beam=48, beam=80, starts=4, batch=32, query_block=3)
    got = found(graph.nearest(df, df.where("vec_id % 50 = 0"), 5, s).collect())
    want = exact(sound, [(k, r) for k, r in sound if r[0] % 50 == 0], 5)
    assert sum(got.values()) == sum(want.values())
    assert sum((got & want).values()) >= 0.98 * sum(want.values())
    # one in a length of its own has no neighbour, copies come by id
    assert not any(q == 505 for q, *_ in got)
    empty = spark.createDataFrame([], SCHEMA)
    assert graph.nearest(empty, empty, 5, s).count() == 0


def test_huge_and_tiny_doubles(spark):
    rows = [(i, [1e-170 * (i + 1), 1e-170, 0.0]) for i in range(40)] + [(i, [1e200, 1e200 * (i - 39), 1e199]) for i in range(40, 80)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = graph.nearest(df, df.where("vec_id % 50 = 0"), 3, graph.Settings(degree=8, beam=40)).collect()
    want = exact(list(enumerate(rows)), [(k, r) for k, r in enumerate(rows) if r[0] % 50 == 0], 3)
    assert len(got) == 6 and all(np.isfinite(r.score) for r in got)
    assert {(r.query_id, r["rank"], r.vec_id) for r in got} == {x[:3] for x in want}


def test_recall_in_large_shards():
    rng = np.random.default_rng(8)
    # clusters, one of them dense
    middle = rng.standard_normal((12, 32))
    x = graph.unit(np.concatenate([middle[rng.integers(0, 12, 5000)] + rng.standard_normal((5000, 32)) * 0.7,
                                   middle[0] + rng.standard_normal((1500, 32)) * 0.05])[rng.permutation(6500)])
    s = graph.Settings()
    g = graph.build_graph(x, s)
    assert (g.edges >= 0).sum(axis=1).min() > 0 and g.edges.max() < len(x)
    q = x[::50]
    near = graph.beam_search(g, q, s.beam, s)[0][:, :6]
    want = np.argsort(-(q @ x.T), axis=1)[:, :6]
    hits = sum(len(set(a) & set(b)) for a, b in zip(near.tolist(), want.tolist()))
    assert hits >= 0.95 * want.size


def test_pruning_keeps_diverse_neighbours():
    x = graph.unit(np.array([[1, 0, 0], [1, 0.2, 0], [1, 0.21, 0], [1, 0, 0.3]], float))
    g = graph.Graph(x, np.full((4, 3), -1, np.int32), 4)
    far = 2 - 2 * x[[1, 2, 3]] @ x[0]
    kept = graph.robust_prune(g, np.array([[1, 2, 3]], np.int32), far[None, :].astype(np.float32), graph.Settings(relax=1.2))
    # node 2 lies next to node 1, node 3 in another direction
    assert kept.tolist() == [[1, 3, -1]]
