"""Operators on vectors, pages and conversations, the registered SQL, and the pipeline."""

import collections
from pathlib import Path

import numpy as np
import pytest
from compare import difference, duck

import __spark_entry__ as entry
import corpus_pipeline
from trolley.llm import conversations, embedding_forest, url_filter
from trolley.llm.queries import QUERIES, URL_RULES

TABLES = "/root/testdata/sf0.001"


def test_vectors(spark):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(400):
        v = rng.standard_normal(8) if k % 3 else rows[0][1] + rng.standard_normal(8) * 0.1 if rows else rng.standard_normal(8)
        rows.append((k, v, k % 2))
    data = [(i, [float(x) for x in np.float32(v)], label) for i, v, label in rows]
    data += [(400, data[7][1], 1), (401, data[7][1], 0), (402, data[7][1], None), (403, None, 1), (404, [0.0] * 8, 1),
             (405, [float("nan")] + [1.0] * 7, 1), (406, [None] + [1.0] * 7, 1), (407, [float("inf")] * 8, 1), (408, [], 1),
             (409, [1.0, 2.0], 1), (410, [2.0, 4.0], 1), (411, [3e30] * 8, 0), data[9], (None, data[7][1], 1)]
    df = spark.createDataFrame([(*r, 1) for r in data], "vec_id bigint, embedding array<float>, label int, n_links int").repartition(3)
    s = embedding_forest.Settings(leaf=40, least_sample=8, block=16, trees=10)
    got = embedding_forest.near_duplicates(df, s).collect()
    sound = [(k, i, np.array(v), x) for k, (i, v, x) in enumerate(data)
             if i is not None and x is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    up = {i: i for _, i, _, _ in sound}
    n = collections.Counter()

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for k, a, v, x in sound:
        for m, b, w, y in sound:
            if k != m and x == y and len(v) == len(w) and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= 0.93:
                n[k] += 1
                up[max(find(a), find(b))] = min(find(a), find(b))
    want = collections.Counter((i, n[k], find(i) if i in up else i, i is None or find(i) == i if i in up else True)
                               for k, (i, _, _) in enumerate(data))
    found = collections.Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in got)
    # the forest may miss a pair, but may not add one
    assert sum(found.values()) == len(data) and sum(r.n_links for r in got) >= 0.99 * sum(n.values())
    assert sum((found & want).values()) >= 0.97 * len(data)
    none = embedding_forest.near_duplicates(df.limit(0), s)
    assert none.count() == 0


def test_forest_finds_each_pair_once_in_blocks(spark):
    data = [(i, [1.0, 0.001 * i], 1) for i in range(90)]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<float>, label int")
    rows = embedding_forest.near_duplicates(df, embedding_forest.Settings(leaf=10, least_sample=4, block=7)).collect()
    assert all((r.n_links, r.component_id) == (89, 0) for r in rows)


def test_large_leaves_are_cut_again(spark):
    """Cuts of a small sample leave large leaves; those are cut by samples of their own, but for the dense group of copies."""
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((600, 32))
    near = [centres[k % 600] + rng.standard_normal(32) * 0.05 for k in range(2400)]
    near += [centres[0] + rng.standard_normal(32) * 0.01 for _ in range(150)]
    x = np.array(near)
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>, label int").repartition(3)
    s = embedding_forest.Settings(leaf=40, sample=48, least_sample=8, most=100, again=120, block=64)
    vectors = df.selectExpr("vec_id AS rid", "CAST(label AS string) AS label", "1L AS weight", "embedding AS v")
    spots = embedding_forest.placed(vectors, embedding_forest.fit(vectors, len(x), s))
    before = [r["count"] for r in spots.groupBy("code").count().collect()]
    deep = embedding_forest.deepened(spots, s)
    after = [r["count"] for r in deep.groupBy("code").count().collect()]
    # comparisons within leaves
    assert sum(n * n for n in after) < 0.5 * sum(n * n for n in before)
    assert all(r.code in r.codes and r.codes == sorted(set(r.codes)) for r in deep.collect())
    got = {r.vec_id: r for r in embedding_forest.near_duplicates(df, s).collect()}
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    links = (unit @ unit.T >= 0.93).sum(axis=1) - 1
    assert all(got[i].n_links <= links[i] for i in range(len(x)))
    assert sum(r.n_links for r in got.values()) >= 0.99 * links.sum()


def test_huge_and_tiny_vectors_keep_their_links(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((200, 6))
    data = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, base * 1e-200, base * 1e250, base * 5e-308]))]
    df = spark.createDataFrame([(i, v, 1) for i, v in data], "vec_id bigint, embedding array<double>, label int")
    s = embedding_forest.Settings(leaf=40, least_sample=8, block=64)
    rows = {r.vec_id: r for r in embedding_forest.near_duplicates(df, s).collect()}
    assert all(rows[i].n_links >= 3 and rows[i].component_id == rows[i % 200].component_id for i, _ in data)


def test_urls(spark):
    urls = ["http://a.net/x", "http://example.net/en/1", "https://M.Example.NET/de/", "http://example.com/de/?q", "ftp://b.org/fr/",
            "http://notnet/x", "net", None, "://", "http://x.example.com#/de/", "http://example.com/de", "x://y://z.net/q", "http://net",
            "http://..net/", "http://org/fr/\n?", "http://" + "a." * 3000 + "net/"]
    df = spark.createDataFrame([(i, u, "old") for i, u in enumerate(urls)] + [(1, urls[1], "old")], "page_id bigint, url string, host string")
    rows = url_filter.filter_urls(df, URL_RULES).collect()
    assert len(rows) == len(urls) + 1
    for r in rows:
        rest = (r.url or "").partition("://")[2] if "://" in (r.url or "") else ""
        cut = min([k for k in (rest.find(c) for c in "/?#") if k >= 0], default=len(rest))
        host, tail = rest[:cut].lower(), rest[cut:]
        path = tail[: min([k for k in (tail.find(c) for c in "?#") if k >= 0], default=len(tail))]
        fits = [x for x in URL_RULES if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        best = max(fits, key=lambda x: len(x.key), default=None)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, best and best.key, best.verdict if best else "allow"), r.url
    assert url_filter.filter_urls(df.limit(0), URL_RULES).count() == 0
    assert {r.verdict for r in url_filter.filter_urls(df, [], default="block").collect()} == {"block"}


def test_cascade_is_exact(spark):
    universe = spark.range(4000).selectExpr("concat('k', id) AS key")
    listed = universe.where("crc32(key) % 13 = 0").union(universe.limit(5))
    levels = url_filter.build_cascade(listed, universe.union(universe))
    assert len(levels) > 2
    inside = {r.key for r in listed.collect()}
    from pyspark.sql import functions as F

    assert {r.key for r in universe.where(url_filter.is_listed(F.col("key"), levels)).collect()} == inside
    with pytest.raises(ValueError):
        url_filter.build_cascade(listed, universe, max_bits=64)


def test_conversations(spark):
    log = {1: ["a", "b"], 2: ["a", "b", "c"], 3: ["a"], 4: ["a", "x"], 5: ["a", "b", "c"], 6: [None, "b"], 7: ["", "b", "c"], 8: ["a", "b", "d"] * 60,
           None: ["q"]}
    rows = [(c, k * 2, "user" if k % 2 else None, t, 7) for c, ts in log.items() for k, t in enumerate(ts)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, part int").repartition(4)
    got = collections.defaultdict(list)
    for r in conversations.rendered(df).collect():
        got[r.conv_id].append((r.part, r.n_turns, r.text))
    assert set(got) == {2, 4, 7, 8, None}
    assert [p[:2] for p in sorted(got[8])] == [(0, 64), (1, 64), (2, 52)]
    assert got[2][0][2] == "<|im_start|>\na<|im_end|>\n<|im_start|>user\nb<|im_end|>\n<|im_start|>\nc<|im_end|>\n"
    assert conversations.rendered(df.limit(0)).count() == 0


def test_repeated_turns_count_as_turns(spark):
    df = spark.createDataFrame([(1, 0, "u", "a"), (1, 0, "u", "a"), (2, 0, "u", "a")], "conv_id bigint, turn bigint, role string, text string")
    assert [(r.conv_id, r.n_turns) for r in conversations.rendered(df).collect()] == [(1, 2)]


@pytest.mark.skipif(not Path(TABLES).exists(), reason="no test tables")
@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_query_matches_sql(spark, name):
    assert difference(entry.queries()[name](spark, TABLES), duck(TABLES), entry.oracle_sql()[name]) is None


def test_ten_queries_and_the_pipeline_are_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11)) and "pipeline" in entry.queries()


def test_pipeline_stages(docs, spark, tmp_path, texts):
    now = docs.drop("component_id")
    for name, step in corpus_pipeline.STAGES:
        now.write.parquet(f"{tmp_path}/{name}")
        before = spark.read.parquet(f"{tmp_path}/{name}")
        now = step(spark, before, str(tmp_path))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert now.columns == before.columns
    assert now.count() > 0
    docs.drop("component_id").write.parquet(f"{tmp_path}/documents.parquet")
    assert collections.Counter(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).drop("sequence_id", "offset").collect())) == \
        collections.Counter(map(tuple, now.drop("sequence_id", "offset").collect()))
