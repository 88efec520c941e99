import numpy as np
import pytest

from trolley.functions.quantiles import exact_percentiles, order_statistics
from trolley.operators import documents, joins
from trolley.sources import sinks
from pyspark.sql import functions as F


def test_percentiles_with_one_heavy_value(spark):
    rng = np.random.default_rng(1)
    data = {"a": np.r_[np.full(4000, 2.5), rng.normal(size=8000)], "b": rng.integers(0, 5, 37).astype(float), "c": np.array([1.0])}
    rows = [(g, float(v)) for g, vs in data.items() for v in vs] + [("a", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probs = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    for r in exact_percentiles(df, ["g"], "v", probs).collect():
        want = np.quantile(data[r["g"]], list(probs.values()))
        assert r["n"] == len(data[r["g"]])
        assert [r[p] for p in probs] == pytest.approx(list(want))


def test_upper_median(spark):
    df = spark.createDataFrame([(float(x),) for x in (4, 1, 3, 2)], "v double")
    assert order_statistics(df, [], "v", {"m": (0.5, "n div 2")}).first()["m"] == 3.0


def test_salted_join_equals_plain_join(spark, interactions):
    totals = interactions.groupBy("item_id").agg(F.count(F.lit(1)).alias("n")).filter("item_id % 3 = 0")
    salted = joins.salted_left_join(interactions, totals, ["item_id"], [F.col("event_seq")], 8)
    plain = interactions.join(totals, "item_id", "left").select(*salted.columns)
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


def test_feature_rewrite_replaces_one_day(spark, tmp_path):
    path = str(tmp_path / "features")
    day = lambda d, n: spark.range(n).select("id", F.lit(d).alias("as_of_day"))
    for d, n in ((1, 3), (2, 4), (2, 5)):
        sinks.write_features(day(d, n), path)
    got = {r["as_of_day"]: r["count"] for r in spark.read.parquet(path).groupBy("as_of_day").count().collect()}
    assert got == {1: 3, 2: 5}


def test_log_is_pruned_by_day(spark, interactions, tmp_path):
    from trolley.sources.tables import load_events

    path = str(tmp_path / "log")
    sinks.write_interactions(interactions, path)
    cut = load_events(spark, path, 4)
    assert cut.count() == interactions.filter("day <= 4").count()
    assert "PartitionFilters: [isnotnull(day" in cut._jdf.queryExecution().toString()


def tfidf(texts):
    import math
    import re
    from collections import Counter

    counts = []
    for t in texts:
        tok = re.findall(r"\w\w+", t.lower())
        counts.append(Counter(tok + [f"{a} {b}" for a, b in zip(tok, tok[1:])]))
    df = Counter(term for c in counts for term in c)
    idf = {t: math.log((1 + len(texts)) / (1 + n)) + 1 for t, n in df.items()}
    out = []
    for c in counts:
        w = {t: (1 + math.log(n)) * idf[t] for t, n in c.items()}
        norm = math.sqrt(sum(x * x for x in w.values())) or 1
        out.append({t: x / norm for t, x in w.items()})
    return out


def test_tfidf(spark):
    texts = ["Green apple green apple", "Äpfel und grüne Birnen", "apple pie, apple_pie", "a b", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    counts = documents.term_counts(docs, "doc_id", "text")
    n = documents.corpus_size(docs)
    want = tfidf(texts)
    got = {(r["doc_id"], r["term"]): r["weight"] for r in documents.tfidf_weights(counts, n).collect()}
    assert got == pytest.approx({(i, t): w for i, d in enumerate(want) for t, w in d.items()})
    queries = spark.createDataFrame([(0, "apple pie"), (1, "unknown words")], "query_id int, query string")
    hits = documents.tfidf_search(documents.tfidf_index(counts, n), queries, 2).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["doc_id"]) for r in hits] == [(0, 2), (0, 0)]


def test_questions_without_a_match(spark):
    docs = spark.createDataFrame([(1, "item_1", "milk and honey")], "item_id int, tag string, text string")
    counts = documents.term_counts(docs, "item_id", "text")
    asks = spark.createDataFrame([(0, "honey"), (1, "stone")], "query_id int, query string")
    got = {r["query_id"]: r for r in documents.qa_context(docs, documents.tfidf_index(counts, documents.corpus_size(docs), "item_id"), asks).collect()}
    assert got[0]["context"] == "RETRIEVED PRODUCTS:\n- [item_1] milk and honey" and got[0]["allowed_ids"] == ["item_1"]
    assert got[1]["context"] == documents.NO_MATCH and got[1]["allowed_ids"] == []


def test_brackets_of_many_distinct_values_are_cut_again(spark):
    n = 200_000
    df = spark.range(n).selectExpr("id % 2 AS g", "cast((id * 7919) % 200003 AS double) AS v")
    rows = exact_percentiles(df, ["g"], "v", {"p50": 0.5, "p99": 0.99}).collect()
    for r in rows:
        values = sorted(float((i * 7919) % 200003) for i in range(n) if i % 2 == r["g"])
        for name, p in (("p50", 0.5), ("p99", 0.99)):
            at = p * (len(values) - 1)
            lo, hi = values[int(at)], values[min(int(at) + 1, len(values) - 1)]
            assert r[name] == lo + (hi - lo) * (at - int(at))
