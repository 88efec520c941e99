"""Properties of executed and planned queries that keep them cheap at scale."""

import json
from pathlib import Path

import pytest

from trolley.operators import retrieval, similarity
from trolley.plans import feature_job
from trolley.plans.setting import OrdersSetting
from trolley.sources import sinks

TABLES = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("pairs", [similarity.PAIRS, 400])
def test_item_similarity_shuffles_no_row_per_pair(spark, pairs):
    # one customer holds every item, a third of all cells, and every customer item 0
    rows = [(0, i, 1.0 + i % 3) for i in range(300)] + [(1 + i % 60, (i * 7) % 300, 1.0) for i in range(600)] + [(1 + c, 0, 2.0) for c in range(60)]
    matrix = spark.createDataFrame(rows, "customer_id bigint, item_id bigint, r double").groupBy("customer_id", "item_id").sum("r").toDF("customer_id", "item_id", "r")
    found = similarity.item_similarity(matrix, 5, segment=32, pairs=pairs)
    text = plan(found)
    if pairs == similarity.PAIRS:
        # what the products give is final: nothing is exchanged behind them
        assert "Exchange" not in text[: text.index("FlatMapGroupsInArrow")]
    else:
        # heavy blocks are cut, their sums limited on the map side
        assert "WindowGroupLimit" in text
    got = found.collect()
    cells = {}
    for r in matrix.collect():
        cells.setdefault(r["item_id"], {})[r["customer_id"]] = r["r"]
    norm = {i: sum(x * x for x in c.values()) ** 0.5 + 1e-8 for i, c in cells.items()}
    for i in (0, 7, 299):
        sims = {j: sum(x * cells[j].get(c, 0) for c, x in cells[i].items()) / (norm[i] * norm[j] + similarity.SHRINKAGE)
                for j in cells if j != i}
        best = sorted(sims, key=lambda j: (-round(sims[j], 9), j))[:5]
        assert [r["item_j"] for r in sorted(got, key=lambda r: r["rank"]) if r["item_i"] == i] == best
    assert similarity.item_similarity(matrix.limit(0), 5).count() == 0


@pytest.mark.skipif(not Path(TABLES).exists(), reason="no test tables")
def test_order_dates_reach_the_scan(spark):
    text = plan(OrdersSetting(spark, TABLES).train)
    assert "o_orderdate" in text.split("PushedFilters", 1)[1] and "LessThan(o_orderdate" in text


def test_daily_job_reads_the_log_once(spark, interactions, items, tmp_path, monkeypatch):
    events, catalog, candidates, out = (str(tmp_path / n) for n in ("events", "catalog", "candidates", "out"))
    sinks.write_interactions(interactions, events)
    items.write.parquet(catalog)
    interactions.select("customer_id", "item_id").distinct().write.parquet(candidates)
    read = []
    monkeypatch.setattr(feature_job, "stage", lambda df, name: read.append(df.inputFiles()) or staged(df, name))
    from trolley.session import stage as staged

    kept = []
    monkeypatch.setattr(feature_job, "write_features", lambda frame, path: kept.append(frame) or sinks.write_features(frame, path))
    feature_job.run(spark, events, catalog, candidates, out, 8)
    assert sum(any(f"{tmp_path}/events" in f for f in files) for files in read) == 1
    assert events not in json.dumps(kept[0].inputFiles()) and spark.read.parquet(out).count() > 0


def test_ids_beyond_32_bits(spark):
    pairs = spark.createDataFrame([(2**40 + c, 2**41 + i, 1.0, 3) for c in range(6) for i in range(6) if (c + i) % 2],
                                  "customer_id bigint, item_id bigint, implicit_w double, last_day int").selectExpr("*", "3 AS as_of_day")
    asked = pairs.select("customer_id").distinct()
    got = retrieval.als_topk(pairs, asked, 2, factors=2, iterations=2).collect()
    assert len(got) == 12 and all(r["customer_id"] >= 2**40 and r["item_id"] >= 2**41 for r in got)


def test_staged_folders_go_when_the_job_is_done(spark, monkeypatch):
    from trolley import session

    monkeypatch.setattr(session, "_WRITTEN", {})
    frame = session.stage(spark.range(5), "released")
    (path,) = session._WRITTEN[spark.sparkContext.applicationId]
    assert frame.count() == 5 and Path(path.removeprefix("file://")).exists()
    session.release(spark)
    assert not Path(path.removeprefix("file://")).exists()


@pytest.mark.skipif(not Path(TABLES).exists(), reason="no test tables")
def test_a_setting_aggregates_the_log_once_per_day(spark):
    from trolley.plans.setting import Setting

    s = Setting(spark, TABLES)
    assert s.pairs() is s.pairs(s.train_end) and s.pairs(s.valid_end) is not s.pairs()
    assert "events.parquet" not in json.dumps(s.pairs().inputFiles())
