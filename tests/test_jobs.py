import json
from pathlib import Path

import pytest

from trolley.operators import pooling, retrieval
from trolley.operators.features import FEATURE_COLUMNS
from trolley.operators.pairs import pair_aggregate
from trolley.plans import evaluation_job, feature_job
from trolley.sources import sinks

TABLES = "/root/testdata/sf0.001"


def test_feature_job_is_idempotent(spark, interactions, items, tmp_path):
    paths = {name: str(tmp_path / name) for name in ("events", "catalog", "candidates", "output")}
    sinks.write_interactions(interactions, paths["events"])
    items.write.parquet(paths["catalog"])
    pairs = pair_aggregate(interactions, 11)
    asked = interactions.select("customer_id").distinct()
    pooling.candidate_pool({
        "repeat": retrieval.repeat_purchase(pairs, asked, 5),
        "popularity": retrieval.popularity_topk(pairs, items, asked, 5),
    }).write.parquet(paths["candidates"])
    for day in (8, 11, 11):
        feature_job.run(spark, **paths, as_of_day=day)
    out = spark.read.parquet(paths["output"])
    n = spark.read.parquet(paths["candidates"]).count()
    assert {r["as_of_day"]: r["count"] for r in out.groupBy("as_of_day").count().collect()} == {8: n, 11: n}
    assert set(FEATURE_COLUMNS) <= set(out.columns)


@pytest.mark.skipif(not Path(TABLES).exists(), reason="no test tables")
def test_evaluation_job_reports(spark, tmp_path):
    out = str(tmp_path / "reports")
    evaluation_job.run(spark, TABLES, out, trees=2, depth=2, als={"factors": 4, "iterations": 2})
    board = spark.read.csv(f"{out}/baselines", header=True, inferSchema=True)
    assert {r["model"] for r in board.collect()} == {"popularity", "repeat", "item_knn", "als", "vector", "blend"}
    assert board.select("fit_until").distinct().count() == 2
    assert spark.read.csv(f"{out}/ranker", header=True).count() == 1
    assert spark.read.csv(f"{out}/ranker_importance", header=True).count() == 42
    analysis = json.loads(next(Path(out, "analysis").glob("*.json")).read_text())
    assert 0 <= analysis["repeat_vs_discovery"]["repeat_recall"] <= 1 and len(analysis["source_contribution"]) == 4


def test_write_reports_what_it_stored(spark, tmp_path):
    frame = spark.createDataFrame([(1, 2.0, 3), (2, None, 4), (None, None, 4)], "customer_id int, x double, as_of_day int").repartition(3)
    out = str(tmp_path / "features")
    want = {"rows": 3, "latest_day": 4, "nulls_customer_id": 1, "nulls_x": 2, "nulls_as_of_day": 0}
    assert sinks.write_observed(frame, out) == want == sinks.write_observed(frame, out)
    assert spark.read.parquet(out).count() == 3
    empty = sinks.write_observed(frame.limit(0), str(tmp_path / "none"))
    assert empty["rows"] == empty["nulls_x"] == 0 and empty["latest_day"] is None
