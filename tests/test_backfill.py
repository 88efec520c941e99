from pathlib import Path

import pytest

from trolley.plans import feature_queries

TABLES = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(TABLES).exists(), reason="no test tables")
def test_the_day_that_is_written_again_is_computed_once(spark, monkeypatch):
    read, write = [], feature_queries.sinks.write_features
    monkeypatch.setattr(feature_queries.sinks, "write_features", lambda frame, path: read.append(frame.inputFiles()) or write(frame, path))
    rows = feature_queries.feature_backfill(spark, TABLES)
    assert len(read) == 3 and read[1] == read[2] and all("/day-" in f for f in read[1])
    assert rows.groupBy("customer_id", "item_id", "as_of_day").count().where("count > 1").isEmpty()
