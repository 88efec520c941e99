"""Bucketed feature blocks: same features, no exchange on the side of the blocks."""

import pytest

from trolley.operators import blocks
from trolley.operators.features import FeatureStore

COLUMNS = ["customer_id", "item_id", "ui_n_purchase", "ui_days_since", "u_mean_price", "uc_n", "uc_share", "ub_n", "i_n_buyers", "price_ratio"]


def rows(frame):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in frame.na.fill(-7.0).na.fill(-7).select(*COLUMNS).collect())


@pytest.fixture()
def unbroadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture()
def candidates(spark, interactions):
    new = spark.createDataFrame([(999, 3), (0, 31)], "customer_id int, item_id int")
    return interactions.select("customer_id", "item_id").distinct().union(new).distinct()


def test_buckets_follow_the_rows():
    assert [blocks.buckets_for(n) for n in (0, 8_000_000, 8_000_001, 100_000_000)] == [8, 8, 16, 128]


def test_same_features_and_only_candidates_move(spark, interactions, items, candidates, tmp_path, unbroadcast):
    plain = FeatureStore.build(interactions.where("day < 8"), items, 8)
    want = rows(plain.transform(candidates))
    kept = blocks.BucketedBlocks(str(tmp_path / "store"), 4)
    kept.write(plain)
    kept.write(plain)
    staged = str(tmp_path / "candidates")
    candidates.write.parquet(staged)
    found = blocks.transform(kept.read(spark, 8), spark.read.parquet(staged))
    plan = found._jdf.queryExecution().executedPlan().toString()
    # candidates and items by item, then candidates by customer
    assert plan.count("Exchange") == 3 and plan.count("SelectedBucketsCount: 4 out of 4") == 4
    assert rows(found) == want
    # another session knows the files only
    for name in blocks.BY_CUSTOMER:
        spark.sql(f"DROP TABLE {kept._table(name, 8)}")
    again = blocks.transform(kept.read(spark, 8), spark.read.parquet(staged))
    assert again._jdf.queryExecution().executedPlan().toString().count("Exchange") == 3
    assert rows(again) == want


def test_blocks_without_rows(spark, interactions, items, candidates, tmp_path):
    plain = FeatureStore.build(interactions.where("day < -1"), items, 8)
    kept = blocks.BucketedBlocks(str(tmp_path), 4)
    kept.write(plain)
    assert rows(blocks.transform(kept.read(spark, 8), candidates)) == rows(plain.transform(candidates))
