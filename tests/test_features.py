import pytest
from schemas import ITEM_SCHEMA, LOG_SCHEMA

from trolley.operators import features, pooling
from trolley.operators.features import FEATURE_COLUMNS
from trolley.operators.pairs import pair_aggregate


@pytest.fixture(scope="module")
def contract(spark):
    catalog = spark.createDataFrame([
        (0, 0, "A", 0, 10.0, True), (1, 0, "A", 1, 20.0, True), (2, 1, "B", 0, 30.0, False), (3, 1, "B", 1, 40.0, False),
    ], ITEM_SCHEMA)
    history = spark.createDataFrame([
        (0, 0, 0, 2, 1, 0), (0, 0, 10, 2, 1, 1), (0, 1, 5, 2, 1, 2),
    ], LOG_SCHEMA)
    lists = {
        "repeat": spark.createDataFrame([(0, 0, 0, 1.5)], "customer_id int, item_id int, rank int, score double"),
        "popularity": spark.createDataFrame(
            [(0, 3, 0, 2.0), (0, 0, 1, 1.0)], "customer_id int, item_id int, rank int, score double"),
    }
    return catalog, history, pooling.candidate_pool(lists)


def test_feature_contract(contract):
    catalog, history, pool = contract
    frame = features.feature_frame(pool, history, catalog, 12)
    rows = {r["item_id"]: r.asDict() for r in frame.collect()}
    assert rows[0]["ui_days_since"] == 2 and rows[0]["is_known_item"] == 1
    assert rows[3]["ui_days_since"] == 9999 and rows[3]["is_known_item"] == 0 and rows[3]["ui_n_purchase"] == 0
    assert rows[0]["ui_mean_gap"] == 5.0 and rows[0]["ui_due_ratio"] == pytest.approx(0.4)
    assert rows[3]["ui_mean_gap"] == -1.0 and rows[3]["uc_days_since"] == 9999
    assert rows[0]["n_sources"] == 2 and rows[0]["rr_popularity"] == 0.5 and rows[3]["rank_repeat"] == -1


def test_all_42_features_are_there(contract):
    catalog, history, pool = contract
    frame = features.feature_frame(pool, history, catalog, 12)
    assert len(FEATURE_COLUMNS) == len(set(FEATURE_COLUMNS)) == 42
    own = {c for c in frame.columns if c in FEATURE_COLUMNS}
    assert own == set(FEATURE_COLUMNS)
    rest = set(frame.columns) - own
    assert not {c for c in rest if c.startswith(("rr_", "in_", "score_"))}


def test_leak_is_an_error(contract):
    catalog, history, pool = contract
    with pytest.raises(Exception, match="leaks"):
        features.feature_frame(pool, history, catalog, 5).collect()


def test_blocks_against_plain_python(interactions, items, log):
    as_of = 11
    store = features.FeatureStore.build(interactions, items, as_of)
    mine = {(r["customer_id"], r["item_id"]): r for r in store.user_item.collect()}
    for key in {(c, i) for c, i, *_ in log}:
        rows = [r for r in log if (r[0], r[1]) == key]
        bought = sum(r[3] == 2 for r in rows)
        days = [r[2] for r in rows]
        got = mine[key]
        assert (got["ui_n_events"], got["ui_n_purchase"], got["ui_days_since"]) == (len(rows), bought, as_of - max(days))
        if bought > 1:
            assert got["ui_mean_gap"] == pytest.approx((max(days) - min(days)) / bought)
        else:
            assert got["ui_mean_gap"] is None
    price = {r["item_id"]: r["price"] for r in items.collect()}
    for r in store.user.collect():
        rows = [x for x in log if x[0] == r["customer_id"] and x[3] == 2]
        assert r["u_n_purchase"] == len(rows)
        assert r["u_n_distinct"] == len({x[1] for x in rows})
        assert r["u_mean_price"] == pytest.approx(sum(price[x[1]] for x in rows) / len(rows))
    shares = store.user_brand.groupBy("customer_id").sum("ub_share").collect()
    assert all(s[1] == pytest.approx(1.0) for s in shares)


def test_result_does_not_depend_on_partitioning(spark, interactions, items):
    def run(n):
        return sorted(map(tuple, pair_aggregate(interactions.repartition(n), 11).select(
            "customer_id", "item_id", "n_events", "qty", "last_day").collect()))

    assert run(1) == run(7)


def test_missing_user_price_is_null_not_an_error(spark, contract):
    catalog, history, pool = contract
    free = catalog.replace({10.0: 0.0, 20.0: 0.0}, subset=["price"])
    rows = features.feature_frame(pool, history, free, 12).collect()
    assert all(r["price_ratio"] is None for r in rows)
