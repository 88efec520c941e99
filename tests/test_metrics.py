"""Ranking metrics and slate health on small slates worked out by hand."""

from math import log2

import pytest

from trolley.operators import diagnostics, metrics

# Slates and held-out purchases of three customers: Ana (10) finds two of her three at places 2 and 5, Bo (20) finds the
# one at place 4, Cy (30) gets no slate.
SLATES = {10: [41, 12, 43, 44, 15], 20: [51, 52, 53, 24]}
BOUGHT = {10: [12, 15, 18], 20: [24], 30: [31, 32]}


def frames(spark, slates=SLATES, bought=BOUGHT):
    ranked = [(c, i, place) for c, items in slates.items() for place, i in enumerate(items)]
    return (spark.createDataFrame(ranked, "customer_id bigint, item_id bigint, rank int"),
            spark.createDataFrame([(c, i) for c, items in bought.items() for i in items], "customer_id bigint, item_id bigint"))


# Per cut-off, the means over the three customers.
WANT = {
    2: dict(recall=(1 / 3) / 3, precision=(1 / 2) / 3, hit_rate=1 / 3, map=(1 / 2 / 2) / 3, ndcg=(1 / log2(3)) / (1 + 1 / log2(3)) / 3),
    4: dict(recall=(1 / 3 + 1) / 3, precision=(1 / 4 + 1 / 4) / 3, hit_rate=2 / 3, map=(1 / 2 / 3 + 1 / 4) / 3,
            ndcg=((1 / log2(3)) / (1 + 1 / log2(3) + 1 / 2) + 1 / log2(5)) / 3),
    5: dict(recall=(2 / 3 + 1) / 3, precision=(2 / 5 + 1 / 5) / 3, hit_rate=2 / 3, map=((1 / 2 + 2 / 5) / 3 + 1 / 4) / 3,
            ndcg=((1 / log2(3) + 1 / log2(6)) / (1 + 1 / log2(3) + 1 / 2) + 1 / log2(5)) / 3),
}


@pytest.mark.parametrize("k", list(WANT))
def test_ranking_at(spark, k):
    got = metrics.ranking_metrics(*frames(spark), (k,)).first().asDict()
    assert {m: got[m] for m in WANT[k]} == pytest.approx(WANT[k])
    assert got["customers"] == 3


def test_first_place_counts_more_than_last(spark):
    early, late = (metrics.ranking_metrics(*frames(spark, {1: s}, {1: [5]}), (4,)).first() for s in ([5, 6, 7, 8], [6, 7, 8, 5]))
    assert early["ndcg"] == pytest.approx(1) and late["ndcg"] == pytest.approx(1 / log2(5)) and early["recall"] == late["recall"]


def health(spark, slates, bought, prices, shares, k):
    items = spark.createDataFrame([(i, float(p)) for i, p in prices.items()], "item_id bigint, price double")
    pop = spark.createDataFrame([(i, float(x)) for i, x in shares.items()], "item_id bigint, base_popularity double")
    return metrics.slate_health(*frames(spark, slates, bought), items, pop, k).first().asDict()


def test_slate_health(spark):
    # six slots: item 3 three times, item 4 twice, item 5 once; seven items in the catalog
    slates = {1: [3, 4], 2: [3, 5], 7: [4, 3]}
    got = health(spark, slates, {1: [4], 2: [5, 3], 7: [9]}, {3: 2.5, 4: 8, 5: 20, 6: 1, 8: 1, 9: 400, 11: 1},
                 {3: 0.25, 4: 0.125, 5: 1 / 64}, 2)
    assert got["coverage"] == pytest.approx(3 / 7)
    assert got["novelty"] == pytest.approx((3 * 2 + 2 * 3 + 1 * 6) / 6)
    assert got["gini"] == pytest.approx((-2 * 1 + 0 * 2 + 2 * 3) / (3 * 6))
    assert got["revenue_hit"] == pytest.approx((8 + 20 + 2.5) / 3)


def test_health_reads_the_first_k_places_only(spark):
    wide = health(spark, {1: [3, 4, 5]}, {1: [5]}, {3: 1, 4: 1, 5: 7}, {3: 0.5, 4: 0.5, 5: 0.5}, 3)
    narrow = health(spark, {1: [3, 4, 5]}, {1: [5]}, {3: 1, 4: 1, 5: 7}, {3: 0.5, 4: 0.5, 5: 0.5}, 2)
    assert (wide["revenue_hit"], narrow["revenue_hit"]) == (7, 0) and narrow["coverage"] == pytest.approx(2 / 3)


@pytest.mark.parametrize("counts,want", [([4, 4, 4], 0), ([1, 10, 1], 18 / 36), ([1, 2, 3, 10], 28 / 64)])
def test_gini(spark, counts, want):
    assert metrics.gini(spark.createDataFrame([(c,) for c in counts], "n int"), "n").first()[0] == pytest.approx(want)


def test_leaderboard_order(spark):
    rows = [metrics.wide_metrics(name, metrics.ranking_metrics(*frames(spark, {10: slate}), (5,)), (5,))
            for name, slate in (("none", [1, 2]), ("both", [12, 15]), ("one", [2, 18]))]
    assert [r["model"] for r in metrics.leaderboard(rows, "recall@5").collect()] == ["both", "one", "none"]


def test_recall_by_depth_keeps_every_customer(spark):
    ranked, bought = frames(spark)
    depth = spark.createDataFrame([(10, 10_001), (20, 5)], "customer_id bigint, depth bigint")
    got = {r["history_purchases"]: (r["customers"], r["recall"]) for r in diagnostics.recall_by_depth(ranked, bought, depth, 20).collect()}
    assert got == {"60+": (1, pytest.approx(2 / 3)), "1-5": (1, 1.0), "0": (1, 0.0)}


def test_freshness(spark):
    pairs = spark.createDataFrame([(1, 1, 9, 7), (2, 2, 4, None), (3, 5, 8, 8)], "customer_id bigint, item_id bigint, last_day int, last_purchase int")
    items = spark.createDataFrame([(1,), (2,)], "item_id bigint")
    got = {r["block"]: (r["latest_day"], r["age_days"]) for r in diagnostics.feature_freshness(pairs, items, 10).collect()}
    assert got == {"user_item": (9, 1), "user": (8, 2), "user_category": (8, 2), "user_brand": (8, 2), "item": (7, 3)}
