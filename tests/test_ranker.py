"""Second stage: patience, the trees kept, and the pairwise ranker."""

import random

import pytest

from trolley.operators import metrics, pairwise, ranking
from trolley.plans import feature_job
from trolley.operators.pairs import merged, pair_aggregate
from trolley.sources import sinks

FEATURES = ["ui_n_purchase", "uc_share", "i_pop"]


@pytest.fixture(scope="module")
def labelled(spark):
    """Lists in which a bought item has more purchases than the others of its customer, whatever the level of the customer."""
    rng = random.Random(3)
    rows = []
    for c in range(120):
        level = rng.randrange(0, 400)
        for i in range(20):
            bought = int(i < (c % 5))
            rows.append((c, i * 7 + c % 3, bought, float(level + 3 * bought + rng.random()), rng.random() if rng.random() < 0.9 else None, rng.random()))
    rows += [(500, 1, 1, 1.0, 0.0, 0.0), (501, 1, 0, 1.0, 0.0, 0.0)]
    return spark.createDataFrame(rows, "customer_id bigint, item_id bigint, label int, ui_n_purchase double, uc_share double, i_pop double").repartition(4)


def test_patience_outlasts_a_noisy_start():
    assert ranking.best_prefix([0.9, 0.95, 0.8, 0.7, 0.71, 0.72], 40) == (4, False)
    assert ranking.best_prefix([0.9, 0.95, 0.96, 0.97, 0.1], 3) == (1, True)
    assert ranking.best_prefix([0.5, 0.6, 0.4, 0.41, 0.42], 2) == (3, True)
    assert ranking.best_prefix([], 5) == (0, False)


def test_kept_trees_score_as_the_prefix(labelled):
    model = ranking.train_ranker(labelled, FEATURES, trees=12, depth=3, learning_rate=0.6, patience=2)
    assert 1 <= model.kept_trees <= model.trained_trees <= 12 and len(model.holdout_errors) == model.trained_trees
    assert model.getNumTrees == model.kept_trees and model.kept_trees == ranking.best_prefix(model.holdout_errors, 2)[0]
    scored = ranking.score_candidates(model, labelled, FEATURES)
    assert scored.count() == labelled.count() and scored.where("score < 0 or score > 1 or score is null").count() == 0
    assert ranking.feature_importance(model, labelled.sparkSession, FEATURES).count() == 3


def test_pairs_are_bounded_and_of_one_customer(labelled):
    rows = pairwise.pairs(labelled, 2, 5, FEATURES).collect()
    by = {}
    for r in labelled.collect():
        by.setdefault(r.customer_id, {}).setdefault(r.label, set()).add(r.item_id)
    count = {}
    for r in rows:
        assert r.item_id in by[r.customer_id][1] and r.other_id in by[r.customer_id][0] and len(r.difference) == 3
        count[r.customer_id] = count.get(r.customer_id, 0) + 1
    assert count == {c: min(len(x.get(1, ())), 2) * min(len(x.get(0, ())), 5) for c, x in by.items() if x.get(1) and x.get(0)}


def test_pairs_learn_the_order_within_lists(labelled, spark):
    model = pairwise.train_pairwise(labelled, FEATURES)
    truth = labelled.where("label = 1").select("customer_id", "item_id")

    def ndcg(scored):
        ranked = ranking.rank_candidates(scored, 50)
        return {r.k: r.ndcg for r in metrics.ranking_metrics(ranked, truth).collect()}[10]

    # no level of the score separates bought from not bought items over all customers
    assert ndcg(pairwise.score_pairwise(model, labelled)) > 0.9
    none = pairwise.train_pairwise(labelled.where("label = 0"), FEATURES)
    assert none.weights == (0.0, 0.0, 0.0)


def _same(a, b):
    a, b = ({(r.customer_id, r.item_id): r.asDict() for r in x.collect()} for x in (a, b))
    assert a.keys() == b.keys()
    for key, row in a.items():
        for name, value in row.items():
            other = b[key][name]
            assert value == other or abs(value - other) < 1e-9 * max(1, abs(value)), (key, name, value, other)


def test_states_move_on_by_days(interactions):
    whole = pair_aggregate(interactions, 11)
    state = pair_aggregate(interactions.where("day <= 4"), 4)
    for day in range(5, 12):
        state = merged([state, pair_aggregate(interactions.where(f"day = {day}"), day)], day)
    _same(state, whole)


def test_incremental_job_reads_the_new_days_and_takes_late_ones_in(spark, interactions, items, tmp_path):
    events, catalog, candidates, one, two, states = (str(tmp_path / n) for n in ("events", "catalog", "candidates", "one", "two", "states"))
    sinks.write_interactions(interactions.where("day <= 8 and not (day = 6 and item_id = 3)"), events)
    items.write.parquet(catalog)
    interactions.select("customer_id", "item_id").distinct().write.parquet(candidates)
    for day in (5, 7, 8):
        feature_job.run_next(spark, events, catalog, candidates, two, states, day)
    new = feature_job.next_state(spark, events, states, 9)
    assert sorted(r[0] for r in spark.read.parquet(states).select("as_of_day").distinct().collect()) == [5, 7, 8]
    # the log is cut to the days behind the state at the scan
    text = new._jdf.queryExecution().executedPlan().toString()
    assert "(day#" in text and "> 8)" in text.split("PartitionFilters", 1)[1]
    # day 6 is written again with what came late: everything from there on is done anew from the state of day 5
    sinks.write_interactions(interactions.where("day <= 8"), events)
    assert feature_job.state_before(spark, states, 6) == 5
    feature_job.run_next(spark, events, catalog, candidates, two, states, 8, late_from=6)
    feature_job.run(spark, events, catalog, candidates, one, 8)
    _same(spark.read.parquet(two).where("as_of_day = 8"), spark.read.parquet(one))
