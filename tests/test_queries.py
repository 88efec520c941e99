"""Registered queries against their reference SQL on the smallest tables. The whole set: tests/compare.py."""

from pathlib import Path

import pytest
from compare import difference, duck

import __spark_entry__ as entry

TABLES = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(TABLES).exists(), reason="no test tables")
NAMES = [
    "load_events_cut", "event_profile", "split_summary", "basket_size_stats", "salted_join", "causal_sequences",
    "causal_sequences_orders", "inference_state", "log_q", "price_buckets", "user_features", "item_features_orders",
    "feature_frame", "candidate_diagnostics", "feature_null_profile", "repeat_backfill", "item_knn",
    "item_similarity_orders", "vector_topk", "rrf_blend", "slate_health", "leaderboard", "source_contribution",
    "batch_slate", "tfidf_search", "grounding_check", "governance_summary", "latency_percentiles", "call_budget",
]


@pytest.fixture(scope="module")
def con():
    return duck(TABLES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    assert difference(entry.queries()[name](spark, TABLES), con, entry.oracle_sql()[name]) is None


def test_every_query_is_registered_once_and_oracles_have_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 70


def test_entry(spark):
    assert entry.entry(spark).count() == 4
