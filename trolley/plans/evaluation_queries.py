"""Registered queries over ranking metrics, diagnostics, the second stage and slates."""

from __future__ import annotations

from pyspark.sql import functions as F

from trolley.operators import diagnostics, metrics, pairwise, ranking, retrieval, vectors
from trolley.operators.features import FEATURE_COLUMNS
from trolley.operators.split import purchases_only
from trolley.plans.common import rounded
from trolley.plans.oracle import build
from trolley.plans.setting import LINEAR_WEIGHTS, Setting
from trolley.session import scratch, stage
from trolley.sources import sinks, tables

K = 20
BOARD_K = (5, 10, 20)
METRICS = ("recall", "precision", "hit_rate", "ndcg", "map")


def _repeat_lists(s: Setting):
    return stage(retrieval.repeat_backfill(s.pairs(), s.items, s.asked, 50), "lists")


def ranking_metrics(spark, d):
    """Recall, precision, hit rate, NDCG and MAP of the repeat baseline on the future week."""
    s = Setting(spark, d)
    return rounded(metrics.ranking_metrics(_repeat_lists(s), s.test_truth))


def slate_health(spark, d):
    s = Setting(spark, d)
    return rounded(metrics.slate_health(_repeat_lists(s), s.test_truth, s.items, s.base_popularity(s.pairs())))


def leaderboard(spark, d):
    s = Setting(spark, d)
    truth, asked, pairs = s.test_truth, s.asked, s.pairs()
    models = {
        "popularity": retrieval.popularity_topk(pairs, s.items, asked, K),
        "repeat": retrieval.repeat_backfill(pairs, s.items, asked, K),
        "item_knn": retrieval.item_knn(pairs, s.items, asked, K),
        "vector": vectors.vector_topk(s.user_vectors(s.train_end, asked), s.vectors, K),
    }
    rows = [
        metrics.wide_metrics(name, metrics.ranking_metrics(lists, truth, BOARD_K), BOARD_K)
        for name, lists in models.items()
    ]
    return rounded(metrics.leaderboard(rows, "recall@20"))


def _scored(s: Setting):
    return s.labelled().withColumn("score", ranking.linear_score(LINEAR_WEIGHTS))


def rank_candidates(spark, d):
    return rounded(
        ranking.rank_candidates(_scored(Setting(spark, d)), K).select("customer_id", "item_id", "rank", "score", "label")
    )


def repeat_vs_discovery(spark, d):
    s = Setting(spark, d)
    slate = ranking.rank_candidates(_scored(s), K)
    return rounded(diagnostics.repeat_vs_discovery(slate, s.test_truth, diagnostics.known_items(s.history)))


def recall_by_depth(spark, d):
    s = Setting(spark, d)
    slate = ranking.rank_candidates(_scored(s), K)
    return rounded(diagnostics.recall_by_depth(slate, s.test_truth, diagnostics.history_depth(s.history)))


def source_contribution(spark, d):
    return rounded(diagnostics.source_contribution(_scored(Setting(spark, d)), K))


def reason_text(spark, d):
    slate = ranking.rank_candidates(_scored(Setting(spark, d)), K)
    return slate.select("customer_id", "item_id", ranking.reason_text().alias("reason"))


def batch_slate(spark, d):
    """Slates for the whole customer table: personal where there is a purchase, popular else."""
    s = Setting(spark, d)
    known = stage(purchases_only(s.history).select("customer_id").distinct(), "known")
    frame = s.feature_frame(s.valid_end, known)
    scored = frame.withColumn("score", ranking.linear_score(LINEAR_WEIGHTS))
    popular = retrieval.popularity_slate(retrieval.item_popularity(s.pairs(s.valid_end), s.items), K)
    return rounded(ranking.batch_slate(tables.customers(spark, d), scored, popular, s.items, K))


#: Fitted rankers and their train frames, by application and tables: two queries share one fit.
_FITTED: dict[tuple[str, str], tuple] = {}


def _train_frame(s: Setting):
    return s.once("train-frame", s.train_end, lambda: s.labelled("valid"))


def _trained(s: Setting):
    """Ranker fitted on the train stage; the frame is read once per tree level, hence staged."""
    key = (s.spark.sparkContext.applicationId, s.folder)
    if key not in _FITTED:
        _FITTED[key] = ranking.train_ranker(_train_frame(s))
    return _FITTED[key]


def two_stage_ranker(spark, d):
    s = Setting(spark, d)
    scored = ranking.score_candidates(_trained(s), s.labelled())
    return rounded(metrics.ranking_metrics(ranking.rank_candidates(scored, 50), s.test_truth))


def feature_importance(spark, d):
    return rounded(ranking.feature_importance(_trained(Setting(spark, d)), spark, FEATURE_COLUMNS))


def ranker_trees(spark, d):
    """Trees grown and kept, and the lowest hold-out error."""
    model = _trained(Setting(spark, d))
    return rounded(spark.createDataFrame(
        [(model.trained_trees, model.kept_trees, float(min(model.holdout_errors, default=0.0)))], "trained int, kept int, holdout_error double"))


def ranker_pairs(spark, d):
    """Bought and not bought candidates that the pairwise ranker holds against each other, by customer."""
    return pairwise.pairs(Setting(spark, d).labelled()).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("pairs"), F.count_distinct("item_id").alias("bought"), F.count_distinct("other_id").alias("others"))


def pairwise_ranker(spark, d):
    """Metrics of the linear ranker fitted on pairs of the train stage, beside those of the transparent weights."""
    s = Setting(spark, d)
    frame = stage(s.labelled(), "test-frame")
    model = pairwise.train_pairwise(_train_frame(s))
    parts = [
        metrics.ranking_metrics(ranking.rank_candidates(scored, 50), s.test_truth).withColumn("model", F.lit(name))
        for name, scored in (("pairwise", pairwise.score_pairwise(model, frame)),
                             ("weights", frame.withColumn("score", ranking.linear_score(LINEAR_WEIGHTS))))
    ]
    return rounded(parts[0].unionByName(parts[1]))


def evaluated_blend(spark, d):
    """The blend that the evaluation job reports: repeat purchase, nearest neighbours and factorization."""
    s = Setting(spark, d)
    pairs = s.pairs()
    lists = {
        "repeat": retrieval.repeat_backfill(pairs, s.items, s.asked, 3 * K),
        "item_knn": retrieval.item_knn(pairs, s.items, s.asked, 3 * K),
        "als": retrieval.als_topk(pairs, s.asked, 3 * K),
    }
    return rounded(retrieval.rrf_blend([(lists[n], w) for n, w in retrieval.BLEND_WEIGHTS.items()], K))


def scored_frame(spark, d):
    path = scratch(spark, "scored")
    sinks.write_scored(_scored(Setting(spark, d)), path)
    return rounded(spark.read.parquet(path))


def report_roundtrip(spark, d):
    """A report written as CSV and as JSON, read back from both."""
    report = source_contribution(spark, d)
    path = scratch(spark, "report")
    sinks.write_report(report, f"{path}/csv")
    sinks.write_report(report, f"{path}/json", "json")
    back = spark.read.schema(report.schema).option("header", True).csv(f"{path}/csv").withColumn("kind", F.lit("csv"))
    return back.unionByName(spark.read.schema(report.schema).json(f"{path}/json").withColumn("kind", F.lit("json")))


_RANKED20 = "SELECT * FROM ranked WHERE rank < 20"
_WIDE = ", ".join(
    f'max("{m}") FILTER (k = {k}) AS "{m}@{k}"' for k in BOARD_K for m in METRICS
)


def _board_sql() -> str:
    """The metric CTEs once per model, with the model's lists in place of ``pred``."""
    sources = {
        "popularity": "SELECT customer_id, item_id, rank FROM asked, pop WHERE rank < 20",
        "repeat": "SELECT customer_id, item_id, rank FROM repbf WHERE rank < 20",
        "item_knn": "SELECT customer_id, item_id, rank FROM knn WHERE rank < 20",
        "vector": "SELECT customer_id, item_id, rank FROM vec WHERE rank < 20",
    }
    digits = tuple(f"{m}@{k}" for k in BOARD_K for m in METRICS)
    parts = [
        f"SELECT * FROM ({build(f'SELECT {name!r} AS model, {_WIDE} FROM met', pred=pred, digits=digits)})"
        for name, pred in sources.items()
    ]
    return " UNION ALL ".join(parts)


QUERIES = {
    "ranking_metrics": (ranking_metrics, build("SELECT CAST(k AS INTEGER) AS k, * EXCLUDE (k) FROM met", digits=METRICS)),
    "slate_health": (slate_health, build("""
SELECT 20 AS k, items_served, CAST(slots AS BIGINT) AS slots, items_served::DOUBLE / (SELECT count(*) FROM cat) AS coverage, novelty, gini,
  (SELECT coalesce(sum(price), 0.0) FROM hits JOIN cat ON cat.item_id = hits.item_id WHERE rank < 20)
    / (SELECT count(*) FROM asked) AS revenue_hit
FROM (SELECT count(*) AS items_served, sum(n) AS slots,
    sum(n * -log2(greatest(base_popularity, 1e-12))) / sum(n) AS novelty,
    sum((2 * rn - total - 1) * n)::DOUBLE / (any_value(total) * sum(n)) AS gini
  FROM (SELECT p.*, base_popularity, row_number() OVER (ORDER BY n) AS rn, count(*) OVER () AS total
    FROM (SELECT item_id, count(*) AS n FROM pred WHERE rank < 20 GROUP BY 1) p
    JOIN basepop b ON b.item_id = p.item_id))""",
        digits=("coverage", "novelty", "gini", "revenue_hit"))),
    "leaderboard": (leaderboard, _board_sql()),
    "rank_candidates": (rank_candidates, build(
        f"SELECT customer_id, item_id, CAST(rank AS INTEGER) AS rank, score, label FROM ({_RANKED20})",
        past="hist", digits=("score",))),
    "repeat_vs_discovery": (repeat_vs_discovery, build(f"""
SELECT count(*) FILTER (old AND hit)::DOUBLE / greatest(count(*) FILTER (old), 1) AS repeat_recall,
  count(*) FILTER (NOT old AND hit)::DOUBLE / greatest(count(*) FILTER (NOT old), 1) AS discovery_recall,
  count(*) FILTER (old)::DOUBLE / greatest(count(*), 1) AS repeat_share_of_truth
FROM (SELECT k.item_id IS NOT NULL AS old, s.item_id IS NOT NULL AS hit FROM truth t
  LEFT JOIN (SELECT DISTINCT customer_id, item_id FROM hp) k ON k.customer_id = t.customer_id AND k.item_id = t.item_id
  LEFT JOIN ({_RANKED20}) s ON s.customer_id = t.customer_id AND s.item_id = t.item_id)""", past="hist",
        digits=("repeat_recall", "discovery_recall", "repeat_share_of_truth"))),
    "recall_by_depth": (recall_by_depth, build(f"""
SELECT CASE WHEN depth IS NULL THEN '0' WHEN depth <= 5 THEN '1-5' WHEN depth <= 15 THEN '6-15' WHEN depth <= 30 THEN '16-30'
    WHEN depth <= 60 THEN '31-60' ELSE '60+' END AS history_purchases,
  count(*) AS customers, avg(recall) AS recall
FROM (SELECT t.customer_id, avg(CASE WHEN s.item_id IS NULL THEN 0.0 ELSE 1.0 END) AS recall FROM truth t
  LEFT JOIN ({_RANKED20}) s ON s.customer_id = t.customer_id AND s.item_id = t.item_id GROUP BY 1) r
LEFT JOIN (SELECT customer_id, count(*) AS depth FROM hp GROUP BY 1) dep ON dep.customer_id = r.customer_id
GROUP BY 1""", past="hist", digits=("recall",))),
    "source_contribution": (source_contribution, build(f"""
SELECT source, avg(present::DOUBLE) AS slate_share, count(*) FILTER (present = 1 AND label = 1) AS hits,
  count(*) FILTER (present = 1 AND label = 1)::DOUBLE / greatest(count(*) FILTER (present = 1), 1) AS "precision",
  count(*) FILTER (present = 1 AND n_sources = 1) AS exclusive_slots,
  count(*) FILTER (present = 1 AND n_sources = 1 AND label = 1) AS exclusive_hits
FROM (SELECT label, n_sources, unnest(['repeat', 'two_tower', 'item_knn', 'popularity']) AS source,
    unnest([in_repeat, in_two_tower, in_item_knn, in_popularity]) AS present FROM ({_RANKED20}))
GROUP BY 1""", past="hist", digits=("slate_share", "precision"))),
    "reason_text": (reason_text, build(f"""
SELECT customer_id, item_id, CASE
  WHEN ui_n_purchase > 0 AND ui_due_ratio >= 1.0
    THEN concat('You buy this regularly and it has been ', CAST(ui_days_since AS INTEGER), ' days')
  WHEN ui_n_purchase > 0 THEN concat('Purchased ', ui_n_purchase, ' time(s) before, most recently ',
    CAST(ui_days_since AS INTEGER), ' days ago')
  WHEN uc_share > 0.15 THEN 'Popular in a category you shop often'
  ELSE 'Similar to products you have bought' END AS reason
FROM ({_RANKED20})""", past="hist")),
    "batch_slate": (batch_slate, build(f"""
SELECT s.*, category_name, price FROM (
  SELECT customer_id, item_id, CAST(rank AS INTEGER) AS rank, score,
    concat_ws(',', CASE WHEN in_repeat = 1 THEN 'repeat' END, CASE WHEN in_two_tower = 1 THEN 'two_tower' END,
      CASE WHEN in_item_knn = 1 THEN 'item_knn' END, CASE WHEN in_popularity = 1 THEN 'popularity' END) AS sources,
    false AS cold_start FROM ({_RANKED20}) WHERE customer_id IN (SELECT c_custkey FROM customer)
  UNION ALL
  SELECT CAST(c_custkey AS BIGINT), item_id, CAST(rank AS INTEGER), 20.0::DOUBLE - rank, 'popularity', true
  FROM customer, pop WHERE rank < 20 AND c_custkey NOT IN (SELECT customer_id FROM asked)) s
LEFT JOIN cat ON cat.item_id = s.item_id""", past="hist",
        asked="SELECT DISTINCT customer_id FROM hist WHERE event_type = 2", digits=("score", "price"))),
    "two_stage_ranker": (two_stage_ranker, None),
    "feature_importance": (feature_importance, None),
    "ranker_trees": (ranker_trees, None),
    "pairwise_ranker": (pairwise_ranker, None),
    "evaluated_blend": (evaluated_blend, None),
    "ranker_pairs": (ranker_pairs, build("""
SELECT customer_id, least(p, 8) * least(n, 16) AS pairs, least(p, 8) AS bought, least(n, 16) AS others
FROM (SELECT customer_id, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM labelled GROUP BY 1)
WHERE p > 0 AND n > 0""", past="hist")),
    "scored_frame": (scored_frame, build("""
SELECT customer_id, item_id, label, score, in_repeat, in_two_tower, in_item_knn, in_popularity, ui_n_purchase
FROM scored""", past="hist", digits=("score",))),
}
QUERIES["report_roundtrip"] = (report_roundtrip, "SELECT * FROM ({}) s, (SELECT unnest(['csv', 'json']) AS kind) k".format(
    QUERIES["source_contribution"][1]))
