"""Offline evaluation from the tables to the reports.

Writes under the output folder: ``baselines`` and ``ranker`` (CSV leaderboards), ``ranker_importance`` (CSV),
``ranker_test_scored`` (parquet), ``segments`` and ``source_contribution`` (CSV), ``analysis`` (JSON).

    spark-submit -m trolley.plans.evaluation_job --tables FOLDER --output O
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.operators import diagnostics, metrics, ranking, retrieval
from trolley.operators.features import FEATURE_COLUMNS
from trolley.plans.setting import Setting
from trolley.session import build_session, release, stage
from trolley.sources import sinks

MAX_K = max(metrics.K_VALUES)


def baseline_lists(s: Setting, fit_until: int, k: int, als: dict) -> dict[str, DataFrame]:
    """Ranked lists of every baseline, all fitted on the log up to ``fit_until``."""
    pairs = s.pairs(fit_until)
    depth = 3 * k  # the blend fuses the first 3k of each list
    lists = {
        "popularity": retrieval.popularity_topk(pairs, s.items, s.asked, k),
        "repeat": retrieval.repeat_backfill(pairs, s.items, s.asked, depth),
        "item_knn": retrieval.item_knn(pairs, s.items, s.asked, depth),
        "als": retrieval.als_topk(pairs, s.asked, depth, **als),
        "vector": s.nearest(s.user_vectors(fit_until, s.asked), k),
    }
    lists = {name: stage(df, f"list-{name}") for name, df in lists.items()}
    lists["blend"] = retrieval.rrf_blend([(lists[n], w) for n, w in retrieval.BLEND_WEIGHTS.items()], k)
    return lists


def board(s: Setting, lists: dict[str, DataFrame], popularity: DataFrame) -> DataFrame:
    rows = [
        metrics.wide_metrics(
            name, metrics.ranking_metrics(df, s.test_truth),
            health=metrics.slate_health(df, s.test_truth, s.items, popularity),
        )
        for name, df in lists.items()
    ]
    return metrics.leaderboard(rows, f"recall@{metrics.PRIMARY_K}")


def run(
    spark: SparkSession, tables: str, output: str,
    trees: int = ranking.TREES, depth: int = ranking.DEPTH, als: dict | None = None,
) -> None:
    s = Setting(spark, tables)
    popularity = stage(s.base_popularity(s.pairs()), "popularity")

    # Both freshness settings: fitted up to the train window, and up to the day before the test week.
    boards = [
        board(s, baseline_lists(s, day, MAX_K, als or {}), popularity).withColumn("fit_until", F.lit(day))
        for day in (s.train_end, s.valid_end)
    ]
    sinks.write_report(boards[0].unionByName(boards[1]), f"{output}/baselines")

    model = ranking.train_ranker(stage(s.labelled("valid"), "train-frame"), trees=trees, depth=depth)
    sinks.write_scored(ranking.score_candidates(model, s.labelled()), f"{output}/ranker_test_scored")
    sinks.write_report(ranking.feature_importance(model, spark, FEATURE_COLUMNS), f"{output}/ranker_importance")

    scored = spark.read.parquet(f"{output}/ranker_test_scored")
    slate = stage(ranking.rank_candidates(scored, MAX_K).select("customer_id", "item_id", "rank"), "slate")
    sinks.write_report(board(s, {"two_stage_ranker": slate}, popularity), f"{output}/ranker")

    known, depths = diagnostics.known_items(s.history), diagnostics.history_depth(s.history)
    decomposed = diagnostics.repeat_vs_discovery(slate, s.test_truth, known)
    segments = diagnostics.recall_by_depth(slate, s.test_truth, depths)
    contribution = diagnostics.source_contribution(scored)
    sinks.write_report(segments, f"{output}/segments")
    sinks.write_report(contribution, f"{output}/source_contribution")
    as_list = lambda df: df.agg(F.collect_list(F.struct("*")).alias("rows")).scalar()  # noqa: E731  a handful of rows
    sinks.write_report(
        decomposed.select(
            F.struct("*").alias("repeat_vs_discovery"), as_list(segments).alias("by_segment"),
            as_list(contribution).alias("source_contribution"),
        ),
        f"{output}/analysis", "json",
    )


def main() -> None:
    parser = argparse.ArgumentParser(description="Baselines, two-stage ranker and diagnostics")
    parser.add_argument("--tables", required=True)
    parser.add_argument("--output", required=True)
    args = parser.parse_args()
    spark = build_session("evaluation-job")
    try:
        run(spark, args.tables, args.output)
    finally:
        release(spark)
        spark.stop()


if __name__ == "__main__":
    main()
